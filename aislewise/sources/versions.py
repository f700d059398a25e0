"""Output folders that change all at once: data is written beside, checked, then published.

``root/data-<id>`` folders hold the data, ``root/_versions/<number>`` files name what is current. A
version file is written under another name and renamed, so a run that dies leaves the former version. Where a
rename never replaces a file, as in HDFS, of two runs that start from one version only one publishes; on
other stores let one run at a time write to a root.
Readers take the highest version; ``expire`` deletes folders that no kept version names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession

VERSIONS = "_versions"
Manifest = dict[str, Any]


class Conflict(RuntimeError):
    """Another run has published since the version this one started from."""


class CheckFailed(RuntimeError):
    """The written data is not what was to be written; the former version stays."""


def _path(spark: SparkSession, name: str) -> tuple[Any, Any]:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[int]:
    """Published versions in ascending order."""
    path, files = _path(spark, f"{root}/{VERSIONS}")
    if not files.exists(path):
        return []
    return sorted(int(s.getPath().getName()) for s in files.listStatus(path) if s.getPath().getName().isdigit())


def manifest(spark: SparkSession, root: str, version: int | None = None) -> tuple[int, Manifest]:
    """(version, its content), the highest version unless given; (0, {}) where nothing is published."""
    found = versions(spark, root)
    if not found:
        return 0, {}
    version = found[-1] if version is None else version
    path, files = _path(spark, f"{root}/{VERSIONS}/{version:010d}")
    stream = files.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return version, json.loads(text)


def commit(spark: SparkSession, root: str, base: int, content: Manifest) -> int:
    """Publishes ``content`` as the version after ``base``."""
    version = base + 1
    target, files = _path(spark, f"{root}/{VERSIONS}/{version:010d}")
    draft, _ = _path(spark, f"{root}/{VERSIONS}/.draft-{uuid.uuid4().hex}")
    stream = files.create(draft, False)
    try:
        stream.write(json.dumps(content).encode())
    finally:
        stream.close()
    if files.exists(target) or not files.rename(draft, target):
        files.delete(draft, False)
        raise Conflict(f"version {version} of {root} exists already")
    return version


def new_folder() -> str:
    """A fresh name of a data folder, as a manifest names it."""
    return f"data-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, root: str, folder: str) -> None:
    path, files = _path(spark, f"{root}/{folder}")
    files.delete(path, True)


def publish(
    spark: SparkSession, root: str, write: Callable[[str], int | None], more: Manifest | None = None,
    count: Callable[[str], int] | None = None,
) -> int:
    """Lets ``write`` fill a new folder and publishes it; returns the version.

    ``write`` takes the folder's path and may return how many rows it meant to write; ``count`` counts what is
    there. If they differ, or ``write`` raises, the folder is deleted and the former version stays.
    """
    base, _ = manifest(spark, root)
    folder = new_folder()
    try:
        meant = write(f"{root}/{folder}")
        if meant is not None and count is not None:
            found = count(f"{root}/{folder}")
            if found != meant:
                raise CheckFailed(f"{found} rows in {root}/{folder}, {meant} were meant to be written")
        return commit(spark, root, base, {
            "folder": folder, "at": datetime.now(timezone.utc).isoformat(), **(more or {}), "rows": meant})
    except (Exception, KeyboardInterrupt):
        delete_folder(spark, root, folder)
        raise


def published_path(spark: SparkSession, root: str, version: int | None = None) -> str:
    """Path of the folder of a version, the highest unless given."""
    number, content = manifest(spark, root, version)
    if number == 0:
        raise FileNotFoundError(f"nothing is published in {root}")
    return f"{root}/{content['folder']}"


def read_published(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """A published parquet table."""
    return spark.read.parquet(published_path(spark, root, version))


def _named_folders(content: Manifest) -> set[str]:
    """Every data folder that a manifest names, at any depth."""
    if isinstance(content, dict):
        return set().union(*map(_named_folders, content.values())) if content else set()
    if isinstance(content, list):
        return set().union(*map(_named_folders, content)) if content else set()
    return {content} if isinstance(content, str) and content.startswith("data-") else set()


def expire(spark: SparkSession, root: str, keep: int = 2, unpublished_after: timedelta = timedelta(days=7)) -> list[str]:
    """Deletes all but the last ``keep`` versions and the folders no kept version names.

    Folders of runs not yet published look the same as those of dead ones, so only folders untouched for
    ``unpublished_after`` go. Returns the deleted folders.
    """
    found = versions(spark, root)
    kept = set().union(set(), *(_named_folders(manifest(spark, root, v)[1]) for v in found[-keep:]))
    dropped = set().union(set(), *(_named_folders(manifest(spark, root, v)[1]) for v in found[:-keep])) - kept
    for version in found[:-keep]:
        path, files = _path(spark, f"{root}/{VERSIONS}/{version:010d}")
        files.delete(path, False)
    path, files = _path(spark, root)
    oldest = (datetime.now(timezone.utc) - unpublished_after).timestamp() * 1000
    for status in files.listStatus(path):
        name = status.getPath().getName()
        if name.startswith("data-") and name not in kept and status.getModificationTime() < oldest:
            dropped.add(name)
    for folder in sorted(dropped):
        delete_folder(spark, root, folder)
    return sorted(dropped)

