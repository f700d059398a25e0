"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Small files are packed into splits of this size, large ones are cut.
    "spark.sql.files.maxPartitionBytes": "64m",
}

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "aislewise", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, from ``spark.checkpoint.dir``.

    Only a local-mode session may go without the setting; it gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="aislewise-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Tables written within ``stage_tables`` blocks, the innermost last.
_open_blocks: list[list[DataFrame]] = []


@contextmanager
def stage_tables() -> Iterator[None]:
    """Deletes every table that ``materialize`` writes within the block, at its end: for jobs, whose results are
    written by then."""
    _open_blocks.append([])
    try:
        yield
    finally:
        drop_materialized(*_open_blocks.pop())


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written within the block go with each write, not when the driver collects its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as parquet below the shared folder and read it back.

    Cuts the lineage in a form that outlives lost executors, for a table that
    several aggregations scan. Shuffle files go once it is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_deleted(spark):
        writer.parquet(path)
    partitioned = partition_by or []
    fields = [f for f in df.schema if f.name not in partitioned] + [f for f in df.schema if f.name in partitioned]
    stored = spark.read.schema(T.StructType(fields)).parquet(path)
    if _open_blocks:
        _open_blocks[-1].append(stored)
    stored._stage_path = path  # with partition_by, the partition columns come last
    return stored


def drop_materialized(*tables: DataFrame) -> None:
    """Deletes tables of ``materialize`` once nothing reads them any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table._stage_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
