"""Item vectors kept up to date day by day, with days that may be run again.

The store is a folder of ``sources.versions``. Its manifest names, for every day, the table of pair counts
last merged for it, and a list of runs: tables of (item, other, cnt) whose sum is the whole vector. Merging
days writes one run, the days' counts less those merged for the same days before (so a day that is run
again counts once), and publishes it in one step. When ``FAN_IN`` runs of one level have gathered, they are
summed into one of the next level, so a pair is written again about once per level, not every day, and
readers sum no more than ``FAN_IN`` runs a level.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aislewise.sources import versions as V

FAN_IN = 4
COUNTS = "item string, other string, cnt bigint"


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _summed(parts: list[DataFrame]) -> DataFrame:
    sums = _union(parts).groupBy("item", "other").agg(F.sum("cnt").alias("cnt"))
    return sums.where("cnt <> 0")


def _read(spark: SparkSession, root: str, folder: str) -> DataFrame:
    return spark.read.schema(COUNTS).parquet(f"{root}/{folder}")


def merged_days(spark: SparkSession, root: str, version: int | None = None) -> list[date]:
    """Days that the store holds."""
    return sorted(date.fromisoformat(d) for d in V.manifest(spark, root, version)[1].get("days", {}))


def read_vectors(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """(item, other, cnt) over all merged days, at the highest version unless given."""
    runs = V.manifest(spark, root, version)[1].get("runs", [])
    if not runs:
        return spark.createDataFrame([], COUNTS)
    return _summed([_read(spark, root, r["folder"]) for r in runs])


def merge_days(spark: SparkSession, root: str, vectors: DataFrame, days: list[date]) -> int:
    """Merges the daily vectors (dt, item, other, cnt) of ``days``; returns the new version.

    A day merged before is replaced, also by nothing. Rows of other days are not taken. Nothing changes for
    readers until all is written; if another run publishes first, this one fails without a trace.
    """
    base, content = V.manifest(spark, root)
    merged: dict[str, str] = dict(content.get("days", {}))
    runs: list[dict] = list(content.get("runs", []))
    written: list[str] = []

    def save(df: DataFrame) -> str:
        written.append(V.new_folder())
        df.write.parquet(f"{root}/{written[-1]}")
        return written[-1]

    try:
        own = vectors.where(F.col("dt").isin([F.lit(d) for d in days])).groupBy("dt", "item", "other").agg(F.sum("cnt").alias("cnt"))
        folder = save(own.hint("rebalance", F.col("dt")))
        fresh = spark.read.schema(f"dt date, {COUNTS}").parquet(f"{root}/{folder}")
        changes = [fresh.select("item", "other", "cnt")]
        for day in days:
            if day.isoformat() in merged:
                former = spark.read.schema(f"dt date, {COUNTS}").parquet(f"{root}/{merged[day.isoformat()]}")
                changes.append(former.where(F.col("dt") == F.lit(day)).select("item", "other", (-F.col("cnt")).alias("cnt")))
            merged[day.isoformat()] = folder
        runs.append({"level": 0, "folder": save(_summed(changes))})
        runs = _compacted(spark, root, runs, save)
        return V.commit(spark, root, base, {"days": merged, "runs": runs})
    except (Exception, KeyboardInterrupt):
        for name in written:
            V.delete_folder(spark, root, name)
        raise


def _compacted(spark: SparkSession, root: str, runs: list[dict], save) -> list[dict]:
    """Sums ``FAN_IN`` runs of one level into one of the next while there are as many."""
    level = 0
    while any(r["level"] >= level for r in runs):
        own = [r for r in runs if r["level"] == level]
        if len(own) >= FAN_IN:
            whole = _summed([_read(spark, root, r["folder"]) for r in own])
            runs = [r for r in runs if r["level"] != level] + [{"level": level + 1, "folder": save(whole)}]
        level += 1
    return runs
