"""Sinks: TAB-separated text with optional header and gzip, and parquet tables.

``publish_tsv`` and ``publish_table`` write beside what is there, compare the written rows with those the plan
made, and change over in one step (``sources.versions``): a run that dies leaves the old output readable.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from aislewise.sources import versions


def write_tsv(df: DataFrame, path: str, header: bool = False, gzip: bool = False) -> None:
    """Overwrite ``path`` with TAB-separated text; arrays and structs must be packed before.

    Values must hold no TAB; missing ones are written empty.
    """
    writer = df.write.mode("overwrite").option("sep", "\t").option("header", header)
    writer = writer.option("quote", "").option("emptyValue", "").option("nullValue", "")
    writer.option("compression", "gzip" if gzip else "none").csv(path)


def write_lines(df: DataFrame, path: str, gzip: bool = False) -> None:
    """Overwrite ``path`` with one TAB-joined line per row, for cells that hold TABs themselves."""
    line = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])
    df.select(line).write.mode("overwrite").option("compression", "gzip" if gzip else "none").text(path)


def write_table(df: DataFrame, path: str, by_day: bool = False) -> None:
    """Overwrite a parquet table; with ``by_day`` only the ``dt`` partitions that are written.

    Rows of a day are brought together first, in parts of even size, so a day gets few files.
    """
    writer = (df.hint("rebalance", F.col("dt")) if by_day else df).write.mode("overwrite")
    if by_day:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy("dt")
    writer.parquet(path)


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with its rows counted as they pass."""
    observation = Observation(f"rows-{uuid.uuid4().hex}")
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def publish_tsv(df: DataFrame, root: str, header: bool = False, gzip: bool = False) -> int:
    """``write_tsv`` as the next version of ``root``; returns the version."""
    spark = df.sparkSession
    counted, rows = _counted(df)

    def write(path: str) -> int:
        write_tsv(counted, path, header, gzip)
        return rows.get["rows"]

    def count(path: str) -> int:
        return spark.read.option("sep", "\t").option("header", header).option("quote", "").csv(path, "value string").count()

    return versions.publish(spark, root, write, {"format": "tsv", "columns": df.columns}, count)


def publish_table(df: DataFrame, root: str, more: dict | None = None) -> int:
    """A parquet table as the next version of ``root``; returns the version."""
    spark = df.sparkSession
    counted, rows = _counted(df)

    def write(path: str) -> int:
        counted.write.parquet(path)
        return rows.get["rows"]

    return versions.publish(
        spark, root, write, {"format": "parquet", **(more or {})}, lambda path: spark.read.schema(df.schema).parquet(path).count())
