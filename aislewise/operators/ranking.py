"""Top-k per group and the side-by-side rank table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aislewise.session import materialize

#: Bits of a row's number within its partition, as ``monotonically_increasing_id`` has them.
ROW_BITS = 33


def rank_per_group(df: DataFrame, keys: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def top_k_per_group(
    df: DataFrame, keys: list[str], order: list[Column], k: int, name: str = "rank"
) -> DataFrame:
    """First ``k`` rows of each group. End ``order`` with a unique code, so ties are settled.

    The rank limit is applied within each input partition before the shuffle, so a hot
    group moves at most ``k`` rows per partition.
    """
    return rank_per_group(df, keys, order, name).where(F.col(name) <= k)


def rank_sorted(df: DataFrame, keys: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """As ``rank_per_group``, for groups of any size: no group is in one task.

    Rows are range-partitioned by keys and order into ``spark.sql.shuffle.partitions`` parts and written once.
    A row's rank is its number in its part, plus the group's rows in the parts before, which are
    prefix sums over one count per part and group. End ``order`` with a unique code.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [*[F.col(k) for k in keys], *order]
    ordered = df.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    placed = materialize(ordered.withColumn("_place", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_place", ROW_BITS).alias("_part")
    runs = placed.groupBy(*keys, part).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_part").alias("_in"),
        (F.col("_first") - F.coalesce(F.sum("_n").over(earlier), F.lit(0))).alias("_zero"))
    rows = placed.withColumn("_part", part)
    same = rows["_part"] == starts["_in"]
    for k in keys:
        same = same & rows[k].eqNullSafe(starts[f"_key_{k}"])
    rank = (F.col("_place") - F.col("_zero") + 1).cast("int").alias(name)
    return rows.join(starts, same).select(*df.columns, rank)


def rank_align(ranked: DataFrame, keys: list[str], scopes: list[str]) -> DataFrame:
    """Wide table from (keys, scope, rank, store_no, name, cnt): row i holds each scope's rank i.

    Missing entries are NULL. A single aggregation over (keys, rank).
    """
    columns = []
    for scope in scopes:
        here = F.col("scope") == scope
        for field in ("name", "store_no", "cnt"):
            columns.append(F.max(F.when(here, F.col(field))).alias(f"{scope}_{field}"))
    return ranked.groupBy(*keys, "rank").agg(*columns)
