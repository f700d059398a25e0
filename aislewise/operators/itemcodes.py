"""Item codes as numbers in the same order, for joins that count pairs.

Pairs outnumber rows by the size of a basket, so what a pair carries decides the volume of its shuffle. Items
are numbered once in the order of their codes; pairs are counted, ranked and cut by number, and only what
is left is named again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewise.operators.ranking import ROW_BITS
from aislewise.session import materialize


def numbered_items(rows: DataFrame) -> DataFrame:
    """(no, item): a number for each item of ``rows``, in the order of the codes and without gaps.

    Range-partitioned by code and numbered within the parts, so no task holds all items; a part starts where those
    before it end, by one count a part. Written once, as the numbers are used on both sides of later joins. Numbers are
    INT where they fit, as arrays of them make the volume of later shuffles.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    items = rows.select("item").distinct().repartitionByRange(parts, "item").sortWithinPartitions("item")
    stored = materialize(items.select(F.monotonically_increasing_id().alias("place"), "item"), "item-numbers")
    part = F.shiftright("place", ROW_BITS)
    counts = {r.part: r.n for r in stored.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    starts = [0]
    for p in range(max(counts, default=0)):
        starts.append(starts[-1] + counts.get(p, 0))
    kind = "int" if sum(counts.values()) < 1 << 31 else "bigint"
    start = F.element_at(F.array(*[F.lit(n).cast("bigint") for n in starts]), part.cast("int") + 1)
    numbered = stored.select((start + F.col("place") - F.shiftleft(part, ROW_BITS)).cast(kind).alias("no"), "item")
    numbered._stage_path = stored._stage_path
    return numbered


def families(items: DataFrame, chars: int) -> DataFrame:
    """(family, low, high): first and last number of the items whose codes share their first ``chars`` characters."""
    return items.groupBy(F.substring("item", 1, chars).alias("family")).agg(F.min("no").alias("low"), F.max("no").alias("high"))


def named(df: DataFrame, items: DataFrame, **columns: str) -> DataFrame:
    """Puts item codes in place of numbers: ``column="code"`` turns number ``column`` into code ``code``."""
    for column, code in columns.items():
        names = items.select(F.col("no").alias(f"_{column}"), F.col("item").alias(code))
        df = df.join(names, df[column] == names[f"_{column}"]).drop(column, f"_{column}")
    return df


def packed(code: Column) -> Column:
    """A code of at most 7 word characters as a number."""
    return F.conv(F.hex(code), 16, 10).cast("bigint")


def unpacked(number: Column) -> Column:
    return F.unhex(F.hex(number)).cast("string")
