"""Joins that multiply rows, cut into cells of bounded output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 1000


def fan_out(df: DataFrame, keys: list[str]) -> DataFrame:
    """Partitions ``df`` by ``keys`` into ``spark.sql.shuffle.partitions`` parts that stay.

    For the input of a join that multiplies rows: adaptive execution would merge partitions
    by their small input size and leave few tasks with all of the output. Adaptive skew
    splitting does not apply to such partitions, so no key may have unbounded output: cap its
    rows or cut it into cells first.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *keys)


def blocks_of(df: DataFrame, keys: list[str], block_rows: int, name: str) -> DataFrame:
    """(*keys, name): number of blocks of keys with more than ``block_rows`` rows.

    Blocks are aimed at half that size, as hashing fills them unevenly.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block_rows)
    return counts.select(*keys, F.ceil(F.col("n") * 2 / block_rows).cast("int").alias(name))


def _block(unit: list[Column], blocks: str) -> Column:
    return F.pmod(F.xxhash64(*unit), F.col(blocks)).cast("int")


def _each(blocks: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))


def cell_join(
    left: DataFrame, right: DataFrame, keys: list[str], left_unit: list[str], right_unit: list[str],
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Inner join on ``keys``, in cells of about ``block_rows`` squared results at most.

    Large keys are cut into blocks on either side by their units; a block of one side meets each block
    of the other in a cell, a join key of its own. Columns besides the keys must differ.
    """
    sizes = blocks_of(left, keys, block_rows, "_rows").join(blocks_of(right, keys, block_rows, "_columns"), keys, "full")
    one = F.lit(1)

    def sized(df: DataFrame) -> DataFrame:
        return df.join(sizes, keys, "left").withColumns(
            {c: F.coalesce(F.col(c), one) for c in ("_rows", "_columns")})

    rows = sized(left).withColumn("_i", _block([F.col(c) for c in left_unit], "_rows")).withColumn("_j", _each("_columns"))
    columns = sized(right).withColumn("_j", _block([F.col(c) for c in right_unit], "_columns")).withColumn("_i", _each("_rows"))
    at = [*keys, "_i", "_j"]
    return fan_out(rows.drop("_rows", "_columns"), at).join(fan_out(columns.drop("_rows", "_columns"), at), at).drop("_i", "_j")
