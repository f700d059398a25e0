"""Readers with explicit schemas. Small files are packed by Spark's own file splitting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aislewise.functions import hierarchy as H

INTERACTIONS_SCHEMA = T.StructType([
    T.StructField("user", T.StringType()),
    T.StructField("item", T.StringType()),
    T.StructField("store", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("cnt", T.IntegerType()),
])
PURCHASES_SCHEMA = T.StructType([
    T.StructField("order_no", T.StringType()),
    T.StructField("eid", T.StringType()),
    T.StructField("item_sku", T.StringType()),
    T.StructField("store", T.StringType()),
    T.StructField("region", T.StringType()),
])


def split_paths(paths: str | list[str]) -> list[str]:
    return [p.strip() for p in paths.split(",") if p.strip()] if isinstance(paths, str) else list(paths)


def read_access_log(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Log lines as column ``line``; a ``dt=yyyy-MM-dd`` folder level becomes a DATE column.

    ``paths`` is a list, or one comma-separated text.
    """
    lines = spark.read.text(split_paths(paths)).withColumnRenamed("value", "line")
    if "dt" in lines.columns:
        lines = lines.withColumn("dt", F.col("dt").cast("date"))
    return lines.where(F.trim("line") != "")


def read_interactions(spark: SparkSession, paths: str | list[str], sep: str = "\t") -> DataFrame:
    return spark.read.schema(INTERACTIONS_SCHEMA).option("sep", sep).option("quote", "").csv(
        split_paths(paths)
    )


def read_purchases(spark: SparkSession, paths: str | list[str], sep: str = "\t") -> DataFrame:
    return spark.read.schema(PURCHASES_SCHEMA).option("sep", sep).option("quote", "").csv(
        split_paths(paths)
    )


def select_group(interactions: DataFrame, mode: str = "item") -> DataFrame:
    """(user, grp, item): the group is the listed store or region, or NULL at item level."""
    group = {
        "item": F.lit(None).cast("string"),
        "store": F.col("store"),
        "region": F.col("region"),
    }[mode]
    return interactions.select("user", group.alias("grp"), "item")


def valid_interactions(interactions: DataFrame, mode: str = "item") -> DataFrame:
    """(user, grp, item) of well-formed codes; the group is NULL at item level."""
    return valid_interactions_by_mode(interactions, (mode,)).drop("mode")


def valid_interactions_by_mode(interactions: DataFrame, modes: tuple[str, ...]) -> DataFrame:
    """(mode, user, grp, item) of all ``modes`` from one reading of the input: the group is the
    listed store or region, or NULL at item level."""
    kept = interactions.where(H.is_user_code(F.col("user")) & H.is_item_code(F.col("item")))
    store, region = F.col("store"), F.col("region")
    groups = {
        "item": (F.lit(None).cast("string"), F.lit(True)),
        "store": (store, H.is_group_code(store, H.STORE_CHARS)),
        "region": (region, H.is_group_code(region, H.REGION_CHARS)),
    }
    if len(modes) == 1:
        group, valid = groups[modes[0]]
        return kept.where(valid).select(F.lit(modes[0]).alias("mode"), "user", group.alias("grp"), "item")
    entries = [F.when(groups[m][1], F.struct(F.lit(m).alias("mode"), groups[m][0].alias("grp"))) for m in modes]
    rows = kept.select("user", "item", F.explode(F.array(*entries)).alias("e")).where(F.col("e").isNotNull())
    return rows.select("e.mode", "user", "e.grp", "item")
