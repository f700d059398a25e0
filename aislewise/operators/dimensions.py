"""Lookups of items and stores in dimension tables.

Facts are aggregated to one row per item or store before they are joined, and no side is
forced to be broadcast: the measured size of the dimension decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewise.functions import hierarchy as H
from aislewise.functions.vectors import clean_name


def item_store_lookup(rows: DataFrame, item_dim: DataFrame, six_chars_only: bool = False) -> DataFrame:
    """Adds ``item_store`` and ``item_store_name``: the item's listed store.

    An unknown item takes its own prefix; with ``six_chars_only`` so does one whose listed
    store number does not have 6 characters.
    """
    dim = item_dim.groupBy("item").agg(
        F.max(F.struct("st_no", "st_name")).alias("listed")
    ).select("item", "listed.st_no", "listed.st_name")
    known = F.col("st_no") != ""
    if six_chars_only:
        known = F.length("st_no") == H.STORE_CHARS
    store = F.when(known, F.col("st_no")).otherwise(H.prefix(F.col("item"), H.STORE_CHARS))
    return rows.join(dim, "item", "left").select(
        *rows.columns, store.alias("item_store"), F.col("st_name").alias("item_store_name")
    )


def store_name_lookup(
    rows: DataFrame, store_dim: DataFrame, store: str = "store_no", missing: str = "", name: str = "name"
) -> DataFrame:
    """Adds the cleaned store name, found by upper-cased store number; else ``missing``."""
    names = store_dim.groupBy(F.upper("store_no").alias("_store_key")).agg(
        F.max(clean_name(F.col("name"))).alias("_store_name")
    )
    found: Column = F.coalesce(F.col("_store_name"), F.lit(missing))
    return rows.join(names, F.upper(F.col(store)) == F.col("_store_key"), "left").select(
        *rows.columns, found.alias(name)
    )
