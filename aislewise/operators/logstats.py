"""Counts of page views and orders from parsed beacons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewise.functions import hierarchy as H
from aislewise.functions import logline as L
from aislewise.operators.beacons import (
    is_store_page_view, order_stat_category, pv_category, with_device,
)
from aislewise.operators.dimensions import item_store_lookup, store_name_lookup

# Report columns, and the order of the category rows.
DEVICE_COLUMNS = (
    ("pc", "PC"), ("phone", "Phone"), ("tablet", "Tablet"), ("other", "Other"), ("unknown", "Unknown"),
)
HIT_COLUMNS = ("normal_page_total", "mobile_page_total", "pc", "phone", "tablet", "other", "unknown")
CATEGORY_ROWS = (
    ("24h", "store"), ("ecshop", "store"), ("books", "all_page"), ("mobile", "all_page"),
    ("residue_site", "store"), ("residue_site", "activity"), ("else_site", "else_page"),
)
ORDER_COLUMNS = (
    "order", "24h_store", "ecshop_store", "activity", "onsale", "books", "mobile", "global_store",
)


def page_view_hits(beacons: DataFrame) -> DataFrame:
    """Requests per (site, page, action): total under normal or mobile pages, and per device.

    A missing page or action counts under the text 'null'; empty ones are not counted.
    """
    named = beacons.withColumns({
        "page": F.coalesce("page", F.lit("null")), "action": F.coalesce("action", F.lit("null")),
    })
    rows = with_device(named.where("site <> '' AND page <> '' AND action <> ''"))
    counts = rows.groupBy("site", "page", "action").agg(
        *[F.count_if(F.col("device") == name).alias(column) for column, name in DEVICE_COLUMNS]
    )
    total = sum((F.col(column) for column, _ in DEVICE_COLUMNS[1:]), F.col(DEVICE_COLUMNS[0][0]))
    mobile = F.col("site") == "mobile"
    zero = F.lit(0).cast("bigint")
    return counts.select(
        "site", "page", "action",
        F.when(mobile, zero).otherwise(total).alias("normal_page_total"),
        F.when(mobile, total).otherwise(zero).alias("mobile_page_total"),
        *[column for column, _ in DEVICE_COLUMNS],
    )


def category_page_views(hits: DataFrame) -> DataFrame:
    """Page views of ``page_view_hits`` by category, with the report's row number."""
    views = hits.where((F.col("action") == "pageview") & F.col("page").isNotNull())
    named = views.withColumn("category", pv_category(F.col("site"), F.col("page")))
    sums = named.groupBy(
        F.col("category.site").alias("site"), F.col("category.page").alias("page")
    ).agg(*[F.sum(c).alias(c) for c in HIT_COLUMNS])
    position = F.when(F.lit(False), 0)
    for number, (site, page) in enumerate(CATEGORY_ROWS, start=1):
        position = position.when((F.col("site") == site) & (F.col("page") == page), number)
    return sums.select(position.alias("row_no"), "site", "page", *HIT_COLUMNS)


def _column_of(category: str) -> Column:
    return F.sum(F.when(F.col("category") == category, F.col("n")).otherwise(0))


def order_vs_page_views(beacons: DataFrame, item_dim: DataFrame, store_dim: DataFrame) -> DataFrame:
    """Orders beside page views per store, for stores that have orders.

    Counts each event's distinct SKUs. An order counts for the item's listed store; a view
    for the store in the URL (store pages), else for the item's prefix. The store's name
    comes from its ordered items, else from the store table, else is 'NULL'.
    """
    events = beacons.where(F.col("page").isNotNull() & F.col("action").isNotNull()).select(
        order_stat_category(F.col("site"), F.col("page"), F.col("action")).alias("category"),
        F.when(F.col("page") == "store", L.store_from_url(F.col("line"))).otherwise("").alias("url_store"),
        "prod",
    ).where(F.col("category").isNotNull())
    items = events.select(
        "category", "url_store", F.explode(F.array_distinct("prod")).alias("sku")
    ).select("category", "url_store", H.item_of_sku(F.col("sku")).alias("item")).where(
        F.col("item").isNotNull()
    )
    per_item = items.groupBy("category", "url_store", "item").agg(F.count(F.lit(1)).alias("n"))
    placed = item_store_lookup(per_item, item_dim)
    is_order = F.col("category") == "order"
    store = (
        F.when(is_order, F.col("item_store"))
        .when(F.col("url_store") != "", F.col("url_store"))
        .otherwise(H.prefix(F.col("item"), H.STORE_CHARS))
    )
    by_store = placed.groupBy(store.alias("store_no")).agg(
        F.max(F.when(is_order, F.col("item_store_name"))).alias("item_store_name"),
        *[_column_of(c).alias(c) for c in ORDER_COLUMNS],
    ).where(F.col("order") > 0)
    named = store_name_lookup(by_store, store_dim, missing="NULL", name="dim_name")
    name = F.coalesce(F.nullif(F.col("item_store_name"), F.lit("")), F.col("dim_name"))
    return named.select("store_no", name.alias("name"), *ORDER_COLUMNS)


def _counted_site() -> Column:
    return F.when(F.col("site") == "shopping", "ecshop").otherwise(F.col("site")).alias("site")


def store_page_views(beacons: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys..., site, store_no) per view of a store page that names the store in its URL."""
    views = beacons.where(is_store_page_view()).select(
        *(keys or []), _counted_site(), L.store_from_url(F.col("line")).alias("url_store"))
    # The generator keeps the pattern from being matched again by the filter.
    found = views.select(*(keys or []), "site", F.explode(F.array("url_store")).alias("store_no"))
    return found.where(F.col("store_no") != "")


def store_page_counts(
    beacons: DataFrame, item_dim: DataFrame | None = None, keys: list[str] | None = None
) -> DataFrame:
    """(keys..., site, store_no, cnt) of store page views; site shopping counts as ecshop.

    The store is the one in the URL. With ``item_dim`` a line without one counts for the
    listed store of its first item, otherwise such lines are left out.
    """
    keys = keys or []
    if item_dim is None:
        return store_page_views(beacons, keys).groupBy(*keys, "site", "store_no").agg(F.count(F.lit(1)).alias("cnt"))
    views = beacons.where(is_store_page_view()).select(
        *keys, _counted_site(), L.store_from_url(F.col("line")).alias("url_store"), "prod"
    )
    # The item matters only without a store in the URL; one join then serves both cases, and
    # the log is parsed once.
    item = F.when(F.col("url_store") == "", H.item_of_sku(F.try_element_at("prod", F.lit(1))))
    per_item = views.groupBy(*keys, "site", "url_store", item.alias("item")).agg(
        F.count(F.lit(1)).alias("n")
    )
    placed = item_store_lookup(per_item, item_dim, six_chars_only=True)
    store = F.when(F.col("url_store") != "", F.col("url_store")).otherwise(F.col("item_store"))
    return placed.select(*keys, "site", store.alias("store_no"), "n").where(
        F.col("store_no").isNotNull()
    ).groupBy(*keys, "site", "store_no").agg(F.sum("n").alias("cnt"))
