"""Recommendation jobs: from input paths to output tables and text files."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aislewise.functions import periods as P
from aislewise.functions import vectors as V
from aislewise.operators import alsoview, baskets, boundedtop, identity, mostview, userrec, vectorstore
from aislewise.session import drop_materialized, materialize, stage_tables
from aislewise.sources import readers, stagefiles, writers


def ranked_lines(ranked: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value list): one line per key with its values in rank order.

    Takes top-k rows, so no key's list is longer than k.
    """
    return ranked.groupBy(key).agg(
        V.packed(F.collect_list(V.entry(F.col("rank"), F.col(value)))).alias(f"{value}s")
    )


def chosen_cap(months: int | None, cap: int | None, no_cap: bool) -> int | None:
    """Basket cap of a job: given, following the months of input, or none; one must be said."""
    if (months is not None) + (cap is not None) + no_cap != 1:
        raise ValueError("give exactly one of months, cap and no_cap")
    return None if no_cap else cap if cap is not None else baskets.basket_limit(months)


def also_view_item_job(
    spark: SparkSession, inputs: str | list[str], output: str, top: int = alsoview.TOP_ITEMS,
    min_score: int = 0, *, months: int | None = None, cap: int | None = None, no_cap: bool = False,
    crawlers_first: bool = False,
) -> dict[str, int]:
    """Items also viewed with each item; returns how many users and rows the cap left out."""
    cap = chosen_cap(months, cap, no_cap)
    with stage_tables():
        units = alsoview.capped_units(readers.read_interactions(spark, inputs), cap, crawlers_first=crawlers_first)
        writers.write_tsv(ranked_lines(alsoview.ranked_items(units, min_score, top), "item", "other"), output)
    return units.report


def also_view_group_job(
    spark: SparkSession, inputs: str | list[str], output: str, level: str,
    top: int = alsoview.TOP_PER_GROUP, top_per_item: int | None = None, *, months: int | None = None,
    cap: int | None = None, no_cap: bool = False, crawlers_first: bool = False,
) -> dict[str, int]:
    """Items also viewed with each store or region (``level``); returns what the cap left out."""
    cap = chosen_cap(months, cap, no_cap)
    with stage_tables():
        units = alsoview.capped_units(readers.read_interactions(spark, inputs), cap, level, crawlers_first)
        items = alsoview.ranked_group_items(units, level, top_per_item)
        writers.write_tsv(ranked_lines(alsoview.also_view_group(items, top), "grp", "item"), output)
    return units.report


def most_view_job(
    spark: SparkSession, inputs: str | list[str], output: str, level: str, top: int = mostview.TOP
) -> None:
    ranked = mostview.most_view(readers.read_interactions(spark, inputs), level, top)
    writers.write_tsv(ranked_lines(ranked, "grp", "item"), output)


def daily_counters(lines: DataFrame, purchases: DataFrame) -> DataFrame:
    """User-item counters of log lines (dt, line) and purchases (dt, user, item).

    The log is read and parsed once; clicks and identity pairs are then taken from the
    stored requests, which are far smaller than the lines.
    """
    return counters_of(materialize(identity.shopper_requests(lines), "shopper-requests"), purchases)


def counters_of(requests: DataFrame, purchases: DataFrame) -> DataFrame:
    return userrec.user_item_daily(identity.clicks_of(requests), identity.pairs_of(requests), purchases)


def user_item_daily_job(
    spark: SparkSession, log_paths: str | list[str], purchase_paths: str | list[str], table: str,
    day: str | None = None,
) -> None:
    """Daily counters of one day (yyyyMMdd, else taken from the table path), as a ``dt`` partition."""
    run_day = P.run_date(table, day)
    lines = readers.read_access_log(spark, log_paths).select(
        F.to_date(F.lit(run_day), "yyyyMMdd").alias("dt"), "line"
    )
    bought = identity.purchases_on_day(readers.read_purchases(spark, purchase_paths), run_day)
    requests = materialize(identity.shopper_requests(lines), "shopper-requests")
    writers.write_table(counters_of(requests, bought), table, by_day=True)
    drop_materialized(requests)


@stage_tables()
def item_vector_daily_job(spark: SparkSession, daily_table: str, table: str, day: date) -> None:
    daily = spark.read.parquet(daily_table).where(F.col("dt") == F.lit(day))
    writers.write_table(userrec.item_vector_daily(daily), table, by_day=True)


@stage_tables()
def merge_item_vectors_job(spark: SparkSession, daily_table: str, store: str, days: list[date]) -> int:
    """Merges the item vectors of ``days`` into the kept store of all days; returns its new version.

    Days run again are replaced, so a late or corrected day is never counted twice.
    """
    daily = spark.read.parquet(daily_table).where(F.col("dt").isin([F.lit(d) for d in days]))
    return vectorstore.merge_days(spark, store, userrec.item_vector_daily(daily), days)


def store_vectors(
    daily: DataFrame, first_day: date, as_of: date, min_cnt: int = 1, limit: int | None = userrec.VECTOR_LIMIT
) -> tuple[DataFrame, DataFrame]:
    """User and item vectors as stored tables.

    The daily counters feed both, and each vector is scanned several times by the product:
    stored tables keep the plans short and survive lost executors. Item vectors that the merge stored over numbers are
    not stored again.
    """
    stored = materialize(daily, "user-item-daily")
    daily_vectors = userrec.item_vector_daily(stored)
    merged = userrec.item_vector_merge(daily_vectors, min_cnt, limit)
    item_vectors = merged if hasattr(merged, "_vectors") else materialize(merged, "item-vector")
    if hasattr(daily_vectors, "_cells"):
        daily_vectors._cells.drop()
    counts = materialize(userrec.user_counts(stored), "user-counts")
    users = materialize(userrec.user_vector(stored, first_day, as_of, counts), "user-vector")
    drop_materialized(stored, counts)
    return users, item_vectors


def similarity_vectors(interactions: DataFrame, cap: int | None) -> DataFrame:
    """(item, other, cnt) from view history, in the shape of daily item vectors."""
    return alsoview.item_similarity(interactions, cap).select("item", "other", F.col("score").alias("cnt"))


def item_similarity_job(
    spark: SparkSession, inputs: str | list[str], table: str, *, months: int | None = None, cap: int | None = None,
    no_cap: bool = False,
) -> dict[str, int]:
    """Similarity of all item pairs as a table; returns how many users and rows the cap left out."""
    with stage_tables():
        units = alsoview.capped_units(readers.read_interactions(spark, inputs), chosen_cap(months, cap, no_cap))
        scores = alsoview.similar_items(units).select("item", "other", F.col("score").alias("cnt"))
        writers.write_table(scores, table)
    return units.report


@stage_tables()
def user_recommend_job(
    spark: SparkSession, daily_table: str, item_vector_table: str, output: str, first_day: date,
    as_of: date, top: int = userrec.TOP_ITEMS, gzip: bool = False, recommend_unbought: bool = False,
    min_cnt: int = 1, limit: int | None = userrec.VECTOR_LIMIT, text: bool = False, bounded: bool = False,
    kept: bool = False, publish: bool = False,
) -> None:
    """Personal lists from the stored daily counters and item vectors up to ``as_of``.

    ``text``: both are text files of an earlier run (``stagefiles``), not tables.
    ``kept``: the item vectors are a store of ``merge_item_vectors_job`` (all its days).
    ``bounded``: leave out products that cannot reach a list (``boundedtop``); the lists are the same.
    ``publish``: write the lists as the next version of ``output``, leaving the last one until they are whole.

    The item vectors are daily ones, or the table of ``item_similarity_job``.
    """
    days = (F.col("dt") >= F.lit(first_day)) & (F.col("dt") <= F.lit(as_of))
    if text:
        daily = stagefiles.read_daily_counters(spark, daily_table)
        stored = stagefiles.read_item_vectors(spark, item_vector_table)
    else:
        daily = spark.read.parquet(daily_table)
        stored = vectorstore.read_vectors(spark, item_vector_table) if kept else spark.read.parquet(item_vector_table)
    daily = daily.where(days) if "dt" in daily.columns else daily
    item_vectors = userrec.item_vector_merge(
        stored.where(days) if "dt" in stored.columns else stored, min_cnt, limit)
    users = materialize(userrec.user_vector(daily, first_day, as_of), "user-vector")
    vectors = materialize(item_vectors, "item-vector")
    found = boundedtop.bounded_top(users, vectors, as_of, top, recommend_unbought) if bounded else None
    ranked = found.ranked if found else userrec.user_recommend(users, vectors, as_of, top, recommend_unbought)
    (writers.publish_tsv if publish else writers.write_tsv)(ranked_lines(ranked, "user", "item"), output, gzip=gzip)
    if found:
        found.drop()
    drop_materialized(users, vectors)
