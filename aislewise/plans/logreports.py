"""Log report jobs: parse once, then page views, categories, orders and rankings."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aislewise.functions import periods as P
from aislewise.operators import apitraffic, identity, logstats, storerank
from aislewise.operators.beacons import ACCEPTED, judged_lines, parse_beacons
from aislewise.session import drop_materialized, materialize, stage_tables
from aislewise.sources import readers, writers


def stored_beacons(lines: DataFrame, quarantine: str | None = None) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """(stored table, accepted beacons, account of all lines) from one pass over the log.

    Skipped lines are stored beside the accepted ones by reason, and published as a table at
    ``quarantine`` if that is given.
    """
    judged, account = judged_lines(lines)
    stored = materialize(judged, "beacons", partition_by=["reason"])
    if quarantine:
        skipped = stored.where(F.col("reason") != ACCEPTED).select(*lines.columns, "reason")
        writers.publish_table(skipped, quarantine, {"account": account.counts()})
    return stored, stored.where(F.col("reason") == ACCEPTED).drop("reason"), account.counts()


def page_view_reports(
    spark: SparkSession, log_paths: str | list[str], item_dim: DataFrame, store_dim: DataFrame, output: str,
    quarantine: str | None = None,
) -> dict[str, int]:
    """Writes page-view, category, order and store-rank reports below ``output``; returns the account of lines.

    The parsed beacons are stored once, since four reports scan them; lines that could not be read go to the
    table ``quarantine``, with the reason.
    """
    lines = readers.read_access_log(spark, log_paths)
    stored, beacons, account = stored_beacons(lines, quarantine)
    hits = materialize(logstats.page_view_hits(beacons), "page-view-hits")
    categories = logstats.category_page_views(hits).orderBy("row_no").drop("row_no")
    orders = logstats.order_vs_page_views(beacons, item_dim, store_dim)
    ranks = storerank.wide_ranks(storerank.store_page_rank(beacons, store_dim), [])
    writers.write_tsv(hits, f"{output}/page_view_hits", header=True)
    writers.write_tsv(categories, f"{output}/category_page_views", header=True)
    writers.write_tsv(orders.orderBy(F.desc("order"), "store_no"), f"{output}/order_vs_page_views", header=True)
    writers.write_tsv(ranks.orderBy("rank"), f"{output}/store_page_rank", header=True)
    drop_materialized(stored, hits)
    return account


def store_day_job(spark: SparkSession, log_paths: str | list[str], item_dim: DataFrame, table: str) -> None:
    """Uncut daily store counts of ``dt`` log folders, as partitions of ``table``."""
    beacons = parse_beacons(readers.read_access_log(spark, log_paths))
    writers.write_table(storerank.store_page_daily_counts(beacons, item_dim), table, by_day=True)


def store_rank_job(
    spark: SparkSession, table: str, store_dim: DataFrame, output: str, mode: str, as_of: date,
    threshold: int | None = None,
) -> None:
    """Ranking report of the day, week, month or season of ``as_of`` from the daily counts."""
    if mode not in P.MODES:
        raise ValueError(f"mode must be one of {P.MODES}, not {mode!r}")
    if threshold is None:
        threshold = storerank.DAILY_THRESHOLD if mode == "day" else storerank.PERIOD_THRESHOLD
    days = storerank.select_period(spark.read.parquet(table), as_of, mode)
    with stage_tables():
        ranked = storerank.store_page_rank_period(days, store_dim, mode, threshold)
        wide = storerank.wide_ranks(ranked, ["period_start"]).drop("period_start")
        writers.write_tsv(wide.orderBy("rank"), output, header=True)


def uid_eid_job(spark: SparkSession, log_paths: str | list[str], output: str) -> None:
    writers.write_tsv(identity.uid_eid_sets(readers.read_access_log(spark, log_paths)), output)


def api_traffic_job(
    spark: SparkSession, log_paths: str | list[str], output: str, domain: str, year: int, hosts: str
) -> None:
    """``hosts``: pattern of the machine names to be listed."""
    lines = readers.read_access_log(spark, log_paths)
    traffic = apitraffic.api_traffic_per_minute(apitraffic.api_line_fields(lines, domain, year))
    writers.write_lines(apitraffic.api_traffic_lines(traffic, hosts), output)
