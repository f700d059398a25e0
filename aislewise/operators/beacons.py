"""Beacon lines of the access log, parsed once into typed columns."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from aislewise.functions import logline as L


ACCEPTED = "accepted"
#: Why a beacon line is skipped, in the order in which reasons are tried.
SKIP_REASONS = ("bad_escapes", "no_request", "bad_json", "no_site")


def parse_beacons(lines: DataFrame) -> DataFrame:
    """Non-bot beacon lines with their JSON fields as uid, site, page, action, prod.

    All input columns stay. Rows without a readable site are dropped. The JSON struct is
    expanded by a generator, so filters on its fields do not repeat the parsing.
    """
    beacons = lines.where(L.is_beacon(F.col("line")) & ~L.is_stats_bot(F.col("line")))
    parsed = beacons.select("*", F.inline(F.array(L.payload(F.col("line")))))
    return parsed.where(F.col("Site").isNotNull()).select(
        *[F.col(c) for c in lines.columns],
        F.col("Uid").alias("uid"), F.col("Site").alias("site"), F.col("Page").alias("page"),
        F.col("Action").alias("action"), F.col("Prod").alias("prod"),
    )


class LineAccount:
    """How many lines were read, left out as other requests or crawlers, accepted, and skipped for each reason.

    The numbers come from the pass that parses the lines. Spark may count the rows of a task twice that it has to
    run again after losing an executor; the stored rows themselves are exact.
    """

    def __init__(self) -> None:
        self.lines = Observation(f"lines-{uuid.uuid4().hex}")
        self.beacons = Observation(f"beacons-{uuid.uuid4().hex}")

    def counts(self) -> dict[str, int]:
        """Waits for the first action on the rows."""
        return {**self.lines.get, **self.beacons.get}


def judged_lines(lines: DataFrame) -> tuple[DataFrame, LineAccount]:
    """Non-bot beacon lines with the JSON fields of ``parse_beacons`` and ``reason``, and the account of all lines.

    ``reason`` is the first of ``SKIP_REASONS`` that holds: the payload is not URL-encoded, there is no GET
    request with a closed payload, it is not JSON, it names no site. Accepted rows are those of ``parse_beacons``.
    The account is filled by the first action on the rows, in the same pass.
    """
    account = LineAccount()
    bot = F.explode(F.array(F.when(L.is_beacon(F.col("line")), L.is_stats_bot(F.col("line"))))).alias("_bot")
    seen = lines.select("*", bot).observe(
        account.lines, F.count(F.lit(1)).alias("lines"), F.count("_bot").alias("beacons"), F.count_if("_bot").alias("bots"))
    beacons = seen.where("not _bot").drop("_bot")
    text = F.explode(F.array(L.request_payload(F.col("line")))).alias("_payload")
    read = beacons.select("*", text).select("*", F.inline(F.array(L.checked_payload(F.col("_payload")))))
    reason = (
        F.when(F.col("_payload").isNull(), SKIP_REASONS[0]).when(F.col("_payload") == "", SKIP_REASONS[1])
        .when(F.col(L.BROKEN).isNotNull(), SKIP_REASONS[2]).when(F.col("Site").isNull(), SKIP_REASONS[3])
        .otherwise(ACCEPTED)
    )
    judged = read.select(
        *[F.col(c) for c in lines.columns],
        F.col("Uid").alias("uid"), F.col("Site").alias("site"), F.col("Page").alias("page"),
        F.col("Action").alias("action"), F.col("Prod").alias("prod"), reason.alias("reason"),
    )
    counts = [F.count_if(F.col("reason") == r).alias(r) for r in (ACCEPTED, *SKIP_REASONS)]
    return judged.observe(account.beacons, *counts), account


def with_device(beacons: DataFrame) -> DataFrame:
    lowered = beacons.withColumn("lower_line", F.lower("line"))
    device = L.device_class(F.col("lower_line"), L.client_ip(F.col("line")))
    return lowered.withColumn("device", device).drop("lower_line")


def is_store_page_view() -> Column:
    return (F.col("page") == "store") & (F.col("action") == "pageview")


def order_stat_category(site: Column, page: Column, action: Column) -> Column:
    """Column of the orders-against-views report that an event counts for, or NULL."""
    viewed = action == "pageview"
    return (
        F.when((site == "24h") & (page == "store") & viewed, "24h_store")
        .when((site == "ecshop") & (page == "store") & viewed, "ecshop_store")
        .when((site == "books") & viewed, "books")
        .when((site == "mobile") & viewed, "mobile")
        .when((page == "activity") & viewed, "activity")
        .when((page == "onsale") & viewed, "onsale")
        .when((page == "checkout") & (action == "order"), "order")
        .when((page == "store") & viewed, "global_store")
    )


def pv_category(site: Column, page: Column) -> Column:
    """Row of the category report that a page view counts for: struct (site, page)."""

    def row(site_text: str, page_text: str) -> Column:
        return F.struct(F.lit(site_text).alias("site"), F.lit(page_text).alias("page"))

    return (
        F.when((site == "24h") & (page == "store"), row("24h", "store"))
        .when((site == "ecshop") & (page == "store"), row("ecshop", "store"))
        .when(site == "books", row("books", "all_page"))
        .when(site == "mobile", row("mobile", "all_page"))
        .when(page == "store", row("residue_site", "store"))
        .when(page == "activity", row("residue_site", "activity"))
        .otherwise(row("else_site", "else_page"))
    )
