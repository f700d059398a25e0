"""Clicks, purchases, and the mapping from browser ids (uid) to customer ids (eid)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislewise.functions import hierarchy as H
from aislewise.functions import logline as L


def click_events(lines: DataFrame, cart_actions: list[str] | None = None) -> DataFrame:
    """View and cart clicks as (..., uid, item, kind), from lines with a ``line`` column.

    Every beacon counts as a cart click whatever its action, unless ``cart_actions``
    names the actions to keep.
    """
    line = F.col("line")
    kept = [c for c in lines.columns if c != "line"]
    clicks = lines.where(
        (line.contains(L.VIEW_PATH) | line.contains(L.BEACON_PATH)) & ~L.is_recommend_bot(line)
    )
    # The generator keeps the decoded text from being computed again by the filter.
    requests = clicks.select(
        *kept, L.click_kind(line).alias("kind"), F.explode(F.array(L.click_request(line))).alias("request")
    )
    found = requests.select(
        *kept, "kind", "request",
        F.inline(F.array(F.struct(
            L.click_uid(F.col("request")).alias("uid"), L.click_item(F.col("request")).alias("item")))),
    ).where((F.col("uid") != "") & (F.col("item") != ""))
    if cart_actions is not None:
        action = F.regexp_extract("request", '"Action":"([^"]*)"', 1)
        found = found.where((F.col("kind") == "view") | action.isin(*cart_actions))
    return found.select(*kept, "uid", "item", "kind")


def uid_eid_pairs(lines: DataFrame) -> DataFrame:
    """(..., uid, eid) of identity requests that carry both."""
    line = F.col("line")
    kept = [c for c in lines.columns if c != "line"]
    requests = lines.where(line.contains(L.UIDMAP_PATH) & ~L.is_recommend_bot(line))
    return requests.select(
        *kept, L.uidmap_field(line, "uid").alias("uid"), L.uidmap_field(line, "eid").alias("eid")
    ).where((F.col("uid") != "") & (F.col("eid") != ""))


def shopper_requests(lines: DataFrame) -> DataFrame:
    """Clicks and identity pairs of one pass over the log, as (..., kind, uid, value).

    ``value`` is the item of a view or cart click, or the eid of kind ``eid``: the same rows
    as ``click_events`` and ``uid_eid_pairs`` together, for jobs that need both.
    """
    line = F.col("line")
    kept = [c for c in lines.columns if c != "line"]
    is_map = line.contains(L.UIDMAP_PATH)
    hits = lines.where(
        (line.contains(L.VIEW_PATH) | line.contains(L.BEACON_PATH) | is_map) & ~L.is_recommend_bot(line)
    )
    decoded = hits.select(*kept, "line", F.explode(F.array(L.click_request(line))).alias("request"))
    click = F.struct(
        L.click_kind(line).alias("kind"), L.click_uid(F.col("request")).alias("uid"),
        L.click_item(F.col("request")).alias("value"),
    )
    pair = F.struct(
        F.lit("eid").alias("kind"), F.when(is_map, L.uidmap_field(line, "uid")).alias("uid"),
        F.when(is_map, L.uidmap_field(line, "eid")).alias("value"),
    )
    return decoded.select(*kept, F.inline(F.array(click, pair))).where(
        F.col("kind").isNotNull() & (F.col("uid") != "") & (F.col("value") != "")
    )


def clicks_of(requests: DataFrame) -> DataFrame:
    return requests.where(F.col("kind") != "eid").withColumnRenamed("value", "item")


def pairs_of(requests: DataFrame) -> DataFrame:
    return requests.where(F.col("kind") == "eid").drop("kind").withColumnRenamed("value", "eid")


def purchases_on_day(purchases: DataFrame, day: str | None = None) -> DataFrame:
    """(dt, user, item) of purchases, of one day (yyyyMMdd) or of all."""
    day_text = F.substring("order_no", 1, 8)
    rows = purchases if day is None else purchases.where(day_text == day)
    return rows.select(
        F.expr("CAST(try_to_timestamp(substring(order_no, 1, 8), 'yyyyMMdd') AS DATE)").alias("dt"),
        F.concat(F.lit("eid:"), "eid").alias("user"),
        H.item_of_sku(F.col("item_sku")).alias("item"),
    ).where(F.col("dt").isNotNull() & F.col("user").isNotNull() & F.col("item").isNotNull())


def identity_map(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """One eid per uid; of several the largest."""
    return pairs.groupBy(*keys, "uid").agg(F.max("eid").alias("eid"))


def identity_resolve(rows: DataFrame, pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Replaces ``uid`` by ``user``: ``eid:<eid>`` where known (per ``keys``), else ``uid:<uid>``.

    No broadcast is asked for: the map grows with the shoppers, so its measured size decides.
    """
    mapping = identity_map(pairs, keys)
    user = F.when(F.col("eid").isNotNull(), F.concat(F.lit("eid:"), "eid")).otherwise(
        F.concat(F.lit("uid:"), "uid")
    )
    joined = rows.join(mapping, [*keys, "uid"], "left")
    return joined.select(*[c for c in rows.columns if c != "uid"], user.alias("user"))


def uid_eid_sets(lines: DataFrame) -> DataFrame:
    """Distinct (uid, kind, value): the eids and the beacon actions seen with each uid.

    Long rows rather than one array per uid, since a shared uid has no bound on its eids.
    """
    line = F.col("line")
    kept = lines.where((line.contains(L.UIDMAP_PATH) | L.is_beacon(line)) & ~L.is_stats_bot(line))
    parsed = kept.select("line", F.inline(F.array(L.payload(line))))
    is_identity = line.rlike('"GET ' + L.UIDMAP_PATH + '[^"]+"')
    seen = F.array(
        F.struct(
            F.when(is_identity, L.uidmap_field(line, "uid", closed=True)).alias("uid"),
            F.lit("eid").alias("kind"),
            F.when(is_identity, L.uidmap_field(line, "eid", closed=True)).alias("value"),
        ),
        F.struct(F.col("Uid").alias("uid"), F.lit("action").alias("kind"), F.col("Action").alias("value")),
    )
    # An empty match of the identity request means the field was not there.
    found = parsed.select(F.inline(seen)).where(
        F.col("uid").isNotNull() & F.col("value").isNotNull()
        & ~((F.col("kind") == "eid") & ((F.col("uid") == "") | (F.col("value") == "")))
    )
    return found.distinct()
