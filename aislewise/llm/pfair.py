"""Mixing of sources to target weights by proportionate-fair (Pfair) scheduling.

A source's documents, in a seeded random order, are cut into blocks. Block j of a source of
weight w is released at slot floor(j / w) and due at slot ceil((j + 1) / w); each slot takes
the released block with the earliest deadline. At any slot a source is less than one block
off its share. Weights are whole parts of a period, and the schedule repeats with it, so one period is
scheduled once and every block's slot follows by arithmetic. No row is dropped: where
a source has run out its slots are left out and the others keep their order.

Ranks within a source are counted in hash buckets with running sums of bucket sizes, so a
source with any share of the rows is spread over all tasks.

Defined cases: a null source is a source of its own; a source without a target weight gets
the smallest part; rows of one id stand next to each other; a null id is kept; an empty table
gives no rows.
"""

from __future__ import annotations

import heapq
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK_DOCS = 64
PERIOD = 10_000
TEMPERATURE = 0.5
BUCKET_DOCS = 2000
MAX_SOURCES = 1_000_000
SLOT_GROUP = 4096


def parts_of(weights: list[float], period: int = PERIOD) -> list[int]:
    """Whole parts of about ``period``, at least 1 each, in proportion to the weights."""
    total = sum(weights)
    period = max(period, 4 * len(weights))
    return [max(1, round(period * w / total)) for w in weights] if total > 0 else [1] * len(weights)


def schedule(parts: list[int]) -> list[tuple[int, int]]:
    """(source, block within the period) of each slot of one period, earliest deadline first."""
    period = sum(parts)
    releases: list[list[tuple[int, int, int]]] = [[] for _ in range(period)]
    for source, part in enumerate(parts):
        for block in range(part):
            releases[block * period // part].append((-(-(block + 1) * period // part), source, block))
    ready: list[tuple[int, int, int]] = []
    slots = []
    for now in range(period):
        for job in releases[now]:
            heapq.heappush(ready, job)
        _, source, block = heapq.heappop(ready)
        slots.append((source, block))
    return slots


def mix_sources(docs: DataFrame, weights: dict[str | None, float] | None = None, id_col: str = "doc_id",
                source_col: str = "source", block_docs: int = BLOCK_DOCS, seed: int = 1,
                temperature: float = TEMPERATURE, period: int = PERIOD) -> DataFrame:
    """(id, source, block, slot, position): each row's block of its source, that block's slot,
    and the row's place in the mix, from 0 without gaps.

    Without ``weights`` a source weighs its row count to the power ``temperature``. Weights
    are a setting of at most ``MAX_SOURCES`` sources.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"))
    sizes = {r["source"]: r["n"] for r in rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
             .limit(MAX_SOURCES + 1).toLocalIterator()}
    if len(sizes) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: map them to fewer before mixing")
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    least = min(weights.values(), default=1.0) if weights else 0.0
    target = [weights.get(n, least) if weights else sizes[n] ** temperature for n in names]
    parts = parts_of(target, period)
    length = sum(parts)
    places = [(names[s], block, slot) for slot, (s, block) in enumerate(schedule(parts))] if names else []
    table = spark.createDataFrame(places, "source string, nth bigint, at bigint")
    shares = spark.createDataFrame([(n, p) for n, p in zip(names, parts)], "source string, part bigint")

    buckets = max(1, ceil(sum(sizes.values()) / BUCKET_DOCS))
    order = F.xxhash64(F.lit(seed), F.col("id"))
    keyed = rows.withColumn("key", order).withColumn("bucket", F.pmod(F.shiftright("key", 8), F.lit(buckets)))
    counts = keyed.groupBy("source", "bucket").agg(F.count(F.lit(1)).alias("n"))
    base = counts.select("source", "bucket", (
        F.sum("n").over(W.partitionBy("source").orderBy("bucket")) - F.col("n")).alias("base"))
    own = keyed.withColumn("own", F.row_number().over(W.partitionBy("source", "bucket").orderBy("key", "id")) - 1)

    def same(left: DataFrame, right: DataFrame, *columns: str) -> DataFrame:
        """Inner join in which null sources are equal."""
        renamed = right.select(*[F.col(c).alias(f"_{c}") if c in columns else F.col(c) for c in right.columns])
        matched = None
        for c in columns:
            equal = left[c].eqNullSafe(renamed[f"_{c}"])
            matched = equal if matched is None else matched & equal
        return left.join(renamed, matched).drop(*[f"_{c}" for c in columns])

    ranked = same(own, base, "source", "bucket").withColumn("rank", F.col("base") + F.col("own")).select(
        "id", "source", F.floor(F.col("rank") / block_docs).alias("block"), (F.col("rank") % block_docs).alias("within"))
    blocks = same(ranked.groupBy("source", "block").agg(F.count(F.lit(1)).alias("n")), shares, "source")
    blocks = same(blocks.withColumn("nth", F.col("block") % F.col("part")), table, "source", "nth").select(
        "source", "block", "n", (F.floor(F.col("block") / F.col("part")) * length + F.col("at")).alias("slot"))
    grouped = blocks.withColumn("group", F.floor(F.col("slot") / SLOT_GROUP))
    ahead = grouped.groupBy("group").agg(F.sum("n").alias("n"))
    # One row for each few thousand blocks: their running sum is small.
    ahead = ahead.select("group", (F.sum("n").over(W.orderBy("group")) - F.col("n")).alias("ahead"))
    begun = grouped.withColumn("before", F.sum("n").over(W.partitionBy("group").orderBy("slot")) - F.col("n"))
    begun = begun.join(ahead, "group").select(
        "source", "block", "slot", (F.col("ahead") + F.col("before")).alias("first"))
    return same(ranked, begun, "source", "block").select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "block", "slot",
        (F.col("first") + F.col("within")).alias("position"))


def target_shares(weights: dict[str | None, float], period: int = PERIOD) -> dict[str | None, float]:
    """Share of the slots that each source is given."""
    names = sorted(weights, key=lambda s: (s is None, s or ""))
    parts = parts_of([weights[n] for n in names], period)
    return {n: p / sum(parts) for n, p in zip(names, parts)}


def with_shares(mixed: DataFrame, weights: dict[str | None, float], source_col: str = "source", period: int = PERIOD) -> DataFrame:
    """``mixed`` with ``target_share`` and ``achieved_share``, the source's share of the slots up to and with the row's own.

    ``weights`` name every source of the mix. Until sources run out the two differ by less than one block.
    """
    shares = target_shares(weights, period)
    table = mixed.sparkSession.createDataFrame(list(shares.items()), "name string, target_share double")
    joined = mixed.join(table, mixed[source_col].eqNullSafe(table["name"])).drop("name")
    return joined.withColumn("achieved_share", (F.col("block") + 1) / (F.col("slot") + 1))


def unused(columns: list[str], name: str) -> str:
    """``name``, made longer until no column has it."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def with_position(rows: DataFrame, mixed: DataFrame, id_col: str = "doc_id", name: str = "position") -> DataFrame:
    """``rows`` with the first position of their id in the mix under ``name``."""
    key = unused([*rows.columns, name], "mixed_id")
    place = mixed.groupBy(F.col(id_col).alias(key)).agg(F.min("position").alias(name))
    return rows.join(place, rows[f"`{id_col}`"].eqNullSafe(place[key])).drop(key)


def in_mixed_order(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` sorted by their place in the mix; rows of one id share the first place."""
    name = unused(docs.columns, "mixed_position")
    return with_position(docs, mixed, id_col, name).orderBy(name).select(*[F.col(f"`{c}`") for c in docs.columns])
