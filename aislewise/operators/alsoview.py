"""People who looked at this also looked at: item, store and region level.

Every function takes a ``cap``: users of so many distinct items or more are left out, none where it is None. The
steps are the same at all levels: distinct units of a user are stored (``capped_units``), which also tells what the
cap leaves out; pairs are counted over item numbers; the ranked rest is named again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewise.functions import hierarchy as H
from aislewise.operators import baskets as B
from aislewise.operators.itemcodes import families, named, numbered_items, packed, unpacked
from aislewise.operators.ranking import top_k_per_group
from aislewise.session import drop_materialized, materialize
from aislewise.sources.readers import valid_interactions

TOP_ITEMS = 30
TOP_PER_STORE_ITEM = 10
TOP_PER_REGION_ITEM = 50
TOP_PER_GROUP = 30
#: Per level: characters of a family, and the others kept of each unit.
LEVELS = {
    "store": (H.STORE_FAMILY_CHARS, TOP_PER_STORE_ITEM),
    "region": (H.REGION_FAMILY_CHARS, TOP_PER_REGION_ITEM),
}


@dataclass
class CappedUnits:
    """``rows`` of users below the cap with item numbers (``no``), the numbers' ``items``, and how many ``users`` and
    ``rows_cut`` the cap left out."""

    rows: DataFrame
    items: DataFrame
    bounded: bool
    report: dict[str, int]
    stages: tuple[DataFrame, ...]

    def drop(self) -> None:
        """Deletes the stage tables, once what reads them is written."""
        drop_materialized(*self.stages)


def capped_units(
    interactions: DataFrame, cap: int | None, level: str | None = None, crawlers_first: bool = False,
) -> CappedUnits:
    """Distinct units of each user, (user, no) and at a ``level`` also (grp), with the packed family of each item.

    The units are written once: sizes, numbers and pairs read them, and the input is read in one pass.
    ``crawlers_first`` finds users who fill the log before that, in passes of their own, so that their rows are not
    shuffled to be made distinct. The cap leaves out the same users; the report tells the ``crawlers``
    among them and their raw rows.
    """
    unit = ["grp", "item"] if level else ["item"]
    rows, early = valid_interactions(interactions, level or "item"), {}
    if crawlers_first and cap is not None:
        found = B.hot_users(rows, "user", unit, cap)
        rows = rows.join(F.broadcast(found.select("user")), "user", "left_anti")  # fewer than MAX_HOT_KEYS rows
        early = found.agg(F.count(F.lit(1)).alias("crawlers"), F.coalesce(F.sum("n"), F.lit(0)).alias("crawler_rows")).first().asDict()
    stored = materialize(B.user_basket(rows, ["user"], unit), "units")
    report = B.cut_by_cap(stored, ["user"], cap) | early
    kept = B.basket_cap(stored, ["user"], cap) if report["baskets"] else stored
    items = numbered_items(stored)
    return CappedUnits(kept.join(items, "item"), items, cap is not None, report, (stored, items))


def _score(same_family: Column) -> Column:
    """Pairs within a family count twice."""
    return (F.col("cnt") * F.when(same_family, 2).otherwise(1)).alias("score")


def _with_family(rows: DataFrame) -> DataFrame:
    return rows.select("user", "no", "item", packed(H.prefix(F.col("item"), H.STORE_FAMILY_CHARS)).alias("fam"))


def _half_scores(pairs: DataFrame) -> DataFrame:
    """(no, other_no, score) from pairs with no < other_no; the family is counted with the pair it belongs to."""
    counts = pairs.groupBy("no", "other_no", "same").agg(F.count(F.lit(1)).alias("cnt"))
    return counts.select("no", "other_no", _score(F.col("same")))


def _able_rows(units: CappedUnits, min_score: int) -> DataFrame:
    """(user, no, item, fam, common): rows that can be in a pair with a score above ``min_score``.

    A score is at most twice the number of users of the rarer item, and twice only within a family. So items with
    no more than half of ``min_score`` users go with all their rows, and those with no more than
    ``min_score`` users, which are not ``common``, meet items of their own family only.
    """
    rows = _with_family(units.rows)
    if min_score <= 0:
        return rows.withColumn("common", F.lit(True))
    kept = B.supported(rows, ["user"], "no", min_score / 2)
    return kept.select("user", "no", "item", "fam", (F.col("users") > min_score).alias("common"))


def _joined_pairs(rows: DataFrame, bounded: bool) -> DataFrame:
    """(no, other_no, same): every pair of rows that may meet, for numbers so few that tasks can combine the pairs."""
    rows = rows.select("user", "no", "fam", "common")
    apart = B.basket_pairs(rows.where("common").select("user", "no", "fam"), ["user"], ["no", "fam"], bounded)
    rare = B.basket_pairs(rows, ["user", "fam"], ["no", "common"], bounded).where("not (common and other_common)")
    return apart.where("no < other_no").select("no", "other_no", (F.col("fam") == F.col("other_fam")).alias("same")).unionByName(
        rare.where("no < other_no").select("no", "other_no", F.lit(True).alias("same")))


def _may_meet(mate: Column, own: Column) -> Column:
    return (mate["common"] & own["common"]) | (mate["fam"] == own["fam"])


def _mirrored(half: DataFrame) -> DataFrame:
    both = F.array(F.struct("no", "other_no"), F.struct(F.col("other_no").alias("no"), F.col("no").alias("other_no")))
    return half.select(F.inline(both), "score")


def similar_items(units: CappedUnits, min_score: int = 0) -> DataFrame:
    """(item, other, score) above ``min_score``."""
    rows = materialize(_able_rows(units, min_score), "pair-rows")
    pairs, few = B.pair_numbers(rows, ["user"])
    if few:
        scores = _half_scores(_joined_pairs(rows, units.bounded)).where(F.col("score") > min_score)
        half = named(scores, units.items, no="item", other_no="other")
    else:  # items that are not common may meet all here: scores above the least are those within their family only
        counts = B.pair_cells(rows, units.items, ["user"], pairs).counted_once()
        drop_materialized(rows)
        same = H.prefix(F.col("item"), H.STORE_FAMILY_CHARS) == H.prefix(F.col("other"), H.STORE_FAMILY_CHARS)
        half = counts.select("item", "other", _score(same)).where(F.col("score") > min_score)
    both = F.array(F.struct("item", "other"), F.struct(F.col("other").alias("item"), F.col("item").alias("other")))
    return half.select(F.inline(both), "score")


def item_similarity(interactions: DataFrame, cap: int | None) -> DataFrame:
    """(item, other, score): co-occurrence counts, doubled within a store family."""
    return similar_items(capped_units(interactions, cap))


def ranked_items(units: CappedUnits, min_score: int = 0, top: int = TOP_ITEMS) -> DataFrame:
    """(item, rank, other, score): the ``top`` others with a score above ``min_score``."""
    rows = materialize(_able_rows(units, min_score), "pair-rows")
    plan = B.pair_plan(rows, ["user"], ["no"])
    if plan.few:
        scores = _mirrored(_half_scores(_joined_pairs(rows, units.bounded))).where(F.col("score") > min_score)
        ranked = top_k_per_group(scores, ["no"], [F.desc("score"), F.asc("other_no")], top)
    else:  # numbers follow the codes, so a family is a range of numbers
        ranges = families(units.items, H.STORE_FAMILY_CHARS)
        ranged = rows.join(ranges, H.prefix(F.col("item"), H.STORE_FAMILY_CHARS) == F.col("family")).select(
            "user", "no", "low", "high", "fam", "common")
        ranged = materialize(ranged, "ranged-rows")
        drop_materialized(rows)
        ranked = B.others_ranked(
            ranged, ["user"], ["no"], lambda mate, own: (mate["no"] != own["no"]) & _may_meet(mate, own), plan,
            units.bounded, ["low", "high", "fam", "common"], top, min_score).withColumnRenamed("other", "other_no")
    return named(ranked, units.items, no="item", other_no="other").select("item", "rank", "other", "score")


def also_view_item(interactions: DataFrame, cap: int | None, min_score: int = 0, top: int = TOP_ITEMS) -> DataFrame:
    return ranked_items(capped_units(interactions, cap), min_score, top)


def ranked_group_items(units: CappedUnits, level: str, top: int | None = None) -> DataFrame:
    """(grp, item, rank, other, score) for units of listed group and item.

    Counts pairs of one user's units listed in different groups, per bare other item;
    doubled when the other item's own prefix shares the key group's family.
    """
    chars, default = LEVELS[level]
    listed = units.rows.join(families(units.items, chars), H.prefix(F.col("grp"), chars) == F.col("family"), "left")
    rows = materialize(listed.select("user", "no", packed(F.col("grp")).alias("g"), "low", "high"), "listed-rows")
    plan = B.pair_plan(rows, ["user"], ["g", "no"])
    top = default if top is None else top
    if plan.few:
        pairs = B.basket_pairs(rows, ["user"], ["no", "g", "low", "high"], units.bounded).where("g <> other_g")
        counts = pairs.groupBy("g", "no", "low", "high", "other_no").agg(F.count(F.lit(1)).alias("cnt"))
        scores = counts.select("g", "no", "other_no", _score(F.col("other_no").between(F.col("low"), F.col("high"))))
        ranked = top_k_per_group(scores, ["g", "no"], [F.desc("score"), F.asc("other_no")], top)
    else:
        ranked = B.others_ranked(
            rows, ["user"], ["g", "no"], lambda mate, own: mate["g"] != own["g"], plan, units.bounded, ["low", "high"], top)
        ranked = ranked.withColumnRenamed("other", "other_no")
    return named(ranked.withColumn("grp", unpacked(F.col("g"))), units.items, no="item", other_no="other").select(
        "grp", "item", "rank", "other", "score")


def also_view_group_items(interactions: DataFrame, level: str, cap: int | None, top: int | None = None) -> DataFrame:
    if level not in LEVELS:
        raise ValueError(f"level must be one of {tuple(LEVELS)}, not {level!r}")
    return ranked_group_items(capped_units(interactions, cap, level), level, top)


def also_view_group(group_items: DataFrame, top: int = TOP_PER_GROUP) -> DataFrame:
    """(grp, rank, item, score) from ``also_view_group_items``: scores summed by group."""
    sums = group_items.groupBy("grp", F.col("other").alias("item")).agg(F.sum("score").alias("score"))
    return top_k_per_group(sums, ["grp"], [F.desc("score"), F.asc("item")], top)
