"""Baskets (distinct items of a user) and co-occurrence of items within them."""

from __future__ import annotations

import functools
import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aislewise.operators import pairkernels
from aislewise.operators.itemcodes import numbered_items
from aislewise.operators.ranking import top_k_per_group
from aislewise.operators.skew import BLOCK_ROWS, blocks_of, cell_join, fan_out
from aislewise.session import drop_materialized, materialize, shuffles_deleted
from aislewise.shipping import map_batches

CAP_PER_MONTH = 300
SHORT_RANGE_CAP = 900
SIMILARITY_CAP = 1000
BLOCK_ITEMS = BLOCK_ROWS
MAX_HOT_KEYS = 10_000
#: Slots of the sketch of rows per user, and of the bitmaps of their units (the size Spark's bitmaps have).
SKETCH_SLOTS = 1 << 16
BITMAP_BITS = 1 << 15
#: Pairs aimed at in a task that counts them, and in one that writes them out for those tasks.
TASK_PAIRS = 2_000_000
SENT_PAIRS = 32_000_000
#: Lists are made in rounds of units. A round sends so many pairs, or so many for each row of the baskets, if these are more.
ROUND_PAIRS = 200_000_000
ROUND_SHARE = 8
#: Pairs aimed at in a cell of two parts of the items, and names sent in a row.
CELL_PAIRS = 24_000_000
NAMES_SENT = 4096
#: Up to so many different pairs, every task that joins them has room for all their counts.
FEW_PAIRS = 4_000_000
#: Pruning stops when a round takes less than this share of the rows.
PRUNE_SHARE = 0.01
PRUNE_ROUNDS = 6


def user_basket(rows: DataFrame, keys: list[str], unit: list[str]) -> DataFrame:
    """Distinct units per basket, in long form."""
    return rows.select(*keys, *unit).distinct()


def basket_limit(months: int) -> int:
    """Basket size at which a user is left out, for input of that many months."""
    return CAP_PER_MONTH * months if months > 3 else SHORT_RANGE_CAP


def hot_users(rows: DataFrame, user: str, unit: list[str], cap: int) -> DataFrame:
    """(user, n): users with more than one in ``MAX_HOT_KEYS`` of all ``rows`` that surely have ``cap`` units or more.

    Found before any distinct: rows are counted in ``SKETCH_SLOTS`` slots by hash, then exactly for the users of
    full slots; units of the fewer than ``MAX_HOT_KEYS`` users left are marked in bitmaps by hash, whose marks never exceed
    the units. All three are aggregations with map-side combining; what is broadcast is bounded by counting. A hot
    user with few units, or with more units than a bitmap can tell apart, is left to the exact cap.
    """
    slot = F.pmod(F.xxhash64(user), F.lit(SKETCH_SLOTS)).alias("slot")
    keyed = rows.select(user, *unit, slot)
    slots = keyed.groupBy("slot").agg(F.count(F.lit(1)).alias("n"))
    total = slots.agg(F.sum("n")).scalar()
    full = F.broadcast(slots.where(F.col("n") * MAX_HOT_KEYS > total).select("slot"))
    counts = keyed.join(full, "slot", "left_semi").groupBy(user).agg(F.count(F.lit(1)).alias("n"))
    hot = materialize(counts.where(F.col("n") * MAX_HOT_KEYS > total), "hot-users")
    mark = F.pmod(F.xxhash64(*unit), F.lit(BITMAP_BITS))
    marks = rows.join(F.broadcast(hot), user).groupBy(user, "n").agg(F.bitmap_count(F.bitmap_construct_agg(mark)).alias("marks"))
    return materialize(marks.where(F.col("marks") >= cap).select(user, "n"), "crawlers")


def cut_by_cap(baskets: DataFrame, keys: list[str], cap: int | None) -> dict[str, int]:
    """How many baskets and rows ``basket_cap`` leaves out."""
    if cap is None:
        return {"baskets": 0, "rows": 0}
    sizes = baskets.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= cap)
    found = sizes.agg(F.count(F.lit(1)).alias("baskets"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    return found.asDict()


def basket_cap(baskets: DataFrame, keys: list[str], cap: int | None) -> DataFrame:
    """Baskets of fewer than ``cap`` units; all of them where it is None.

    Sizes are counted with map-side combining. Full baskets that hold more than one in
    ``MAX_HOT_KEYS`` of all rows are fewer than that many, so they are dropped by a
    broadcast, and no hot user's rows are ever moved together. The others follow by a
    plain anti join on the basket keys.
    """
    if cap is None:
        return baskets
    sizes = baskets.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.sum("n")).scalar()
    full = sizes.where(F.col("n") >= cap)
    hottest = full.where(F.col("n") * MAX_HOT_KEYS > total)
    return baskets.join(F.broadcast(hottest.select(*keys)), keys, "left_anti").join(
        full.select(*keys), keys, "left_anti"
    )


def _other(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[F.col(n).alias(f"other_{n}") if n in names else F.col(n) for n in df.columns])


def basket_pairs(
    baskets: DataFrame, keys: list[str], unit: list[str], bounded: bool, block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """Self-join of baskets: unit columns of one row beside ``other_`` columns of another.

    ``bounded`` says that basket sizes have been capped, then a plain join on the basket
    keys is even enough. Otherwise baskets above ``block_items`` are cut into blocks on both
    sides, and each pair of blocks is joined on its own.
    """
    if bounded:
        rows = fan_out(baskets, keys)
        return rows.join(_other(rows, unit), keys)
    return cell_join(baskets, _other(baskets, unit), keys, unit, [f"other_{u}" for u in unit], block_items)


@dataclass
class PairPlan:
    """How many ordered ``pairs`` baskets hold, whether they are ``few`` different ones, and the ``hot`` units (unit...,
    _slices), whose pairs are too many for one task; None where there are none."""

    pairs: int
    few: bool
    hot: DataFrame | None

    def parts(self, rows: DataFrame, each: int) -> int:
        return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-self.pairs // each))


def pair_plan(
    rows: DataFrame, keys: list[str], unit: list[str], per: list[str] | None = None,
) -> PairPlan:
    """Counted from stored ``rows``: a unit has as many pairs as its baskets have rows."""
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    weights = rows.join(sizes, keys).groupBy(*unit).agg(F.sum("_n").alias("_n"))
    per = per or []
    totals = weights.groupBy(*per).agg(
        F.count(F.lit(1)).cast("double").alias("units"), F.sum("_n").alias("pairs"), F.count_if(F.col("_n") > TASK_PAIRS).alias("hot"))
    with shuffles_deleted(rows.sparkSession):
        found = totals.agg(
            F.sum(F.col("units") * F.col("units")).alias("kinds"), F.sum("pairs").alias("pairs"), F.sum("hot").alias("hot")).first()
    hot = weights.where(F.col("_n") > TASK_PAIRS).select(*unit, F.ceil(F.col("_n") / TASK_PAIRS).cast("int").alias("_slices"))
    return PairPlan(
        found["pairs"] or 0, (found["kinds"] or 0) <= FEW_PAIRS, materialize(hot, "hot-units") if found["hot"] else None)


def pair_numbers(rows: DataFrame, keys: list[str], per: list[str] | None = None) -> tuple[int, bool]:
    """How many ordered pairs baskets of stored ``rows`` (keys..., item) hold, and whether they are few different ones, as
    far as estimated counts of the items tell."""
    pairs = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.sum(F.col("n") * F.col("n")).alias("pairs"))
    units = rows.groupBy(*(per or [])).agg(F.approx_count_distinct("item").cast("double").alias("units"))
    with shuffles_deleted(rows.sparkSession):
        kinds = units.agg(F.sum(F.col("units") * F.col("units"))).first()[0] or 0
        return pairs.first()["pairs"] or 0, kinds <= FEW_PAIRS


def _mates(
    rows: DataFrame, keys: list[str], own: list[str], bounded: bool, plan: PairPlan, block_items: int,
) -> DataFrame:
    """(_rows, _mates): arrays of rows of one basket, and of those they meet; large baskets in pairs of blocks."""
    row = F.collect_list(F.struct(*own)).alias("_rows")
    parts = plan.parts(rows, SENT_PAIRS)
    rows = rows.dropna(subset=keys)
    if bounded:
        return rows.repartition(parts, *keys).groupBy(*keys).agg(row).select("_rows", F.col("_rows").alias("_mates"))
    blocks = F.coalesce("_blocks", F.lit(1))
    cut = rows.join(blocks_of(rows, keys, block_items, "_blocks"), keys, "left").select(*keys, *own, blocks.alias("_blocks"))
    block = F.pmod(F.xxhash64(*own), F.col("_blocks")).cast("int").alias("_i")
    boxes = cut.groupBy(*keys, "_blocks", block).agg(row)
    every = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    at = [*keys, "_i", "_j"]
    left = boxes.select(*keys, "_i", every.alias("_j"), "_rows").repartition(parts, *at)
    right = boxes.select(*keys, F.col("_i").alias("_j"), every.alias("_i"), F.col("_rows").alias("_mates")).repartition(parts, *at)
    return left.join(right, at).select("_rows", "_mates")


def others_ranked(
    rows: DataFrame, keys: list[str], unit: list[str], chosen: Callable[[Column, Column], Column], plan: PairPlan, bounded: bool,
    carry: list[str], top: int, min_score: int = 0, block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """(unit..., other, score, rank) over numbers: the ``top`` others ``no`` by how often each unit meets them in baskets, twice
    that for those from the unit's ``low`` to its ``high``, above ``min_score``; ``chosen(mate, own)`` tells which mates
    count, and ``carry`` are columns that follow from the unit.

    A unit is sent to its task with an array of the others of a basket, so a pair costs one value of the array and no row;
    it is counted and ranked there in bounded steps (``pairkernels``). Tasks are as many as the counted pairs ask for. Hot units
    are cut into slices by their others, so no task gets much more than ``TASK_PAIRS``. As what is sent grows with the pairs,
    it is done for some of the units at a time, in rounds whose lists are stored; the stored ``rows`` are deleted then.
    """
    own = list(dict.fromkeys([*unit, *carry, "no"]))
    mates = _mates(rows, keys, own, bounded, plan, block_items)
    rounds = max(1, -(-plan.pairs // max(ROUND_PAIRS, ROUND_SHARE * rows.count())))
    if rounds > 1:
        stored = materialize(mates.select("_rows") if bounded else mates, "mates")
        mates = stored.withColumn("_mates", F.col("_rows")) if bounded else stored

    def lists(turn: int) -> DataFrame:
        met = mates.select(F.explode("_rows").alias("_own"), "_mates")
        if rounds > 1:
            met = met.where(F.pmod(F.xxhash64(*[F.col("_own")[c] for c in unit], F.lit("round")), F.lit(rounds)) == turn)
        wanted = F.transform(F.filter("_mates", lambda mate: chosen(mate, F.col("_own"))), lambda mate: mate["no"])
        sent = met.select(*[F.col("_own")[c].alias(c) for c in [*unit, "low", "high"]], wanted.alias("others"))
        at = list(unit)
        if plan.hot is not None:
            slices = F.coalesce("_slices", F.lit(1))
            sent = sent.join(F.broadcast(plan.hot), unit, "left").withColumn("_slice", F.explode(F.sequence(F.lit(0), slices - 1)))
            part = F.filter("others", lambda x: F.pmod(F.xxhash64(x), F.col("_slices")) == F.col("_slice"))
            sent = sent.withColumn("others", F.when(F.col("_slices").isNull(), F.col("others")).otherwise(part)).drop("_slices")
            at.append("_slice")
        dealt = sent.repartition(plan.parts(rows, TASK_PAIRS * rounds), *at)
        schema = ", ".join(f"{c} bigint" for c in [*unit, "other", "score"]) + ", rank int"
        return map_batches(dealt, pairkernels.ranked_others(unit, top, min_score), schema)

    if rounds == 1:
        ranked = lists(0)
    else:
        ranked = functools.reduce(DataFrame.unionByName, [materialize(lists(turn), "ranked-others") for turn in range(rounds)])
        drop_materialized(stored, rows)
    if plan.hot is not None:
        ranked = top_k_per_group(ranked.drop("rank"), unit, [F.desc("score"), F.asc("other")], top)
    return ranked


@dataclass
class PairCells:
    """Baskets cut into cells of two parts of the items (``pair_cells``): ``dealt`` rows, a cell a task, of ``parts`` parts.
    ``groups`` (grp, per...) names the groups of baskets."""

    dealt: DataFrame
    parts: int
    pairs: int
    items: DataFrame
    groups: DataFrame
    per: list[str]
    baskets: DataFrame

    def counted_once(self) -> DataFrame:
        """(per..., item, other, cnt): every pair in one direction only."""
        kind = self.items.schema["item"].dataType.simpleString()
        counts = map_batches(self.dealt, pairkernels.count_cells, f"grp int, item {kind}, other {kind}, cnt bigint")
        if not self.per:
            return counts.drop("grp")
        return counts.join(self.groups, "grp").select(*self.per, "item", "other", "cnt")

    def vectors(self, min_cnt: int, limit: int | None) -> DataFrame:
        """(no, n, at, others, cnts): the counts summed over all groups, as ``pairkernels.whole_vectors`` has them.

        All of a pair's counts are in one cell, so their sums are made there."""
        parts = map_batches(self.dealt, pairkernels.vector_parts(self.parts, min_cnt), "no int, others array<int>, cnts array<bigint>")
        tasks = max(int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-self.pairs // TASK_PAIRS))
        return map_batches(
            parts.repartition(tasks, "no"), pairkernels.whole_vectors(limit, BLOCK_ROWS),
            "no int, n int, at int, others array<int>, cnts array<bigint>")

    def drop(self) -> None:
        drop_materialized(self.baskets)


def pair_cells(rows: DataFrame, items: DataFrame, keys: list[str], pairs: int, per: list[str] | None = None) -> PairCells:
    """Deals baskets (keys..., no) for counting how often two items meet in one.

    Items are dealt into parts, and two parts are a cell: a task that gets what each basket has of both, with the names
    of both, counts its pairs in bounded steps (``pairkernels``) and names them. A basket is sent once per part that it
    has items in, not once per item, and no pair is shuffled, sorted on disk or stored. Cells are as many as
    the counted ``pairs`` ask for. A basket is a row here: far less than its pairs, which are all in the result.
    """
    per = per or []
    kept = rows.dropna(subset=keys)
    groups = kept.select(*per).distinct().withColumn("grp", F.row_number().over(Window.orderBy(*per))) if per else None
    if per:  # few: the groups that stay in the result
        groups = materialize(groups, "basket-groups")
        kept = kept.join(groups, per)
    grp = F.first("grp") if per else F.lit(0)
    nos = kept.groupBy(*keys).agg(grp.alias("grp"), F.collect_list("no").alias("nos"))
    stored = materialize(nos.where(F.size("nos") > 1).select("grp", "nos"), "pair-baskets")
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = math.ceil(math.sqrt(max(pairs / CELL_PAIRS, 2 * least)))
    sent = map_batches(
        stored, pairkernels.cell_rows(parts), ", ".join(f"{c} {'int' if c == 'cell' else 'binary'}" for c in pairkernels.CELL_COLUMNS))
    local = F.floor(F.col("no") / parts).cast("int")
    names = items.groupBy(F.pmod("no", F.lit(parts)).cast("int").alias("part"), F.floor(local / NAMES_SENT).alias("chunk")).agg(
        F.collect_list(F.struct(local.alias("no"), "item")).alias("names"))
    met = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    low, high = F.least("part", "met"), F.greatest("part", "met")
    told = names.withColumn("met", met).select(
        (F.floor(high * (high + 1) / 2) + low).cast("int").alias("cell"), (F.col("part") > F.col("met")).cast("int").alias("side"), "names")
    dealt = sent.unionByName(told, allowMissingColumns=True).repartitionById(parts * (parts + 1) // 2, "cell")
    return PairCells(dealt, parts, pairs, items, groups, per, stored)


def cooccurrence(
    baskets: DataFrame, keys: list[str], bounded: bool, per: list[str] | None = None,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """(per..., item, other, cnt) for all ordered pairs of distinct items of one basket.

    Counts are symmetric: only pairs with item < other are counted, and the finished counts are mirrored.
    Where there are few different pairs they are combined in the task that joins them and only partial counts are
    shuffled; else parts of baskets are (``pair_cells``). ``per`` names basket keys that stay in the result, with few values.
    """
    per = per or []
    rows = materialize(baskets.select(*keys, "item"), "basket-rows")
    pairs, few = pair_numbers(rows, keys, per)
    if few:
        return count_pairs(basket_pairs(rows, keys, ["item"], bounded, block_items).where("item < other_item"), per)
    items = numbered_items(rows.dropna(subset=["item"]))
    cells = pair_cells(rows.join(items, "item"), items, keys, pairs, per)
    drop_materialized(rows)
    counted = mirrored_counts(cells.counted_once().withColumnRenamed("other", "other_item"), per)
    counted._cells = cells
    return counted


def count_pairs(pairs: DataFrame, per: list[str] | None = None) -> DataFrame:
    """(per..., item, other, cnt) in both directions, from pairs with item < other_item."""
    per = per or []
    return mirrored_counts(pairs.groupBy(*per, "item", "other_item").agg(F.count(F.lit(1)).alias("cnt")), per)


def mirrored_counts(half: DataFrame, per: list[str]) -> DataFrame:
    """(per..., item, other, cnt) in both directions, from counts with item < other_item."""
    both = F.array(
        F.struct(F.col("item"), F.col("other_item").alias("other")),
        F.struct(F.col("other_item").alias("item"), F.col("item").alias("other")),
    )
    return half.select(*per, F.inline(both), "cnt")


def supported(baskets: DataFrame, keys: list[str], item: str, more_than: float) -> DataFrame:
    """Rows that can be in a pair counted more than ``more_than`` times, with ``users``, the baskets of their ``item``.

    A pair is in no more baskets than either item, so items in too few baskets go; then baskets left with one
    item, which lowers the counts of others. Rounds go on while they pay: each is exact, so stopping early
    only leaves rows that make no result. The rounds are written tables, and items are counted with map-side
    combining; the last table is left to the lazy result.
    """
    rows = materialize(baskets, "supported")
    left = rows.count()
    for _ in range(PRUNE_ROUNDS):
        items = rows.groupBy(item).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > more_than)
        frequent = rows.join(items.select(item), item, "left_semi")
        several = frequent.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        kept = materialize(frequent.join(several.select(*keys), keys, "left_semi"), "supported")
        drop_materialized(rows)
        rows, before, left = kept, left, kept.count()
        if before - left <= PRUNE_SHARE * before:
            break
    return rows.join(rows.groupBy(item).agg(F.count(F.lit(1)).alias("users")), item)
