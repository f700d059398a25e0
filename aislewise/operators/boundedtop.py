"""Exact top items per user without making products that cannot reach the last rank.

A score is a sum of products, user interest times pair count, over the user's items. The
partners of an item are cut into blocks by the power of two of their count, so the largest count
of a block bounds its products. Read in order of that bound, a user's blocks give

* after some of them, a lower bound of the score at the last rank: the partial sum there;
* for what is unread, an upper bound of what any partner can still gain: for every item of the
  user the interest times the largest unread count.

Round one reads the blocks of largest products until they hold a few times as many products
as there are ranks. Its lower bound tells how far round two must read so that no partner met in neither
round can reach the last rank. Partners whose partial sum and unread gain stay below the bound are
dropped; the others get what they lack, by looking up their own counts or, where that would be more
rows, by reading the rest. Both ways are exact, and the rows are those of the plain product.

A user whose rounds would read more than ``WHOLE_SHARE`` of all their products, as where counts hardly differ, gains
nothing by bounds: their lists are made from all products at once (``userrec.summed_products``), which stores none of them.
That is decided before each round, from the counted products.

Per user only sums by power of two are kept for these decisions, at most 64 rows each. Stage tables are
written below the shared folder, as each feeds several steps; all are over numbers of users and items (``userrec.interests``),
which follow the item codes, and only the lists are named.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aislewise.operators import skew
from aislewise.operators.ranking import top_k_per_group
from aislewise.operators.userrec import TOP_ITEMS, numbered_users, score_product, summed_products
from aislewise.session import drop_materialized, materialize

#: Products that round one asks for, as a multiple of the ranks.
FIRST_READ = 4
#: Share of a user's products above which all are made at once.
WHOLE_SHARE = 0.5


def _power(value: Column) -> Column:
    """Power of two at or below ``value``; -1 for 0. By text length in base 2, as it must be exact."""
    return F.when(value > 0, F.length(F.bin(value)) - 1).otherwise(-1).cast("int")


def partner_blocks(item_vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(item, block, other, cnt) and, per block, (item, block, top, n, fall): its largest count, its
    partners, and how far the largest unread count of the item falls once the block is read."""
    blocks = item_vectors.where("cnt > 0").select("item", _power(F.col("cnt")).alias("block"), "other", "cnt")
    heads = blocks.groupBy("item", "block").agg(F.max("cnt").alias("top"), F.count(F.lit(1)).alias("n"))
    below = F.lag("top", 1, 0).over(Window.partitionBy("item").orderBy("block"))
    return blocks, heads.withColumn("fall", F.col("top") - below)


def reading_plan(users: DataFrame, heads: DataFrame, block_rows: int) -> DataFrame:
    """(user, item, milli, block, level, n, gain): every block a user's item has, with the power of two of
    its largest product, and by how much reading it lowers the user's unread gain."""
    joined = skew.cell_join(users.select("user", "item", "milli"), heads, ["item"], ["user"], ["block"], block_rows)
    return joined.select(
        "user", "item", "milli", "block", _power(F.col("milli") * F.col("top")).alias("level"), "n",
        (F.col("milli") * F.col("fall")).alias("gain"))


def level_sums(plan: DataFrame) -> DataFrame:
    """(user, level, made, unread): products at this level and above, and the unread gain below it."""
    levels = plan.groupBy("user", "level").agg(F.sum("n").alias("n"), F.sum("gain").alias("gain"))
    own = Window.partitionBy("user")
    down = own.orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, 0)
    under = own.orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
    return levels.select(
        "user", "level", F.sum("n").over(down).alias("made"),
        F.coalesce(F.sum("gain").over(under), F.lit(0)).alias("unread"))


def _made_down_to(sums_by_level: DataFrame, reach: DataFrame, level: str) -> DataFrame:
    """(user, made, all_made): the products from the top down to the user's ``level``."""
    return sums_by_level.select("user", "level", "made").join(reach, "user").where(F.col("level") == F.col(level)).select(
        "user", "made", "all_made")


def _products(wanted: DataFrame, blocks: DataFrame, block_rows: int) -> DataFrame:
    """(user, other, milli) of chosen blocks of the plan."""
    made = skew.cell_join(
        wanted.select("user", "item", "block", "milli"), blocks, ["item", "block"], ["user"], ["other"], block_rows)
    return made.select("user", "other", (F.col("milli") * F.col("cnt")).alias("milli"))


def _stored_products(wanted: DataFrame, blocks: DataFrame, block_rows: int, name: str) -> DataFrame:
    """``_products``, stored; only blocks that are wanted are dealt out for them."""
    chosen = materialize(wanted.select("user", "item", "block", "milli"), "wanted")
    cut = materialize(blocks.join(chosen.select("item", "block").distinct(), ["item", "block"], "left_semi"), "wanted-blocks")
    made = materialize(_products(chosen, cut, block_rows), name)
    drop_materialized(chosen, cut)
    return made


def _summed(parts: DataFrame, waiting: DataFrame) -> DataFrame:
    """(user, other, milli, waiting); waiting pairs are marked where sums are made, so products need no second shuffle."""
    both = parts.withColumn("waiting", F.lit(False)).unionByName(waiting)
    return both.groupBy("user", "other").agg(F.sum("milli").alias("milli"), F.bool_or("waiting").alias("waiting"))


def _last_rank(sums: DataFrame, top: int) -> DataFrame:
    """(user, floor): the partial sum at the last rank, for users that have that many."""
    ranked = top_k_per_group(sums.where("not waiting"), ["user"], [F.desc("milli"), F.asc("other")], top)
    return ranked.where(F.col("rank") == top).select("user", F.col("milli").alias("floor"))


@dataclass
class BoundedTop:
    """``ranked`` (user, rank, item, milli) and the stage tables, of which the first three hold one row per
    product or look-up made; ``whole`` are the products of users without rounds, made within their sums."""

    ranked: DataFrame
    first: DataFrame
    second: DataFrame
    rest: DataFrame
    whole: DataFrame
    stages: tuple[DataFrame, ...]

    def rows_made(self) -> int:
        return sum(part.count() for part in (self.first, self.second, self.rest, self.whole))

    def drop(self) -> None:
        """Deletes the stage tables, once ``ranked`` is written."""
        drop_materialized(*self.stages)


def bounded_top(
    users: DataFrame, item_vectors: DataFrame, as_of: date, top: int = TOP_ITEMS, recommend_unbought: bool = False,
    block_rows: int = skew.BLOCK_ROWS, first_read: int = FIRST_READ,
) -> BoundedTop:
    """The rows of ``userrec.user_recommend``."""
    numbered = numbered_users(users.where("user is not null"), item_vectors, as_of, recommend_unbought, block_rows)
    users = numbered.rows.select(F.col("uno").alias("user"), F.col("no").alias("item"), "milli")
    item_vectors = numbered.vectors.rows().select(F.col("no").alias("item"), "other", "cnt")
    waiting = numbered.rows.where("held").select(
        F.col("uno").alias("user"), F.col("no").alias("other"), F.lit(0).cast("bigint").alias("milli"), F.lit(True).alias("waiting"))
    cut, heads = partner_blocks(item_vectors)
    blocks = materialize(cut, "partner-blocks")
    plan = materialize(reading_plan(users, heads, block_rows), "reading-plan")
    sums_by_level = level_sums(plan)
    lowest = F.min("level")

    # Round one: down to the highest level that gives enough products, else everything.
    enough = F.max(F.when(F.col("made") >= first_read * top, F.col("level")))
    all_made = F.max("made").alias("all_made")
    starts = materialize(sums_by_level.groupBy("user").agg(F.coalesce(enough, lowest).alias("first_level"), all_made), "starts")
    read_all = _made_down_to(sums_by_level, starts, "first_level").where(F.col("made") > F.col("all_made") * WHOLE_SHARE)
    reach = materialize(starts.join(read_all.select("user"), "user", "left_anti").select("user", "first_level", "all_made"), "first-reach")
    begun = reach
    first = _stored_products(plan.join(reach, "user").where("level >= first_level"), blocks, block_rows, "products-1")
    floor = _last_rank(_summed(first, waiting), top)

    # Round two: the highest level below which nothing unmet can reach the floor.
    closing = F.max(F.when(
        (F.col("unread") < F.col("floor")) & (F.col("level") <= F.col("first_level")), F.struct("level", "unread")))
    bottom = F.min_by(F.struct("level", "unread"), "level")
    reach = materialize(
        sums_by_level.join(reach, "user").join(floor, "user", "left").groupBy("user").agg(
            F.first("first_level").alias("first_level"), F.first("all_made").alias("all_made"), F.coalesce(closing, bottom).alias("to")
        ).select("user", "first_level", "all_made", F.col("to.level").alias("second_level"), F.col("to.unread").alias("unread")),
        "second-reach")
    read_all = _made_down_to(sums_by_level, reach, "second_level").where(F.col("made") > F.col("all_made") * WHOLE_SHARE)
    bounded = materialize(reach.join(read_all.select("user"), "user", "left_anti").drop("all_made"), "reach")
    stages = (starts, begun, reach, bounded)
    reach = bounded
    round_one, first = first, first.join(reach.select("user"), "user", "left_semi")
    waiting = waiting.join(reach.select("user"), "user", "left_semi")
    # What bounded users need of the plan and the blocks: nothing where all users gain nothing by bounds.
    levels = materialize(plan.join(reach, "user"), "levels")
    everything = (plan, blocks)
    blocks = materialize(blocks.join(levels.select("item").distinct(), "item", "left_semi"), "blocks-left")
    drop_materialized(*everything)
    second = _stored_products(levels.where("level < first_level and level >= second_level"), blocks, block_rows, "products-2")

    sums = materialize(_summed(first.unionByName(second), waiting).where("not waiting").drop("waiting"), "partial-sums")
    floor = _last_rank(sums.withColumn("waiting", F.lit(False)), top)
    bounds = reach.join(floor, "user", "left").select("user", "unread", F.coalesce("floor", F.lit(0)).alias("floor"))
    kept = materialize(
        sums.join(bounds, "user").where(F.col("milli") + F.col("unread") >= F.col("floor")).select(
            "user", "other", "milli", "unread"), "kept")

    # What the kept partners lack: counts below the second level, looked up or read, whichever is fewer rows.
    below = levels.where("level < second_level").groupBy("user", "item").agg(
        F.first("milli").alias("milli"), F.max("block").alias("block"), F.sum("n").alias("n"))
    sizes = below.groupBy("user").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("items")).join(
        kept.where("unread > 0").groupBy("user").agg(F.count(F.lit(1)).alias("others")), "user")
    looked = sizes.where(F.col("items") * F.col("others") < F.col("n")).select("user")
    read = sizes.where(F.col("items") * F.col("others") >= F.col("n")).select("user")
    pairs = skew.cell_join(
        below.join(looked, "user", "left_semi").select("user", "item", F.col("milli").alias("interest"), "block"),
        kept.where("unread > 0").select("user", "other"), ["user"], ["item"], ["other"], block_rows)
    counts = blocks.select("item", "other", F.col("block").alias("own_block"), "cnt")
    found = pairs.join(counts, ["item", "other"], "left").select(
        "user", "other", F.when(F.col("own_block") <= F.col("block"), F.col("interest") * F.col("cnt")).otherwise(0).alias("milli"))
    others = _products(
        levels.where("level < second_level").join(read, "user", "left_semi"), blocks, block_rows
    ).join(kept.select("user", "other"), ["user", "other"], "left_semi")
    rest = materialize(found.unionByName(others), "products-rest")

    whole = kept.select("user", "other", "milli").unionByName(rest).groupBy("user", "other").agg(F.sum("milli").alias("milli"))
    ranked = top_k_per_group(whole, ["user"], [F.desc("milli"), F.asc("other")], top).select(
        "user", "rank", F.col("other").alias("item"), "milli")
    unread = numbered.rows.join(reach.select(F.col("user").alias("uno")), "uno", "left_anti")
    unbounded = summed_products(replace(numbered, rows=unread), top)
    both = ranked.select(F.col("user").alias("uno"), F.col("item").alias("no"), "milli", "rank").unionByName(unbounded)
    others = unread.select(F.col("uno").alias("user"), F.col("no").alias("item"), "milli")
    return BoundedTop(
        numbered.named(both, "item").select("user", "rank", "item", "milli"), round_one, second, rest,
        score_product(others, item_vectors, block_rows),
        (blocks, levels, *stages, round_one, second, sums, kept, rest, numbered.rows))
