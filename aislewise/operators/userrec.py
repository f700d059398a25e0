"""Personal recommendations: daily counters, user vectors, item vectors, scores.

Scores are kept as whole thousandths (``milli``), the precision of the user vector, so
sums are exact and do not depend on the order of tasks.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewise.operators import baskets as B
from aislewise.operators import identity as I
from aislewise.operators import pairkernels, skew
from aislewise.operators.itemcodes import numbered_items
from aislewise.operators.ranking import top_k_per_group
from aislewise.session import drop_materialized, materialize
from aislewise.shipping import map_batches

# Weights of the three kinds of interest, first input day, limits.
VIEW_WEIGHT = 1.0
CART_WEIGHT = 1.5
BUY_WEIGHT = 2.5
FIRST_DAY = date(2014, 3, 1)
VECTOR_LIMIT = 1000
TOP_ITEMS = 30
#: Products aimed at in a task that sums them.
TASK_PRODUCTS = 4_000_000
#: Lists are made in rounds of users. A round makes so many products, or so many for each row and entry that it reads, if
#: these are more; there are no more rounds than this.
ROUND_PRODUCTS = 50_000_000
ROUND_SHARE = 1.25
MAX_ROUNDS = 64


def user_item_daily(clicks: DataFrame, pairs: DataFrame, purchases: DataFrame) -> DataFrame:
    """(dt, user, item, buy, view, cart, buy_date) per day.

    ``clicks`` are (dt, uid, item, kind), ``pairs`` (dt, uid, eid) and ``purchases``
    (dt, user, item). Clicks are counted per uid before the identity join, so that a hot
    uid brings its distinct items to the join and not its clicks.
    """
    is_view = (F.col("kind") == "view").cast("bigint")
    by_uid = clicks.groupBy("dt", "uid", "item").agg(
        F.sum(is_view).alias("view"), F.sum(1 - is_view).alias("cart")
    )
    zero = F.lit(0).cast("bigint")
    clicked = I.identity_resolve(by_uid, pairs, ["dt"]).select(
        "dt", "user", "item", zero.alias("buy"), "view", "cart"
    )
    bought = purchases.select(
        "dt", "user", "item", F.lit(1).cast("bigint").alias("buy"), zero.alias("view"), zero.alias("cart")
    )
    sums = clicked.unionByName(bought).groupBy("dt", "user", "item").agg(
        F.sum("buy").alias("buy"), F.sum("view").alias("view"), F.sum("cart").alias("cart")
    )
    return sums.withColumn("buy_date", F.when(F.col("buy") > 0, F.col("dt")))


def item_vector_daily(daily: DataFrame, block_items: int = B.BLOCK_ITEMS) -> DataFrame:
    """(dt, item, other, cnt): co-occurrence within the items a user touched on one day."""
    baskets = B.user_basket(daily, ["dt", "user"], ["item"])
    return B.cooccurrence(baskets, ["dt", "user"], bounded=False, per=["dt"], block_items=block_items)


@dataclass
class Vectors:
    """``table`` (no, n, at, others, cnts): stored item vectors over numbers, in lists of which ``at`` partners come before,
    of ``n`` in all; ``items`` (no, item) names the numbers."""

    table: DataFrame
    items: DataFrame

    def rows(self) -> DataFrame:
        """(no, rank, other, cnt) over numbers."""
        each = self.table.select("no", "at", "cnts", F.posexplode("others").alias("_place", "other"))
        return each.select("no", (F.col("at") + F.col("_place") + 1).alias("rank"), "other", F.get("cnts", F.col("_place")).alias("cnt"))

    def named(self) -> DataFrame:
        """(item, rank, other, cnt)."""
        others = self.items.select(F.col("no").alias("_other"), F.col("item").alias("_name"))
        rows = self.rows().join(others, F.col("other") == F.col("_other")).drop("other", "_other")
        return rows.join(self.items, "no").select("item", "rank", F.col("_name").alias("other"), "cnt")


def item_vector_merge(item_vectors: DataFrame, min_cnt: int = 1, limit: int | None = VECTOR_LIMIT) -> DataFrame:
    """(item, rank, other, cnt): counts summed over days, above ``min_cnt``, the ``limit`` largest
    of each item. Without a limit all are kept, unranked (``rank`` is null).

    Daily counts that are made in cells are summed there, and the vectors are stored over numbers (``_vectors`` of the result).
    """
    cells = getattr(item_vectors, "_cells", None)
    if cells is not None:
        vectors = Vectors(materialize(cells.vectors(min_cnt, limit), "item-vectors"), cells.items)
        merged = vectors.named() if limit is not None else vectors.named().withColumn("rank", F.lit(None).cast("int"))
        merged._vectors = vectors
        return merged
    sums = item_vectors.groupBy("item", "other").agg(F.sum("cnt").alias("cnt"))
    if limit is None:
        return sums.where(F.col("cnt") > min_cnt).select("item", F.lit(None).cast("int").alias("rank"), "other", "cnt")
    return top_k_per_group(
        sums.where(F.col("cnt") > min_cnt), ["item"], [F.desc("cnt"), F.asc("other")], limit
    )


def _share(part: Column, whole: Column, weight: float) -> Column:
    return F.when(whole != 0, weight * (part / whole)).otherwise(0.0)


def user_counts(daily: DataFrame) -> DataFrame:
    """(user, item, buy, view, cart, buy_date) over all days."""
    return daily.groupBy("user", "item").agg(
        F.sum("buy").alias("buy"), F.sum("view").alias("view"), F.sum("cart").alias("cart"),
        F.max("buy_date").alias("buy_date"),
    )


def user_vector(
    daily: DataFrame, first_day: date = FIRST_DAY, as_of: date | None = None, counts: DataFrame | None = None,
) -> DataFrame:
    """(user, item, milli, avg_day, last_buy) over all days of ``daily``.

    ``milli`` is the interest score in thousandths, ``avg_day`` the buying cycle in days,
    ``last_buy`` the last purchase or, without one, ``first_day``. ``as_of`` is the run date. ``counts`` are the stored
    ``user_counts`` of ``daily``, if there are.
    """
    if as_of is None:
        raise ValueError("as_of, the run date, is required")
    first, today = F.lit(first_day), F.lit(as_of)
    counts = user_counts(daily) if counts is None else counts
    totals = counts.groupBy("user").agg(
        F.sum("buy").alias("all_buy"), F.sum("view").alias("all_view"), F.sum("cart").alias("all_cart")
    )
    # Totals are joined back rather than windowed, so adaptive execution can split a hot user.
    rows = counts.join(totals, "user")
    score = (
        _share(F.col("view"), F.col("all_view"), VIEW_WEIGHT)
        + _share(F.col("cart"), F.col("all_cart"), CART_WEIGHT)
        + _share(F.col("buy"), F.col("all_buy"), BUY_WEIGHT)
    )
    last_buy = F.greatest(first, F.coalesce(F.col("buy_date"), first))
    since_first = F.abs(F.datediff(today, first))
    cycle = F.when(
        F.col("buy") != 0, F.ceil(F.abs(F.datediff(last_buy, first)) / F.nullif(F.col("buy"), F.lit(0)))
    ).otherwise(since_first)
    return rows.select(
        "user", "item",
        F.rint(score * 1000).cast("bigint").alias("milli"),
        F.when(cycle != 0, cycle).otherwise(since_first).cast("bigint").alias("avg_day"),
        last_buy.alias("last_buy"),
        "buy",
    )


def score_product(users: DataFrame, item_vectors: DataFrame, block_rows: int = skew.BLOCK_ROWS) -> DataFrame:
    """(user, item, other, milli) per user item and other item: user score times pair count.

    Joined on the item. The users of an item and its partners are cut into blocks where there are more
    than ``block_rows``, so no task gets more than about that squared of one item's products.
    """
    products = skew.cell_join(
        users.select("user", "item", "milli"), item_vectors.select("item", "other", "cnt"), ["item"],
        ["user"], ["other"], block_rows)
    return products.select("user", "item", "other", (F.col("milli") * F.col("cnt")).alias("milli"))


def vectors_of(item_vectors: DataFrame, block_rows: int = skew.BLOCK_ROWS) -> Vectors:
    """The vectors as ``item_vector_merge`` stored them, else the rows of ``item_vectors`` numbered and stored, in lists of
    about ``block_rows`` partners."""
    found = getattr(item_vectors, "_vectors", None)
    if found is not None:
        return found
    known = item_vectors.where("item is not null and cnt is not null")
    items = numbered_items(known.select(F.explode(F.array("item", "other")).alias("item")))
    others = items.select(F.col("no").alias("_no"), F.col("item").alias("_other"))
    rows = materialize(known.join(items, "item").join(others, F.col("other").eqNullSafe(F.col("_other"))).select(
        "no", F.col("_no").alias("other"), F.col("cnt").cast("bigint").alias("cnt")), "vector-rows")
    lengths = rows.groupBy("no").agg(F.count(F.lit(1)).cast("int").alias("n"))
    chunk = F.pmod(F.xxhash64("other"), F.ceil(F.col("n") / block_rows)).alias("chunk")
    lists = rows.join(lengths, "no").groupBy("no", "n", chunk).agg(F.collect_list(F.struct("other", "cnt")).alias("e"))
    table = materialize(lists.select(
        "no", "n", F.lit(0).alias("at"), F.col("e.other").alias("others"), F.col("e.cnt").alias("cnts")), "item-vectors")
    drop_materialized(rows)
    return Vectors(table, items)


@dataclass
class Interests:
    """Users' rows over numbers beside the item vectors: ``rows`` (uno, no, milli, held, n) with the length of the item's
    vector, of items that have a number; ``people`` (uno, user)."""

    rows: DataFrame
    people: DataFrame
    vectors: Vectors

    def named(self, df: DataFrame, item: str) -> DataFrame:
        return df.join(self.people, "uno").join(self.vectors.items.withColumnRenamed("item", item), "no").drop("uno", "no")

    def drop(self) -> None:
        drop_materialized(self.rows)


def interests(users: DataFrame, item_vectors: DataFrame, held: Column, block_rows: int = skew.BLOCK_ROWS) -> Interests:
    """Numbers ``users`` and ``item_vectors``; ``held`` tells of the users' rows which items they are not to get.

    The rows take their numbers one after the other, so that no more than one shuffle of them is on disk.
    """
    vectors = vectors_of(item_vectors, block_rows)
    people = materialize(users.select("user").distinct().select(F.monotonically_increasing_id().alias("uno"), "user"), "user-numbers")
    names = people.withColumnRenamed("user", "_user")
    known = users.select("user", "item", "milli", held.alias("held")).where("milli is not null")
    by_user = materialize(known.join(names, known["user"].eqNullSafe(names["_user"])).select("uno", "item", "milli", "held"), "user-rows")
    lengths = vectors.table.select("no", "n").distinct()
    numbered = by_user.join(vectors.items, "item").join(lengths, "no", "left")
    rows = materialize(numbered.select("uno", "no", "milli", "held", F.coalesce("n", F.lit(0)).alias("n")), "product-rows")
    drop_materialized(by_user)
    return Interests(rows, people, vectors)


def summed_products(found: Interests, top: int | None = None) -> DataFrame:
    """(uno, no, milli): the score products summed by user and other item, without the items ``held``; with ``top`` only so
    many of a user, with their ``rank``, made in rounds and stored.

    Users are dealt into parts, a task each, and a part gets each item vector that its users need once, as arrays:
    products are made where they are summed (``pairkernels``), and none is shuffled or stored. Tasks are as many
    as the counted products ask for. Users of more products than a task should have are cut into slices by other item.
    What is sent to the parts grows with the products, so lists are made for some of the users at a time.
    """
    rows, vectors = found.rows, found.vectors.table
    per_user = rows.groupBy("uno").agg(F.sum("n").alias("n"))
    counted = per_user.agg(
        F.sum("n").alias("products"), F.count_if(F.col("n") > TASK_PRODUCTS).alias("hot")).first()
    products = counted["products"] or 0
    slices = per_user.where(F.col("n") > TASK_PRODUCTS).select("uno", F.ceil(F.col("n") / TASK_PRODUCTS).cast("int").alias("slices"))
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rounds = 1
    if top is not None and products > ROUND_PRODUCTS:
        read = rows.count() + (vectors.agg(F.sum(F.size("others"))).first()[0] or 0)
        rounds = min(MAX_ROUNDS, math.ceil(products / max(ROUND_PRODUCTS, ROUND_SHARE * read)))
    tasks = max(least, -(-products // (TASK_PRODUCTS * rounds)))

    def sliced(df: DataFrame, number: Column) -> DataFrame:
        """With ``slices``, ``slice`` and the ``part`` of each row; ``number`` tells the slice from ``slices``."""
        cut = df.join(F.broadcast(slices), "uno", "left") if counted["hot"] else df.withColumn("slices", F.lit(None).cast("int"))
        placed = cut.withColumn("slices", F.coalesce("slices", F.lit(1))).withColumn("slice", number)
        return placed.withColumn("part", F.pmod(F.xxhash64("uno", "slice"), F.lit(tasks)).cast("int"))

    def made(own_rows: DataFrame) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
        takers = sliced(own_rows.where("n > 0"), every).groupBy("part", "no", "slices", "slice").agg(
            F.collect_list(F.struct("uno", "milli")).alias("takers"))
        senders = max(least, tasks // 8)
        met = takers.repartition(senders, "no").join(vectors.select("no", "others", "cnts").repartition(senders, "no"), "no")
        if counted["hot"]:
            own = F.filter(
                F.arrays_zip("others", "cnts"), lambda e: F.pmod(F.xxhash64(e["others"]), F.col("slices")) == F.col("slice"))
            whole = F.col("slices") == 1
            met = met.withColumn("own", F.when(~whole, own)).withColumns({
                c: F.when(whole, F.col(c)).otherwise(F.col("own")[c]) for c in ("others", "cnts")})
        sent = met.select("part", "takers", "others", "cnts", F.lit(False).alias("held"))
        marks = sliced(own_rows.where("held"), F.pmod(F.xxhash64("no"), F.col("slices")).cast("int")).groupBy("part", "uno").agg(
            F.collect_list("no").alias("others"))
        marks = marks.select(
            "part", F.array(F.struct("uno", F.lit(0).cast("bigint").alias("milli"))).alias("takers"), "others",
            F.transform("others", lambda _: F.lit(0).cast("bigint")).alias("cnts"), F.lit(True).alias("held"))
        dealt = sent.unionByName(marks).repartitionById(tasks, "part")
        return map_batches(dealt, pairkernels.summed_products(top), "uno bigint, no int, milli bigint, rank int")

    if top is None:
        return made(rows).drop("rank")
    turn = F.pmod(F.xxhash64("uno", F.lit("round")), F.lit(rounds))
    lists = [materialize(made(rows.where(turn == r) if rounds > 1 else rows), "product-lists") for r in range(rounds)]
    ranked = functools.reduce(DataFrame.unionByName, lists)
    if counted["hot"]:
        ranked = top_k_per_group(ranked.drop("rank"), ["uno"], [F.desc("milli"), F.asc("no")], top)
    return ranked


def user_recommend_candidates(users: DataFrame, item_vectors: DataFrame, block_rows: int = skew.BLOCK_ROWS) -> DataFrame:
    """(user, other, milli): exact sum of the score products, nothing cut off."""
    found = interests(users, item_vectors, F.lit(False), block_rows)
    return found.named(summed_products(found), "other").select("user", "other", "milli")


def _waits(as_of: date, recommend_unbought: bool) -> Column:
    """Whether a user's row is within its buying cycle."""
    ready = F.abs(F.datediff(F.lit(as_of), F.col("last_buy"))) > F.col("avg_day")
    if recommend_unbought:
        ready = ready | (F.col("buy") == 0)
    return ~ready


def in_buying_cycle(users: DataFrame, as_of: date, recommend_unbought: bool = False) -> DataFrame:
    """(user, item) not to be recommended on ``as_of``: too soon after the last purchase.

    Items never bought count as bought on the first day and so stay excluded;
    ``recommend_unbought`` lets them through.
    """
    return users.where(_waits(as_of, recommend_unbought)).select("user", "item")


def purchase_cycle_filter(
    candidates: DataFrame, users: DataFrame, as_of: date, recommend_unbought: bool = False
) -> DataFrame:
    waiting = in_buying_cycle(users, as_of, recommend_unbought).withColumnRenamed("item", "other")
    return candidates.join(waiting, ["user", "other"], "left_anti")


def numbered_users(
    users: DataFrame, item_vectors: DataFrame, as_of: date, recommend_unbought: bool, block_rows: int = skew.BLOCK_ROWS,
) -> Interests:
    """``interests`` of the users, whose items within their buying cycle are held."""
    return interests(users, item_vectors, F.coalesce(_waits(as_of, recommend_unbought), F.lit(False)), block_rows)


def user_recommend(
    users: DataFrame, item_vectors: DataFrame, as_of: date, top: int = TOP_ITEMS,
    recommend_unbought: bool = False, block_rows: int = skew.BLOCK_ROWS,
) -> DataFrame:
    """(user, rank, item, milli): the ``top`` items per user.

    Same as ``purchase_cycle_filter`` on the candidates. Items within their buying cycle are
    left out where the scores are summed; ranks are cut over numbers, which follow the item codes.
    """
    found = numbered_users(users, item_vectors, as_of, recommend_unbought, block_rows)
    lists = summed_products(found, top)
    found.drop()
    return found.named(lists, "item").select("user", "rank", "item", "milli")
