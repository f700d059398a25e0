from __future__ import annotations

import random
from collections import Counter
from datetime import date
from itertools import permutations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from aislewise.operators import alsoview, baskets, identity, mostview, skew, userrec
from aislewise.operators.ranking import top_k_per_group


def user(n):
    return str(n).zfill(40)


def item(store, n):
    return f"{store}-A{n:08d}"


def history(spark, data):
    return spark.createDataFrame(
        [(u, i, s, s[:4] if r is None else r, 1) for u, i, s, r in data],
        "user string, item string, store string, region string, cnt int")


@pytest.fixture(scope="module")
def random_baskets():
    rng = random.Random(7)
    return {user(u): sorted({f"i{rng.randrange(40):02d}" for _ in range(size)})
            for u, size in enumerate([1, 2, 5, 9, 14, 35, 80])}


def brute_pairs(groups):
    return Counter(p for items in groups for p in permutations(sorted(set(items)), 2))


@pytest.mark.parametrize("bounded,block", [(True, 1000), (False, 1000), (False, 4), (False, 1)])
def test_cooccurrence_against_brute_force(spark, random_baskets, bounded, block):
    df = spark.createDataFrame([(u, i) for u, its in random_baskets.items() for i in its], "user string, item string")
    got = baskets.cooccurrence(df, ["user"], bounded, block_items=block)
    expected = brute_pairs(random_baskets.values())
    assert {(a, b): n for a, b, n in rows(got, "item", "other", "cnt")} == dict(expected)


def test_cooccurrence_is_symmetric(spark, random_baskets):
    df = spark.createDataFrame([(u, i) for u, its in random_baskets.items() for i in its], "user string, item string")
    counts = {(r.item, r.other): r.cnt for r in baskets.cooccurrence(df, ["user"], True).collect()}
    assert all(counts[b, a] == n for (a, b), n in counts.items())
    assert all(a != b for a, b in counts)


def test_basket_cap_is_strict(spark, random_baskets):
    df = spark.createDataFrame([(u, i) for u, its in random_baskets.items() for i in its], "user string, item string")
    for cap in (1, 5, 9, 1000):
        kept = {r.user for r in baskets.basket_cap(df, ["user"], cap).select("user").distinct().collect()}
        assert kept == {u for u, its in random_baskets.items() if len(its) < cap}


@pytest.mark.parametrize("months,limit", [(1, 900), (3, 900), (4, 1200), (12, 3600)])
def test_basket_limit(months, limit):
    assert baskets.basket_limit(months) == limit


def test_also_view_doubles_within_family_and_breaks_ties_by_code(spark):
    a, b, c, d = item("AAAAA1", 1), item("AAAAA2", 2), item("BBBBB1", 3), item("BBBBB1", 4)
    data = [(user(1), x, x[:6], None) for x in (a, b, c, d)] + [(user(1), a, a[:6], None), ("short", a, a[:6], None)]
    got = alsoview.also_view_item(history(spark, data), 900).where(F.col("item") == a)
    assert rows(got, "rank", "other", "score") == [(1, b, 2), (2, c, 1), (3, d, 1)]
    only = alsoview.also_view_item(history(spark, data), 900, min_score=1).where(F.col("item") == a)
    assert rows(only, "other") == [(b,)]


def test_also_view_group_uses_listed_group_and_own_prefix(spark):
    a, b, c = item("AAAAA1", 1), item("AAAAA2", 2), item("CCCCC1", 3)
    # c is listed in store AAAAA1 besides its own, so its own listing meets itself there.
    data = [(user(1), a, "AAAAA1", None), (user(1), b, "AAAAA2", None), (user(1), c, "CCCCC1", None),
            (user(1), c, "AAAAA1", None)]
    units = alsoview.also_view_group_items(history(spark, data), "store", 900)
    got = {(r.grp, r.item, r.other): r.score for r in units.collect()}
    assert got[("AAAAA1", a, b)] == 2  # own prefix of b shares the key store's family
    assert got[("AAAAA1", a, c)] == 1  # the listing of c in the same store does not count
    assert got[("AAAAA2", b, c)] == 2  # both listings of c are in other stores
    assert got[("AAAAA1", c, c)] == 1  # the item itself, listed elsewhere
    sums = {(r.grp, r.item): r.score for r in alsoview.also_view_group(units).collect()}
    assert sums[("AAAAA1", b)] == 4 and sums[("AAAAA2", c)] == 2


def test_also_view_rejects_other_levels(spark):
    with pytest.raises(ValueError):
        alsoview.also_view_group_items(history(spark, []), "item", 900)


def test_most_view_counts_rows(spark):
    a, b = item("AAAAA1", 1), item("AAAAA1", 2)
    data = [("anyone", a, "AAAAA1", None)] * 3 + [(user(1), b, "AAAAA1", None), (user(1), "bad", "AAAAA1", None)]
    got = mostview.most_view(history(spark, data), "store", top=5)
    assert rows(got, "grp", "rank", "item", "cnt") == [("AAAAA1", 1, a, 3), ("AAAAA1", 2, b, 1)]


def test_top_k_ranks_are_dense(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), (F.col("id") % 7).alias("s"), "id")
    got = top_k_per_group(df, ["g"], [F.desc("s"), F.asc("id")], 10)
    for g in range(3):
        group = sorted(got.where(F.col("g") == g).collect(), key=lambda r: r["rank"])
        assert [r["rank"] for r in group] == list(range(1, 11))
        assert [(-r.s, r.id) for r in group] == sorted((-r.s, r.id) for r in group)


def test_cells_bound_the_pairs_of_one_basket(spark):
    df = spark.range(5000).select(F.lit("u").alias("user"), F.concat(F.lit("i"), "id").alias("item"))
    other = df.withColumnRenamed("item", "other_item")
    joined = skew.cell_join(df, other, ["user"], ["item"], ["other_item"], block_rows=500)
    assert joined.count() == 5000 * 5000
    blocks = skew.blocks_of(df, ["user"], 500, "k").collect()
    assert [(r.user, r.k) for r in blocks] == [("u", 20)]
    largest = df.groupBy(F.pmod(F.xxhash64("item"), F.lit(20)).alias("b")).count().agg(F.max("count")).first()[0]
    assert largest <= 500


def test_cells_of_a_hot_item_keep_every_product(spark):
    users = spark.range(300).select(F.concat(F.lit("u"), "id").alias("user"), F.lit("hot").alias("item"), F.lit(2).cast("long").alias("milli"))
    vectors_ = spark.range(70).select(F.lit("hot").alias("item"), F.concat(F.lit("o"), "id").alias("other"), F.lit(3).cast("long").alias("cnt"))
    got = userrec.score_product(users, vectors_, block_rows=20)
    assert got.count() == got.select("user", "other").distinct().count() == 300 * 70
    assert got.select("milli").distinct().collect()[0][0] == 6


@pytest.fixture(scope="module")
def vectors(spark):
    rng = random.Random(3)
    uv = {(f"u{rng.randrange(30)}", f"i{rng.choice([0, 0, 0, rng.randrange(12)])}"): rng.randrange(1, 3000)
          for _ in range(300)}
    iv = {(f"i{a}", f"i{b}"): rng.randrange(1, 9) for a in range(12) for b in range(12) if a != b}
    users = spark.createDataFrame([(u, i, m) for (u, i), m in uv.items()], "user string, item string, milli long")
    items = spark.createDataFrame([(a, b, c) for (a, b), c in iv.items()], "item string, other string, cnt long")
    return uv, iv, users, items


@pytest.mark.parametrize("piece_rows", [1, 5, 1_000_000])
def test_cut_hot_items_give_the_same_scores(spark, vectors, piece_rows):
    uv, iv, users, items = vectors
    expected = Counter()
    for (u, i), milli in uv.items():
        for (a, b), cnt in iv.items():
            if a == i:
                expected[u, b] += milli * cnt
    got = userrec.user_recommend_candidates(users, items, piece_rows)
    assert {(u, o): m for u, o, m in rows(got)} == dict(expected)


DAY = date(2014, 3, 1)


def daily_rows(spark, data):
    return spark.createDataFrame(
        data, "dt date, user string, item string, buy long, view long, cart long, buy_date date")


def test_user_vector(spark):
    bought = date(2014, 3, 11)
    daily = daily_rows(spark, [
        (bought, "u", "a", 2, 1, 0, bought), (date(2014, 3, 5), "u", "a", 1, 0, 0, date(2014, 3, 5)),
        (bought, "u", "b", 0, 3, 0, None), (DAY, "v", "a", 1, 0, 0, DAY), (DAY, "v", "b", 0, 0, 2, None),
    ])
    got = userrec.user_vector(daily, DAY, date(2014, 4, 1))
    assert rows(got, "user", "item", "milli", "avg_day", "last_buy") == [
        ("u", "a", 2750, 4, bought),  # 1/4 views + 2.5 * all purchases; ceil(10 / 3) days
        ("u", "b", 750, 31, DAY),
        ("v", "a", 2500, 31, DAY),  # bought on the first day: cycle 0 becomes first day to run date
        ("v", "b", 1500, 31, DAY),
    ]


def test_buying_cycle(spark):
    users = spark.createDataFrame([
        ("u", "ready", 1000, 10, date(2014, 3, 11), 1), ("u", "waiting", 1000, 10, date(2014, 3, 25), 1),
        ("u", "unbought", 1000, 31, DAY, 0),
    ], "user string, item string, milli long, avg_day long, last_buy date, buy long")
    as_of = date(2014, 4, 1)
    assert rows(userrec.in_buying_cycle(users, as_of), "item") == [("unbought",), ("waiting",)]
    assert rows(userrec.in_buying_cycle(users, as_of, recommend_unbought=True), "item") == [("waiting",)]


@pytest.mark.parametrize("unbought", [False, True])
def test_recommend_equals_candidates_after_the_filter(spark, vectors, unbought):
    uv, _, users, items = vectors
    rng = random.Random(5)
    full = spark.createDataFrame(
        [(u, i, m, rng.randrange(40), date(2014, 3, 1 + rng.randrange(30)), rng.randrange(2))
         for (u, i), m in uv.items()],
        "user string, item string, milli long, avg_day long, last_buy date, buy long")
    as_of = date(2014, 4, 1)
    kept = userrec.purchase_cycle_filter(userrec.user_recommend_candidates(full, items), full, as_of, unbought)
    expected = top_k_per_group(kept, ["user"], [F.desc("milli"), F.asc("other")], 4)
    got = userrec.user_recommend(full, items, as_of, 4, unbought)
    assert rows(got, "user", "rank", "item", "milli") == rows(expected, "user", "rank", "other", "milli")
    excluded = {(r.user, r.item) for r in userrec.in_buying_cycle(full, as_of, unbought).collect()}
    assert not excluded & {(r.user, r.item) for r in got.collect()}


def test_daily_counters_join_identity_of_the_same_day(spark):
    d1, d2 = date(2014, 3, 1), date(2014, 3, 2)
    clicks = spark.createDataFrame(
        [(d1, "x", "a", "view"), (d1, "x", "a", "view"), (d1, "x", "a", "cart"), (d2, "x", "a", "view")],
        "dt date, uid string, item string, kind string")
    pairs = spark.createDataFrame([(d1, "x", "e1"), (d1, "x", "e2")], "dt date, uid string, eid string")
    bought = spark.createDataFrame([(d1, "eid:e2", "a")], "dt date, user string, item string")
    got = userrec.user_item_daily(clicks, pairs, bought)
    assert rows(got) == [(d1, "eid:e2", "a", 1, 2, 1, d1), (d2, "uid:x", "a", 0, 1, 0, None)]


def test_purchases_on_day(spark):
    df = spark.createDataFrame([
        ("20121201000004-12", "e", "DJAD3J-A57761725-000", "s", "r"), ("20121202000004-1", "e", "X-Y-000", "s", "r"),
        ("20121201000004-13", "e", "nodash", "s", "r"), ("garbage", "e", "X-Y-0", "s", "r"),
    ], "order_no string, eid string, item_sku string, store string, region string")
    assert rows(identity.purchases_on_day(df, "20121201")) == [(date(2012, 12, 1), "eid:e", "DJAD3J-A57761725")]
    assert identity.purchases_on_day(df).count() == 2


def test_item_vector_merge(spark):
    df = spark.createDataFrame(
        [("a", "b", 1), ("a", "b", 1), ("a", "c", 1), ("a", "d", 5), ("a", "e", 2)], "item string, other string, cnt long")
    assert rows(userrec.item_vector_merge(df, limit=2), "rank", "other", "cnt") == [(1, "d", 5), (2, "b", 2)]
