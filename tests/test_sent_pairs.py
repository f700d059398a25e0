"""Pairs counted from arrays of mates, and products summed by parts of users, against the plain ways."""

from __future__ import annotations

import random

import pytest
from conftest import rows
from test_recommend import brute_pairs, history, item, user

from aislewise.operators import alsoview, baskets


@pytest.fixture
def sent(monkeypatch):
    """All pairs are sent in arrays, and units of more than 400 pairs are hot."""
    monkeypatch.setattr(baskets, "FEW_PAIRS", -1)
    monkeypatch.setattr(baskets, "TASK_PAIRS", 400)


@pytest.mark.parametrize("bounded,block", [(False, 4)])
def test_sent_pairs_are_the_joined_ones(spark, sent, bounded, block):
    rng = random.Random(7)
    held = {user(u): sorted({f"i{rng.randrange(40):02d}" for _ in range(size)}) for u, size in enumerate([1, 2, 9, *[14] * 80, 80])}
    df = spark.createDataFrame([(u, i) for u, its in held.items() for i in its], "user string, item string")
    assert baskets.pair_plan(df, ["user"], ["item"]).hot.count() > 0
    got = rows(baskets.cooccurrence(df, ["user"], bounded, block_items=block), "item", "other", "cnt")
    assert {(a, b): n for a, b, n in got} == dict(brute_pairs(held.values())) and len(got) == len(brute_pairs(held.values()))


def visits(spark):
    rng = random.Random(11)
    codes = [item(f"{f}{s}{n}", k) for k, (f, s, n) in enumerate((f, s, n) for f in ("AAAA", "BBBB") for s in "12" for n in range(1, 5))]
    return history(spark, [(user(u), c, rng.choice((c, rng.choice(codes)))[:6], None) for u in range(12) for c in rng.sample(codes, 9)])


def lists(spark, cap):
    seen = visits(spark)
    yield rows(alsoview.also_view_item(seen, cap, top=4))
    yield rows(alsoview.also_view_item(seen, cap, min_score=5, top=4))
    yield rows(alsoview.item_similarity(seen, cap))
    yield rows(alsoview.similar_items(alsoview.capped_units(seen, cap), 6))
    for level in alsoview.LEVELS:
        yield rows(alsoview.also_view_group_items(seen, level, cap, top=3))


@pytest.mark.parametrize("cap", [100])
def test_lists_of_sent_pairs_are_those_of_joined_ones(spark, cap, monkeypatch):
    joined = list(lists(spark, cap))
    monkeypatch.setattr(baskets, "FEW_PAIRS", -1)
    monkeypatch.setattr(baskets, "TASK_PAIRS", 400)
    for a, b in zip(joined, lists(spark, cap), strict=True):
        assert a and a == b


def test_sent_pairs_take_one_row_an_item(spark, sent):
    """What is shuffled to be counted is a row of each basket and item, not one of each pair."""
    df = spark.range(60).selectExpr("'u' as user", "concat('i', id) as item")
    counted = baskets.cooccurrence(df, ["user"], bounded=True)
    text = counted._jdf.queryExecution().optimizedPlan().toString()
    assert counted.count() == 60 * 59 and "Join Inner" not in text and "collect_list" in text


def test_numbers_are_dense_and_follow_the_codes(spark):
    from aislewise.operators.itemcodes import numbered_items

    items = numbered_items(spark.range(500).selectExpr("concat('c', id * 7919 % 500) as item"))
    assert dict(items.dtypes)["no"] == "int"
    assert [r.item for r in items.orderBy("no").collect()] == sorted(f"c{n}" for n in range(500))
    assert sorted(r.no for r in items.collect()) == list(range(500))


def test_sums_of_hot_users_in_slices(spark, monkeypatch):
    """Every user has more products than a task should: all are cut into slices by other item, and vectors into chunks."""
    from datetime import date

    from aislewise.operators import userrec
    from aislewise.operators.ranking import top_k_per_group
    from pyspark.sql import functions as F

    monkeypatch.setattr(userrec, "TASK_PRODUCTS", 30)
    rng = random.Random(3)
    users = spark.createDataFrame(
        [(f"u{u}", f"i{i}", rng.randrange(1, 3000), rng.randrange(40), date(2014, 3, 1 + rng.randrange(30)), rng.randrange(2))
         for u in range(5) for i in rng.sample(range(12), 6)],
        "user string, item string, milli long, avg_day long, last_buy date, buy long")
    vectors = spark.createDataFrame(
        [(f"i{a}", f"i{b}", rng.randrange(1, 9)) for a in range(12) for b in range(12) if a != b], "item string, other string, cnt long")
    as_of = date(2014, 4, 1)
    sums = userrec.score_product(users, vectors).groupBy("user", "other").agg(F.sum("milli").alias("milli"))
    expected = top_k_per_group(
        userrec.purchase_cycle_filter(sums, users, as_of), ["user"], [F.desc("milli"), F.asc("other")], 4)
    got = userrec.user_recommend(users, vectors, as_of, 4, block_rows=5)
    assert rows(got, "user", "rank", "item", "milli") == rows(expected, "user", "rank", "other", "milli")
