"""Bounded products, pruning before joins, ranks in parts."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import date
from itertools import permutations

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_recommend import history, item, user

from aislewise.operators import alsoview, baskets, boundedtop, ranking, userrec

AS_OF = date(2014, 4, 1)
USERS = "user string, item string, milli long, avg_day long, last_buy date, buy long"


def taste(rng, users=40, items=60, skewed=True):
    """User rows and item vectors; skewed interest and counts unless told otherwise."""
    rows_ = []
    for u in range(users):
        for k, i in enumerate(rng.sample(range(items), rng.randrange(1, 14))):
            milli = int(4000 / (k + 1) ** 2) if skewed else rng.choice([0, 100, 100, 500])
            rows_.append((f"u{u}", f"i{i:03d}", milli, rng.randrange(40), date(2014, 3, 1 + rng.randrange(30)), rng.randrange(2)))
    pairs = []
    for i in range(items):
        others = rng.sample(range(items), rng.randrange(0, items))
        pairs += [(f"i{i:03d}", f"i{o:03d}", int(2000 / (k + 1) ** 1.3) + 1 if skewed else rng.choice([1, 1, 2, 3]))
                  for k, o in enumerate(others) if o != i]
    return rows_, pairs


def frames(spark, made):
    return spark.createDataFrame(made[0], USERS), spark.createDataFrame(made[1], "item string, other string, cnt long")


@pytest.mark.parametrize("seed,skewed,top,unbought,block", [
    (1, True, 3, False, 1000), (2, True, 10, True, 4), (3, False, 5, False, 1000), (4, False, 200, True, 7),
])
def test_bounded_lists_are_those_of_all_products(spark, seed, skewed, top, unbought, block):
    users, vectors = frames(spark, taste(random.Random(seed), skewed=skewed))
    expected = userrec.user_recommend(users, vectors, AS_OF, top, unbought)
    got = boundedtop.bounded_top(users, vectors, AS_OF, top, unbought, block_rows=block, first_read=1)
    assert rows(got.ranked, "user", "rank", "item", "milli") == rows(expected, "user", "rank", "item", "milli")


def test_most_products_are_left_out_of_skewed_lists(spark):
    rng = random.Random(5)
    users = [(f"u{u}", f"i{i:03d}", int(3000 / (k + 1) ** 2) + 1, 0, date(2014, 3, 1), 1)
             for u in range(30) for k, i in enumerate(rng.sample(range(200), 25))]
    pairs = [(f"i{i:03d}", f"o{o:04d}", int(5000 / (k + 1) ** 1.5) + 1)
             for i in range(200) for k, o in enumerate(rng.sample(range(3000), 400))]
    users, vectors = frames(spark, (users, pairs))
    got = boundedtop.bounded_top(users, vectors, AS_OF, 10)
    expected = userrec.user_recommend(users, vectors, AS_OF, 10)
    assert rows(got.ranked, "user", "rank", "item", "milli") == rows(expected, "user", "rank", "item", "milli")
    assert got.rows_made() * 4 < userrec.score_product(users, vectors).count()
    got.drop()


def test_bounded_lists_of_nobody(spark):
    users, vectors = frames(spark, ([], []))
    assert boundedtop.bounded_top(users, vectors, AS_OF).ranked.count() == 0
    users, vectors = frames(spark, (taste(random.Random(6))[0], []))
    assert boundedtop.bounded_top(users, vectors, AS_OF).ranked.count() == 0


def test_powers_are_exact(spark):
    df = spark.createDataFrame([(v,) for k in range(1, 62) for v in ((1 << k) - 1, 1 << k)] + [(0,)], "v long")
    assert all(r.p == (r.v.bit_length() - 1 if r.v else -1) for r in df.select("v", boundedtop._power(F.col("v")).alias("p")).collect())


def brute_scores(data, cap, min_score):
    own = defaultdict(set)
    for u, i, *_ in data:
        own[u].add(i)
    counts = Counter(p for its in own.values() if cap is None or len(its) < cap for p in permutations(sorted(its), 2))
    scores = {(a, b): n * (2 if a[:5] == b[:5] else 1) for (a, b), n in counts.items()}
    return {p: n for p, n in scores.items() if n > min_score}


@pytest.mark.parametrize("cap,min_score", [(None, 1), (30, 3), (None, 6), (30, 7), (None, 1000)])
def test_pruned_pairs_are_those_above_the_score(spark, cap, min_score):
    rng = random.Random(min_score)
    stores = ["AAAAA1", "AAAAA2", "BBBBB1", "CCCCC1"]
    data = [(user(u), item(rng.choice(stores), int(rng.paretovariate(0.6)) % 60), "S", None)
            for u in range(40) for _ in range(rng.choice([1, 3, 12, 45]))]
    got = alsoview.similar_items(alsoview.capped_units(history(spark, data), cap), min_score)
    assert {(a, b): n for a, b, n in rows(got, "item", "other", "score")} == brute_scores(data, cap, min_score)


def test_rows_are_pruned_before_the_join(spark):
    """A chain that falls apart round by round, beside a solid block; rare items and left-over baskets go."""
    block = [(f"b{u}", f"x{i}") for u in range(9) for i in range(4)]
    chain = [(f"c{k}", f"y{k}") for k in range(8)] + [(f"c{k}", f"y{k + 1}") for k in range(8)]
    rare = [(f"b{u}", f"rare{u}-{k}") for u in range(9) for k in range(50)]
    df = spark.createDataFrame(block + chain + rare, "user string, item string")
    kept = baskets.supported(df, ["user"], "item", 4)
    assert rows(kept, "user", "item") == sorted(block, key=repr)
    assert {r.users for r in kept.collect()} == {9}
    assert df.count() - kept.count() == len(chain) + len(rare)


@pytest.mark.parametrize("parts", ["1", "4", "13"])
def test_ranks_in_parts(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.range(3000).select(
            F.when(F.col("id") % 10 < 8, "hot").when(F.col("id") % 10 == 8, F.lit(None)).otherwise(F.col("id").cast("string")).alias("g"),
            (F.col("id") * 7919 % 50).alias("s"), "id").repartition(5)
        order = [F.desc("s"), F.asc("id")]
        got = ranking.rank_sorted(df, ["g"], order)
        assert rows(got) == rows(ranking.rank_per_group(df, ["g"], order))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_no_task_ranks_a_whole_group(spark):
    """One group holds all rows; each part of the stored table holds about its share."""
    df = spark.range(40_000).select(F.lit("ALL").alias("g"), (F.col("id") * 31 % 977).alias("s"), "id")
    ranked = ranking.rank_sorted(df, ["g"], [F.desc("s"), F.asc("id")])
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert ranked.agg(F.max("rank")).first()[0] == 40_000
    assert "WindowGroupLimit" not in plan and "Window [row_number" not in plan
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = df.repartitionByRange(parts, "g", F.desc("s"), "id").groupBy(F.spark_partition_id()).count()
    assert by.agg(F.max("count")).first()[0] < 40_000 / parts * 1.5


def test_crawlers_are_dropped_before_the_distinct(spark):
    rng = random.Random(12)
    data = [(user(1), item("AAAAA1", k % 700), "S", None) for k in range(9000)]  # a crawler
    data += [(user(2), item("AAAAA1", k % 5), "S", None) for k in range(9000)]  # hot, with few items
    data += [(user(u), item("BBBBB1", rng.randrange(90)), "S", None) for u in range(3, 300) for _ in range(rng.choice([2, 60]))]
    views = history(spark, data)
    plain, early = alsoview.capped_units(views, 30), alsoview.capped_units(views, 30, crawlers_first=True)
    assert rows(plain.rows, "user", "item") == rows(early.rows, "user", "item")
    assert early.report["baskets"] + early.report["crawlers"] == plain.report["baskets"]
    assert early.report["crawler_rows"] >= 9000
    # The crawler's units were never stored.
    assert {r.user for r in early.stages[0].select("user").distinct().collect()} & {user(1), user(2)} == {user(2)}
    found = {r.user: r.n for r in baskets.hot_users(views.select("user", "item"), "user", ["item"], 650).collect()}
    assert found == {user(1): 9000}
