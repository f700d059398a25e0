"""Item vectors kept over numbers, and lists made in rounds of users, against the plain ways."""

from __future__ import annotations

import random
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from aislewise.operators import baskets, boundedtop, userrec
from aislewise.operators.ranking import top_k_per_group
from aislewise.plans import recommend
from aislewise.session import materialize

AS_OF = date(2014, 4, 1)


def counters(spark, users=25, items=18, days=4):
    rng = random.Random(9)
    data = [(date(2014, 3, 1 + d), f"u{u}" if u else None, f"i{i:02d}", rng.randrange(1, 3)) for d in range(days)
            for u in range(users) for i in rng.sample(range(items), rng.randrange(1, 7))]
    df = spark.createDataFrame(data, "dt date, user string, item string, buy long")
    return df.select("dt", "user", "item", "buy", F.lit(0).cast("long").alias("view"), F.lit(0).cast("long").alias("cart"), F.col("dt").alias("buy_date"))


@pytest.mark.parametrize("min_cnt,limit", [(0, 1000), (1, 4), (1, None)])
def test_merged_vectors_of_cells_are_those_of_rows(spark, monkeypatch, min_cnt, limit):
    daily = materialize(counters(spark), "daily")
    columns = ("item", "rank", "other", "cnt")
    plain = rows(userrec.item_vector_merge(userrec.item_vector_daily(daily), min_cnt, limit), *columns)
    by_day = rows(userrec.item_vector_daily(daily), "dt", "item", "other", "cnt")
    monkeypatch.setattr(baskets, "FEW_PAIRS", -1)
    monkeypatch.setattr(baskets, "BLOCK_ROWS", 3)
    vectors = userrec.item_vector_daily(daily)
    merged = userrec.item_vector_merge(vectors, min_cnt, limit)
    assert plain and rows(merged, *columns) == plain and rows(vectors, "dt", "item", "other", "cnt") == by_day
    # Stored once, over numbers: lists of partners, not a row of two codes for each.
    assert dict(merged._vectors.table.dtypes)["others"] == "array<int>"


@pytest.mark.parametrize("task", [20, 4_000_000])
def test_lists_made_in_rounds_are_those_of_all_products(spark, monkeypatch, task):
    monkeypatch.setattr(userrec, "TASK_PRODUCTS", task)
    daily = counters(spark)
    users, vectors = recommend.store_vectors(daily, date(2014, 3, 1), AS_OF, min_cnt=0)
    sums = userrec.score_product(users, vectors).groupBy("user", "other").agg(F.sum("milli").alias("milli"))
    expected = rows(top_k_per_group(
        userrec.purchase_cycle_filter(sums, users, AS_OF), ["user"], [F.desc("milli"), F.asc("other")], 5), "user", "rank", "other", "milli")
    monkeypatch.setattr(baskets, "FEW_PAIRS", -1)
    monkeypatch.setattr(userrec, "ROUND_PRODUCTS", 10)
    made = []
    monkeypatch.setattr(userrec, "materialize", lambda df, name: made.append(name) or materialize(df, name))
    again = recommend.store_vectors(daily, date(2014, 3, 1), AS_OF, min_cnt=0)
    got = userrec.user_recommend(*again, AS_OF, 5)
    assert expected and rows(got, "user", "rank", "item", "milli") == expected
    assert 2 < made.count("product-lists") <= userrec.MAX_ROUNDS
    bounded = boundedtop.bounded_top(*again, AS_OF, 5, first_read=1)
    assert rows(bounded.ranked, "user", "rank", "item", "milli") == expected
