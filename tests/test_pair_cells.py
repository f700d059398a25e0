"""Pairs counted in cells of two parts of the items, against brute force."""

from __future__ import annotations

import random
import time
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from conftest import rows
from test_recommend import history, item, user
from test_sent_pairs import lists

from aislewise.operators import alsoview, baskets, pairkernels
from aislewise.session import materialize


@pytest.mark.parametrize("step", [3, 1 << 21])
@pytest.mark.parametrize("ordered", [False, True])
def test_counts_in_steps_are_the_counted_pairs(step, ordered, monkeypatch):
    monkeypatch.setattr(pairkernels, "STEP", step)  # with 3, most items have more pairs than a step
    rng = random.Random(5)
    left = [rng.sample(range(9), rng.randrange(4)) for _ in range(40)]
    right = left if ordered else [rng.sample(range(7), rng.randrange(4)) for _ in range(40)]
    flat = [np.array([x for part in side for x in part], np.int32) for side in (left, right)]
    sizes = [np.array([len(part) for part in side]) for side in (left, right)]
    found = Counter()
    for a, b, n in pairkernels.pair_counts(flat[0], sizes[0], flat[1], sizes[1], ordered):
        for x, y, k in zip(a, b, n):
            assert (x, y) not in found
            found[int(x), int(y)] = int(k)
    assert found == Counter((a, b) for p, q in zip(left, right) for a in p for b in q if not ordered or a < b)


def test_numbers_survive_their_packing():
    values = np.array([0, 1, 65535, 65536, (1 << 31) - 1])
    assert pairkernels._unpacked(pairkernels._packed(values)).tolist() == values.tolist()


@pytest.mark.parametrize("each", [10, 24_000_000])
def test_cells_count_what_baskets_hold(spark, monkeypatch, each):
    """Null keys and items meet nothing, a row that comes twice counts twice; each pair is in one cell, and no pair is shuffled."""
    monkeypatch.setattr(baskets, "FEW_PAIRS", -1)
    monkeypatch.setattr(baskets, "CELL_PAIRS", each)
    rng = random.Random(2)
    held = {f"u{u}": [f"i{rng.randrange(30):02d}" for _ in range(size)] for u, size in enumerate([1, 2, 7, 12, 60, *[5] * 30])}
    data = [(u, i) for u, its in held.items() for i in its] + [(None, "i01"), (None, "i02"), ("u2", None), ("u3", None)]
    expected = Counter(p for its in held.values() for p in permutations(its, 2) if p[0] != p[1])
    counted = baskets.cooccurrence(spark.createDataFrame(data, "user string, item string"), ["user"], bounded=False)
    got = rows(counted, "item", "other", "cnt")
    assert {(a, b): n for a, b, n in got} == dict(expected) and len(got) == len(expected)
    text = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in text and "count(1)" not in text


def test_similarity_in_cells_with_a_least_score(spark, monkeypatch):
    rng = random.Random(4)
    codes = [item(f"{f}{s}", k) for k, (f, s) in enumerate((f, s) for f in ("AAAA", "BBBB") for s in ("11", "12", "21"))]
    seen = history(spark, [(user(u), c, c[:6], None) for u in range(20) for c in rng.sample(codes, 4)])
    joined = [rows(alsoview.similar_items(alsoview.capped_units(seen, None), least)) for least in (0, 8)]
    monkeypatch.setattr(baskets, "FEW_PAIRS", -1)
    for least, expected in zip((0, 8), joined):
        found = alsoview.similar_items(alsoview.capped_units(seen, None), least)
        assert expected and rows(found) == expected
        assert "MapInArrow" in found._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("cap", [None, 100])
def test_ranked_lists_in_rounds_are_those_of_joined_pairs(spark, cap, monkeypatch):
    """Hot units in slices, and rounds of a few units, whose lists are stored: nothing is left to shuffle but the lists."""
    joined = list(lists(spark, cap))
    monkeypatch.setattr(baskets, "FEW_PAIRS", -1)
    monkeypatch.setattr(baskets, "TASK_PAIRS", 60)
    monkeypatch.setattr(baskets, "ROUND_PAIRS", 300)
    monkeypatch.setattr(baskets, "ROUND_SHARE", 0)
    made = []
    monkeypatch.setattr(baskets, "materialize", lambda df, name: made.append(name) or materialize(df, name))
    for a, b in zip(joined, lists(spark, cap), strict=True):
        assert a and a == b
    assert made.count("ranked-others") >= 8 and "hot-units" in made


def test_stage_tables_leave_no_shuffle_files(spark):
    def files():
        manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {name for name in manager.getAllFiles().mkString(" ").split() if "/shuffle_" in name}

    before = files()
    materialize(spark.range(1000).repartition(7).groupBy("id").count(), "kept")
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
