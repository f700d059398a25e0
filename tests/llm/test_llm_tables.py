"""Tables of the language model: what makes them runs once, in few tasks, and gives the same counts and order as plain numpy."""

import os

import numpy as np
import pytest

from aislewise.llm import contextmix, wordcode
from aislewise.llm.scratch import Scratch


def test_tasks_behind_a_summed_table_run_once(spark, tmp_path):
    folder = str(tmp_path)

    def part(batches):
        list(batches)
        open(os.path.join(folder, os.urandom(8).hex()), "w").close()
        yield from contextmix._table_parts(np.arange(100) % 7)

    with contextmix.chunk_settings(spark):
        rows = contextmix.map_batches(spark.range(0, 30, 1, 3), part, "part bigint, data binary")
        sums = contextmix.summed(rows, 100, Scratch(spark, "summed"))
    assert len(os.listdir(folder)) == 3
    assert sums.tolist() == (3 * (np.arange(100) % 7)).tolist()


def test_passes_take_several_rows_a_task(spark):
    rows = spark.range(0, 4000, 1, 4000)
    cores = spark.sparkContext.defaultParallelism
    assert contextmix.in_tasks(rows, 1).rdd.getNumPartitions() == contextmix.TASKS_PER_CORE * cores
    assert contextmix.in_tasks(rows, 20_000).rdd.getNumPartitions() == 20_000 // contextmix.TASK_BUCKETS


@pytest.mark.parametrize("keys", [[], [7], [5, 5, 3, 9, 3], [(1 << 63) + 1, 1 << 63, (1 << 63) + 1, 1 << 63, 2, 1, 2]])
def test_distinct_keys_equal_those_of_numpy(keys):
    keys = np.array(keys, np.uint64)
    for got, expected in zip(contextmix.distinct_keys(keys), np.unique(keys, return_index=True, return_inverse=True)):
        assert got.tolist() == expected.tolist()


@pytest.mark.parametrize("below", [10, 1 << 62])
def test_grouped_places(below):
    order, first = contextmix.grouped(np.array([4, 1, 4, 4, 1, 9]), below)
    assert order.tolist() == [1, 4, 0, 2, 3, 5] and first.tolist() == [0, 2, 5]


@pytest.mark.parametrize("learning", [False, True])
def test_log_leaves_equal_decisions_one_by_one(learning):
    rng = np.random.default_rng(7)
    keys = rng.integers(1, 1 << 63, 40, dtype=np.uint64)
    code, own = wordcode.build_code(keys, rng.integers(2, 400, 40), 30), rng.choice(keys, 500)
    tokens = wordcode.in_order(own, code.leaf(own), np.ones(500, np.int64), np.array([200, 0, 1, 299]))
    starts = wordcode.table_starts(2)
    counts = np.zeros(2 * starts[-1], np.int64)
    wordcode.count_decisions(code, tokens, counts, 2)
    model = wordcode.TextModel(code, counts.astype(np.float32), 2, learning=learning)
    weights, got, expected = model.weights.copy(), model.log_leaves(tokens), np.zeros(500)
    zeros, ones = counts[:starts[-1]], counts[starts[-1]:]
    for token, bit, depth, *slots in zip(*wordcode.decisions(code, tokens, starts)[:3], *wordcode.decisions(code, tokens, starts)[3]):
        x = [np.log((max(ones[s] - (learning and bit == 1), 0) + 0.3) / (max(zeros[s] - (learning and bit == 0), 0) + 0.3)) for s in slots]
        gate = min(depth, wordcode.DEPTHS - 1) * 4 + (x[2] != 0) + 2 * (x[3] != 0)
        mixed = np.clip(weights[gate] @ x, -15, 15)
        p = (1 / (1 + np.exp(-mixed)) + 1 / (1 + np.exp(-(np.clip(np.rint((mixed + 8) * 2), 0, wordcode.STEPS - 1) / 2 - 8)))) / 2
        expected[token] += np.log(p if bit else 1 - p)
    assert got == pytest.approx(expected, rel=1e-3, abs=1e-3)
