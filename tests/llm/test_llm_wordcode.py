"""The word code and the predictors over the words of a text."""

import random

import numpy as np
import pytest
from llm_helpers import SCHEMA, rows_of

from aislewise.llm import contextmix, wordcode


def tokens_of(code, keys, group=0):
    keys = np.array(keys, np.uint64)
    return wordcode.in_order(keys, code.leaf(keys), np.full(len(keys), group), np.array([len(keys)]))


def test_chances_of_all_next_words_sum_to_one():
    rng = np.random.default_rng(4)
    keys = rng.integers(1, 1 << 63, 50, dtype=np.uint64)
    code = wordcode.build_code(keys, rng.integers(2, 400, 50), 30)
    counts = np.zeros(2 * wordcode.table_starts(2)[-1], np.int64)
    wordcode.count_decisions(code, tokens_of(code, rng.choice(keys, 4000), 1), counts, 2)
    model = wordcode.TextModel(code, counts.astype(np.float32), 2, learning=True)
    model.log_leaves(tokens_of(code, rng.choice(keys, 4000), 1))
    model = wordcode.TextModel(code, counts.astype(np.float32), 2, False, model.weights, model.cells)
    chances = [np.exp(model.log_leaves(tokens_of(code, [keys[3], keys[8], k], 1))[2]) for k in [*keys, 7]]
    assert sum(chances) == pytest.approx(1.0, abs=1e-3)


def test_counts_of_decisions_equal_one_by_one():
    rng = np.random.default_rng(5)
    keys = rng.integers(1, 1 << 63, 9, dtype=np.uint64)
    code = wordcode.build_code(keys, rng.integers(2, 40, 9), 3)
    tokens, starts = tokens_of(code, rng.choice(keys, 300), 1), wordcode.table_starts(2)
    counts, expected = np.zeros((2, 2 * starts[-1]), np.int64)
    wordcode.count_decisions(code, tokens, counts, 2)
    _, bits, _, slots = wordcode.decisions(code, tokens, starts)
    for own in slots:
        for slot, bit in zip(own.tolist(), bits.tolist()):
            expected[slot + bit * starts[-1]] += 1
    assert (counts == expected).all()


def test_score_depends_on_the_order_of_words(spark):
    rng = random.Random(6)
    phrase = [f"w{k}" for k in range(12)]
    texts = [" ".join(phrase[k % 12:] + phrase[:k % 12]) for k in range(300)]
    mixed = phrase[:]
    rng.shuffle(mixed)
    held = next(i for i in range(300, 400) if contextmix.is_held_out(i))
    other = next(i for i in range(held + 1, 500) if contextmix.is_held_out(i))
    rows = rows_of(texts) + [(held, " ".join(phrase), "en", "s", 1), (other, " ".join(mixed), "en", "s", 1)]
    got = {r.doc_id: r for r in contextmix.score_documents(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    assert got[held].base_score == pytest.approx(got[other].base_score)
    assert got[held].score > got[other].score + 3
