"""The operators against brute-force versions and exact round trips."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import LOWER, SCHEMA, WORD, components, rows_of, words
from pyspark.sql import functions as F

from aislewise.llm import bestfit, bigru, chatformat, contextmix, minhash_join, multisethash, pfair, qda, rans, repetition
from aislewise.llm import queries as Q
from aislewise.llm.subwords import Subwords, default_tokenizer
from aislewise.llm.textbatch import slices


def family(rng, base, copies, edits):
    """Copies of a text with some words replaced."""
    for _ in range(copies):
        own = base.split()
        for at in rng.sample(range(len(own)), rng.randrange(edits + 1)):
            own[at] = f"e{rng.randrange(30)}"
        yield " ".join(own)


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_against_all_pairs(spark, percent):
    rng = random.Random(percent)
    texts = [words(rng, rng.randrange(1, 90)) for _ in range(60)]
    texts += [*family(rng, words(rng, 80), 60, 6), *family(rng, words(rng, 30), 40, 3)]
    texts += ["shared line of seven words here now " + words(rng, 12) for _ in range(40)] + ["One two", "one TWO", "", None]
    rng.shuffle(texts)
    docs = spark.createDataFrame(rows_of(texts), SCHEMA).repartition(5)
    got = {r.doc_id: r.component_id for r in minhash_join.near_duplicates(docs, percent=percent).collect()}
    assert got == components([(i, t) for i, t in enumerate(texts)], percent)


def test_match_threshold_keeps_nearly_all_pairs():
    t = minhash_join.match_threshold(85, 40)
    missed = sum(math.comb(40, k) * 0.85**k * 0.15 ** (40 - k) for k in range(t))
    assert missed <= 1e-6 and minhash_join.match_threshold(80, 40) <= t


def test_rows_of_one_id_are_tied(spark):
    a, b, c = (words(random.Random(k), 40) for k in range(3))
    docs = spark.createDataFrame([(1, a), (2, b), (2, a), (3, b), (4, c)], "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in minhash_join.near_duplicates(docs).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_repetition_against_counting(spark):
    rng = random.Random(1)
    texts = [words(rng, rng.randrange(0, 60), 4) + "\n" + words(rng, 8, 2) + "\n\n" + words(rng, 8, 2) for _ in range(60)]
    texts += ["a b c d e f g h " * 3, "x\nx\nx", "|#*<> é%"]
    docs = spark.createDataFrame(rows_of(texts), SCHEMA)
    got = {r.doc_id: r for r in repetition.judge(repetition.repetition_stats(docs)).collect()}
    for i, text in enumerate(texts):
        own = WORD.findall(text)
        grams = collections.Counter(tuple(own[k:k + 8]) for k in range(len(own) - 7))
        twice = {j for k in range(len(own) - 7) if grams[tuple(own[k:k + 8])] > 1 for j in range(k, k + 8)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        seen, later = set(), set()
        for k in range(len(own) - 4):
            later |= set(range(k, k + 5)) if tuple(own[k:k + 5]) in seen else set()
            seen.add(tuple(own[k:k + 5]))
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.dup_ngram_chars[0]) == (
            len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(twice),
            sum(len(own[k]) for k in later))
        assert r.base_failed == (len(own) < 20 or 100 * len(twice) > 30 * len(own)) and not (r.base_failed and r.kept)


def test_chat_round_trip_and_machine(spark):
    rows = [
        ("c", 1, "user", "<s>[INST]a<\\s>[\\/INST]<<SYS>>"), ("c", 2, "assistant", ""), ("c", 3, "a<</ROLE>>b", "<</TURN>><\\</TURN>>\\"),
        ("c", 4, None, None), ("d", 1, "assistant", "<"), ("d", 2, "user", "["), (None, None, "system", "x$1\\$0\n\n"),
        ("d", 2, "user", "["), ("e", 1, "user", "q"), ("e", 2, "assistant", "</s>[INST] ok [/INST]"), ("e", 3, "user", "again"),
    ]
    template = chatformat.Template()
    done = chatformat.format_conversations(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string"), template)
    read = done.withColumn("formatted", chatformat.formatted_text(F.col("segments"))).select(
        "conv_id", "valid", "wrong_turn", chatformat.read_turns(F.col("formatted"), template).alias("turns"),
        chatformat.loss_text(F.col("segments"), template).alias("loss"), "formatted")
    got = {r.conv_id: r for r in read.collect()}
    for conv in ("c", "d", "e", None):
        own = sorted(((t, role or "", text or "") for c, t, role, text in rows if c == conv), key=lambda x: (x[0] or 0, x[1:]))
        assert [(t.role, t.text) for t in got[conv].turns] == [x[1:] for x in own]
        assert got[conv].loss == "".join(x[2] for x in own if x[1] == "assistant")
    assert (got["c"].wrong_turn, got["d"].wrong_turn, got["e"].valid, got[None].valid) == (3, 1, True, True)
    assert got["e"].formatted.count("</s>") == 1
    assert chatformat.format_conversations(spark.createDataFrame([], "conv_id int, turn int, role string, text string")).count() == 0


def test_best_fit_packs_all_without_gaps(spark):
    rng = random.Random(3)
    items = spark.createDataFrame([(k, rng.randrange(1, 101)) for k in range(3000)], "k long, length long").repartition(7)
    got = bestfit.best_fit_pack(items, capacity=100, node_items=50).collect()
    assert sorted(r.k for r in got) == list(range(3000))
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and own[-1][0] + own[-1][1] <= 100
    assert len(bins) <= 1.03 * math.ceil(sum(r.length for r in got) / 100)


def test_items_that_never_share_a_bin_end(spark):
    items = spark.range(500).select("id", F.lit(60).cast("long").alias("length")).repartition(5)
    got = bestfit.best_fit_pack(items, capacity=100, node_items=40)
    assert got.select("sequence_id").distinct().count() == 500


def test_pieces(spark):
    assert bestfit.cut(2500, 1024).tolist() == [0, 452, 1476, 2500] and bestfit.cut(2048, 1024).tolist() == [0, 1024, 2048]
    docs = spark.createDataFrame([(1, "the cat " * 2000), (2, None)], "doc_id long, text string")
    got = bestfit.token_pieces(docs, default_tokenizer("byte_bpe_50k.json"), 2, with_ids=True).orderBy("doc_id", "piece").collect()
    assert [r.ids for r in got if r.doc_id == 2] == [[2]]
    flat = [i for r in got if r.doc_id == 1 for i in r.ids]
    expected = Subwords(default_tokenizer("byte_bpe_50k.json"), True).tokenizer.encode("the cat " * 2000, add_special_tokens=False).ids + [2]
    assert flat == expected and all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got)


@pytest.mark.parametrize("name,spaces", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_chunked_ids_equal_those_of_whole_texts(name, spaces):
    texts = ["", "  a  b", "x    y\n\n z ", "I'm it's,.. o.k! <|endoftext|>  　 é.", "éa .́b Á.", "İstanbul ΑΣ. x\u0085 y\t\t\n",
             "don't'S a.'s", "…. a…!", "a  b  c ", "1.5, 2:30;", "nul\0 in, \0", " 's 't", "word, word. 'word' word's"]
    encoder = Subwords(default_tokenizer(name), spaces)
    for _ in range(2):  # again from the cache
        for _, _, part in slices(pa.array(texts)):
            ids, offsets = encoder.encode(part)
    expected = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == expected


def test_language_model_base_and_distribution(spark):
    rng = random.Random(8)
    texts = [words(rng, rng.randrange(0, 40), 60) + " Only" + str(k) for k in range(80)]
    got = {r.doc_id: r for r in contextmix.score_documents(spark.createDataFrame(rows_of(texts), SCHEMA).repartition(4)).collect()}
    tokens = {i: [*WORD.findall(t.translate(LOWER)), None] for i, t in enumerate(texts)}
    count = collections.Counter(w for i, own in tokens.items() if zlib.crc32(str(i).encode()) % 10 for w in own)
    n, v = sum(count.values()), len(count)
    for i, own in tokens.items():
        base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(count[w] > 0 for w in own), n)
        assert r.base_score == pytest.approx(base) and r.score < 0 and r.held_out == (zlib.crc32(str(i).encode()) % 10 == 0)


def test_lexicon_rows_do_not_grow_with_the_uses_of_a_word(spark):
    def largest(copies):
        rows = spark.createDataFrame([(k, "one text that is copied") for k in range(copies)], "id long, text string").coalesce(1)
        table = contextmix.chunk_words(rows, 1, np.zeros((1, contextmix.BINS))).where("bucket < 1")
        return contextmix.merge_buckets(table, 1).agg(F.max(F.octet_length("data"))).first()[0]

    assert largest(4000) == largest(40)


def test_spelling_probabilities_sum_to_one_for_each_byte():
    rng = np.random.default_rng(0)
    model = contextmix.Model(rng.integers(0, 5, 2 * contextmix.TABLE_SLOTS))
    total = 0.0
    for byte in range(256):  # words of one byte: P(byte) * P(terminator | byte), or the terminator first
        length, blob = (np.array([0]), np.zeros(0, np.uint8)) if byte == 0x20 else (np.array([1]), np.array([byte], np.uint8))
        _, _, words_ = next(contextmix.spelled(length, blob))
        logs = 0.0
        for k in range(8):
            node, bit = words_.bit(k)
            x = np.stack([model.plain[words_.slots(o, node)] for o in range(len(contextmix.SIZES))])
            gate = k * 4 + (x[2:] != 0).sum(axis=0)
            _, p = model.refined(node, (model.weights[gate].T * x).sum(axis=0))
            logs += np.log(np.where(bit, p, 1 - p))[0]
        total += np.exp(logs)
    assert total == pytest.approx(1.0)


def test_multiset_hash_is_homomorphic_and_order_free():
    a, b, c = "one two three", "four five", "six"
    def of(*parts):
        return multisethash.vectors(pa.array(["\n".join(parts)]))
    same = of(c, a, b)
    assert all((x == y).all() for x, y in zip(of(a, b, c), same))
    assert all((x == y).all() for x, y in zip(multisethash.add(of(a, b), of(c)), same))
    assert all((x == y).all() for x, y in zip(multisethash.add(same, of(b), -1), of(a, c)))
    assert not (of(a, a)[0] == of(a)[0]).all()
    assert all((x == y).all() for x, y in zip(multisethash.decode(multisethash.encode(*same)), same))
    assert multisethash.likeness(same[1], same[1])[0] == 1


def test_edited_texts_follow_the_next_document(spark):
    rng = random.Random(2)
    texts = [words(rng, rng.randrange(0, 50)) + "é" * (k % 3) for k in range(90)]
    docs = spark.createDataFrame(rows_of(texts), SCHEMA).repartition(6)
    got = {r.doc_id: r for r in multisethash.compare_edited(docs, ranges=7).collect()}
    for i, text in enumerate(texts):
        half = len(text) // 2
        edited = text[:len(text) - half] + texts[i - 1][:half]  # descending order, from 0 back to the last
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[i].n_chars == len(text)
        assert (got[i].fingerprint == got[i].edited_fingerprint) == (edited == text) or len(text) < 3


def test_schedule_stays_within_a_block():
    for weights in ([1, 1, 1], [5, 3, 2], [1000, 1, 1, 7], [0.5], [9, 9, 1]):
        parts = pfair.parts_of(weights, 400)
        slots, done, total = pfair.schedule(parts), np.zeros(len(parts)), sum(parts)
        for t, (source, block) in enumerate(slots, 1):
            assert block == done[source]
            done[source] += 1
            assert np.abs(done - np.array(parts) * t / total).max() < 1


def test_mix_takes_blocks_in_scheduled_order(spark):
    sizes = {"a": 700, "b": 200, None: 45}
    rows = [(k, s) for k, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    docs = spark.createDataFrame(rows, "doc_id long, source string").repartition(4)
    got = sorted(pfair.mix_sources(docs, {"a": 0.5, "b": 0.3, None: 0.2}, block_docs=10, period=100).collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(945)) and {r.doc_id for r in got} == set(range(945))
    blocks = list(dict.fromkeys((r.slot, r.source, r.block) for r in got))
    assert [b[0] for b in blocks] == sorted({b[0] for b in blocks})
    names = ["a", "b", None]
    period = pfair.schedule([50, 30, 20])
    for slot, source, block in blocks:
        s, nth = period[slot % 100]
        assert names[s] == source and block == slot // 100 * [50, 30, 20][s] + nth
    assert sum(r.source == "a" for r in got[:200]) == 100


def test_rans_round_trip_and_checks():
    rng = np.random.default_rng(4)
    counts = np.bincount(rng.zipf(1.3, 50_000) % 3000, minlength=3000)
    table = rans.FrequencyTable.from_counts(counts)
    assert table.freq.sum() == 1 << rans.SCALE_BITS and ((table.freq > 0) == (counts > 0)).all()
    for n in (1, 5, 1024, 1025, 300_000):
        ids = rng.choice(np.flatnonzero(counts), n).astype(np.int32)
        data = rans.pack_block(np.array([7, 9]), np.array([True, False]), np.array([n - 1, 1]), ids, table)
        doc_ids, valid, lengths, back = rans.unpack_block(data, table, table.symbols())
        assert (back == ids).all() and doc_ids.tolist() == [7, 9] and valid.tolist() == [True, False] and lengths.sum() == n
    with pytest.raises(rans.CorruptBlock):
        rans.unpack_block(data[:100] + bytes([data[100] ^ 1]) + data[101:], table, table.symbols())
    other = rans.FrequencyTable.from_counts(counts + 1)
    with pytest.raises(rans.CorruptBlock):
        rans.unpack_block(data, other, other.symbols())


def test_rans_is_near_the_entropy():
    rng = np.random.default_rng(4)
    ids = (rng.zipf(1.5, 400_000) % 2000).astype(np.int32)
    counts = np.bincount(ids, minlength=2000)
    p = counts[counts > 0] / len(ids)
    bits = 8 * len(rans.pack_block(np.array([1]), np.array([True]), np.array([len(ids)]), ids, rans.FrequencyTable.from_counts(counts)))
    assert bits < 1.2 * len(ids) * -(p * np.log2(p)).sum()


def test_discriminant_separates_and_is_finite():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1, (200, 15)), rng.normal(1.5, 0.5, (400, 15))])
    y = np.repeat([0, 1], [200, 400])
    counts = np.array([200.0, 400.0])
    sums = np.array([x[y == k].sum(axis=0) for k in (0, 1)])
    squares = np.array([x[y == k].T @ x[y == k] for k in (0, 1)])
    model = qda.fit(counts, sums, squares)
    assert ((model.log_ratio(x) > 0) == y).mean() > 0.98
    assert qda.fit(np.array([0.0, 5.0]), sums, squares) is None


def test_network_gradients_agree_with_differences():
    texts = ["you are a vile rat today", "a fine day in the park", "vile vile things", "park and day"] * 3
    trainer = bigru.Trainer(texts, np.array([1, 0, 1, 0] * 3))
    network = trainer.start()
    trainer.table_rows = network.word_rows(trainer.hashes)
    w = {k: v.astype(np.float64) for k, v in network.weights.items()}
    windows, target = np.arange(4), np.array([1.0, 0, 1, 0])

    def loss(weights):
        z = bigru.window_logits(bigru.word_inputs(trainer.table_rows, *trainer.slots_of(np.arange(len(trainer.hashes))), weights),
                                trainer.ids[trainer.place[windows]], trainer.mask[windows], weights)
        p = bigru.sigmoid(z)
        return -(target * np.log(p) + (1 - target) * np.log(1 - p)).mean()

    state = {"t": 0}
    network.weights = {k: v.copy() for k, v in w.items()}
    trainer.step(network, windows, target, np.ones(4), state)
    for name in ("out", "query", "attend", "u_f", "in_b", "b_f"):
        grad = state[name][0] / 0.1  # the first moment after one step
        at = np.unravel_index(np.argmax(np.abs(grad)), grad.shape)
        up, down = ({k: v.copy() for k, v in w.items()} for _ in range(2))
        up[name][at] += 1e-2
        down[name][at] -= 1e-2
        assert grad[at] == pytest.approx((loss(up) - loss(down)) / 2e-2, rel=0.15, abs=2e-4), name


def test_windows_cover_every_word():
    for n in (0, 1, 31, 32, 33, 47, 48, 49, 200, 1000):
        covered = {w for s in bigru.window_starts(n).tolist() for w in range(s, min(s + bigru.WINDOW, n))}
        assert covered == set(range(n))
        assert len(bigru.window_starts(n)) <= max(1, n / bigru.STRIDE + 1)


def test_character_ngrams_reach_the_end_of_long_words():
    data = np.frombuffer(b"short" + b"x" * 40 + b"vermin", np.uint8)
    slots, owners = bigru.character_slots(data, np.array([0, 5]), np.array([5, 51]))
    assert np.bincount(owners).tolist() == [sum(n + 3 - g for g in bigru.GRAMS) for n in (5, 46)]
    ends, _ = bigru.character_slots(np.frombuffer(b"xxxxxvermin", np.uint8), np.array([0]), np.array([11]))
    assert len(set(slots) & set(ends)) >= 20


def test_long_runs_and_unspaced_scripts_become_bounded_words():
    texts = ["a" * 20 + "b" * 20 + "c" * 30, "ab \u4f60\u597d\u5417x", "\u0e01\u0e02", "\u4f60", "", "short \u00fcber \uac00\uac01\uac02"]
    for _, _, part in slices(pa.array(texts)):
        low, words_, _ = bigru.words_of(part)
    got = [[low.data[s:e].tobytes().decode() for s, e in zip(words_.starts[a:b], words_.ends[a:b])] for a, b in zip(words_.rows[:-1], words_.rows[1:])]
    assert all(len(w) <= bigru.PIECE_BYTES for w in got[0]) and got[0][-1].endswith("c" * 10)
    assert {texts[0][k:k + 12] for k in range(59)} <= {w[k:k + 12] for w in got[0] for k in range(len(w) - 11)}
    assert got[1:] == [["ab", "\u4f60\u597d", "\u597d\u5417", "x"], ["\u0e01\u0e02"], ["\u4f60"], [], ["short", "\u00fcber", "\uac00\uac01\uac02"]]


@pytest.mark.parametrize("alphabet,term", [([chr(0x4E00 + k) for k in range(400)], "\u6bd2\u86c7"), ([*"abcdefghijklmnopqrstuvwxyz"], "zqvxkj")])
def test_terms_late_in_a_run_are_seen(alphabet, term):
    rng = random.Random(9)

    def text(toxic):
        own = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(15, 60))) for _ in range(2)]
        return own[0] + own[0][:30] + (term if toxic else "") + own[1]

    labels = np.array([k % 3 == 0 for k in range(400)], int)
    network = bigru.Trainer([text(x) for x in labels[:300]], labels[:300]).fit()
    for _, _, part in slices(pa.array([text(x) for x in labels[300:]])):
        scores = bigru.score_texts(part, network)
    assert ((scores >= 0.5) == labels[300:]).mean() >= 0.9


@pytest.mark.parametrize("name,column,modulus,rest,least", [
    ("op8_quality_classifier", "quality", 5, 0, 0.95), ("op9_toxicity", "toxic", 4, 2, 0.9)])
def test_held_out_accuracy(spark, name, column, modulus, rest, least):
    sf_dir = "/root/testdata/sf0.01"
    got = Q.QUERIES[name](spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where("held_out")
    rows = got.select("doc_id", "predicted", column, "score").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % modulus == rest and 0 <= r.score <= 1 for r in rows)
    assert sum(r.predicted == r[column] for r in rows) >= least * len(rows)
