"""The pipeline stage by stage on the smallest tables."""

from __future__ import annotations

import collections
import random

import corpus_pipeline
import pytest
from llm_helpers import components, words

from aislewise.llm import bestfit, bigru, pfair, queries
from aislewise.llm.scratch import Scratch
from aislewise.llm.subwords import default_tokenizer, subwords

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_pipeline_against_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    scratch, docs, kept = Scratch(spark, "test-pipeline"), spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir))
        assert docs.columns == COLUMNS
        kept.append([(r.doc_id, r.text, r.source) for r in docs.collect()])
    all_ids = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    first, second, third, fourth = ({d[0] for d in k} for k in kept)
    assert first < all_ids and second <= first and third <= second and fourth == third
    good = [i for i in all_ids if i in labels and labels[i].quality == 1]
    assert len([i for i in good if i in first]) >= 0.95 * len(good)
    groups = components([(i, t) for i, t, _ in kept[1]], 80)
    assert third == {i for i in second if groups[i] == i}

    mixed = pfair.mix_sources(spark.createDataFrame([(i, s) for i, _, s in kept[2]], "doc_id long, source string"))
    order = [r.doc_id for r in sorted(mixed.collect(), key=lambda r: r.position)]
    written = docs.select("doc_id", "_metadata.file_name", "_metadata.row_index").orderBy("file_name", "row_index")
    assert [r.doc_id for r in written.collect()] == order

    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    encoder = subwords(default_tokenizer("byte_bpe_50k.json"), spaces=True).tokenizer
    sizes = {i: len(encoder.encode(t, add_special_tokens=False).ids) + 1 for i, t, _ in kept[3]}
    found = collections.Counter()
    for r in packed:
        found[r.doc_id] += r.length
    assert dict(found) == sizes


def test_packed_sequences_follow_the_mix(spark):
    rng = random.Random(6)
    sources = ["hot"] * 4000 + ["b"] * 900 + ["c"] * 100
    # The hot source has the longest texts.
    rows = [(k, words(rng, rng.randrange(60, 200) if s == "hot" else rng.randrange(20, 60)), "en", s, 0) for k, s in enumerate(sources)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    packed = corpus_pipeline.pack(spark, docs, "").collect()
    place = {r.doc_id: r.position for r in pfair.mix_sources(docs).collect()}
    first = collections.defaultdict(lambda: len(rows))
    places = collections.defaultdict(list)
    for r in packed:
        first[r.sequence_id] = min(first[r.sequence_id], place[r.doc_id])
        places[r.sequence_id].append((r.offset, r.length))
    order = sorted(first)
    assert [first[s] for s in order] == sorted(first.values())
    for own in places.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and own[-1][0] + own[-1][1] <= 1024
    assert len(places) <= 1.03 * sum(r.length for r in packed) / 1024 + 5
    source = dict(enumerate(sources))
    mixed = [source[i] for i, _ in sorted(place.items(), key=lambda x: x[1])]
    for part in (0.25, 0.5, 0.75):
        held = [source[r.doc_id] for r in packed if r.sequence_id < order[int(part * len(order))] and r.start == 0]
        expected = collections.Counter(mixed[:len(held)])
        for name, n in collections.Counter(held).items():
            assert abs(n - expected[name]) <= 0.1 * len(held), (part, name)


def test_odd_tables_go_through_all_stages(spark, tmp_path):
    """Nulls, repeated ids of unlike texts, columns of clashing names, and no rows at all."""
    rng = random.Random(8)
    text = words(rng, 80)
    rows = [(1, words(rng, 60), "en", "a", 5), (1, words(rng, 60), "en", "a", 5), (2, text, "en", "b", 5), (3, text, None, None, None),
            (None, text, "en", "a", 1), (None, words(rng, 50), "en", None, 1), (None, None, None, None, None), (4, "", "en", "a", 0)]
    more = "_id string, _position int, position int, id int, quality_score int, row_key int, mixed_id int, k int, h int, child int"
    docs = spark.createDataFrame([(*r, "x", *range(9)) for r in rows], f"doc_id long, text string, lang string, source string, n_chars long, {more}")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for table in (docs, docs.limit(0)):
        scratch, kept = Scratch(spark, "odd"), table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = scratch.save(stage(spark, kept, str(tmp_path)))
            assert kept.columns == docs.columns
        left = [(r.doc_id, r.text) for r in kept.collect()]
        if table is docs:
            expected = {(r[0], r[1]) for r in rows} - {(3, text), (None, text)}
            assert set(left) == expected and len(left) == len(expected)
        packed = corpus_pipeline.STAGES[-1][1](spark, kept, str(tmp_path)).collect()
        assert len(packed) == len(left)


def test_rows_of_one_id_are_judged_apart(spark, tmp_path):
    good, bad = "plain words of a text that is fine to read", "zork blat vile zork blat vile zork blat"
    rows = [(k, f"{bad if k % 2 else good} {k}", "en", "a", 0) for k in range(200)] + [(0, bad, "en", "a", 0), (None, bad, "en", "a", 0), (None, good, "en", "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    spark.createDataFrame([(k, 1, k % 2) for k in range(1, 200)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.toxicity(spark, docs, str(tmp_path)).collect()]
    assert sorted(kept, key=str) == sorted([(r[0], r[1]) for r in rows if r[1].startswith("plain")], key=str)


def test_training_sample_is_bounded_by_texts(spark):
    rows = [(1, "same vile text")] * 3000 + [(k, f"text number {k}") for k in range(2, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 2 == 1)) for k in range(1, 60)] + [(k, 1) for k in range(100, 400)], "id long, label int")
    # Labels of absent documents take no places, and a repeated row one: both samples are the same ten texts.
    one, other = (bigru.train(d, labels, train_docs=10) for d in (docs, docs.dropDuplicates()))
    assert (one.vocabulary == other.vocabulary).all() and one.slope == pytest.approx(other.slope)
    assert all((one.weights[k] == other.weights[k]).all() for k in one.weights)


def test_neighbour_merges_fill_sequences(spark):
    rng = random.Random(3)
    rows = [(k, rng.randrange(300, 700), k) for k in range(3000)]
    items = spark.createDataFrame(rows, "doc_id long, length long, position long").repartition(4)

    def pack(rounds):
        found = bestfit.pack_in_order(items, window_places=16, rounds=rounds).collect()
        fills, places = collections.Counter(), collections.defaultdict(list)
        for r in found:
            fills[r.sequence_id] += r.length
            places[r.sequence_id].append((r.offset, r.length, r.position))
        assert max(fills.values()) <= 1024 and len(found) == len(rows)
        for own in places.values():
            own.sort()
            assert own[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(own, own[1:]))
        first = [min(p for _, _, p in places[s]) for s in sorted(places)]
        assert first == sorted(first)
        return len(fills)

    apart, merged = pack(0), pack(3)
    assert merged < apart


def test_run_and_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "toxicity", "minhash_near_dedup", "mixing_sources", "best_fit_packing"]
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES) and len(queries.QUERIES) == 13
