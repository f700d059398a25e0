"""Every operator on documents: empty tables, nulls, long texts, repeated rows, other columns."""

from __future__ import annotations

import pytest
from llm_helpers import CLASHING, SCHEMA, odd_rows, with_clashing

from aislewise.llm import bestfit, bigru, contextmix, minhash_join, multisethash, pfair, qda, rans, repetition
from aislewise.llm.subwords import default_tokenizer
from aislewise.session import scratch_path


def write_and_read(docs):
    folder = scratch_path(docs.sparkSession, "test-rans")
    rans.write_token_files(docs, folder, default_tokenizer("word_bpe_49k.json"), 1)
    return rans.read_token_files(docs.sparkSession, folder, 49408).withColumnRenamed("id", "doc_id")


def no_labels(docs):
    return docs.sparkSession.createDataFrame([], "id long, label int")


OPERATORS = {
    "minhash": minhash_join.near_duplicates,
    "repetition": lambda d: repetition.judge(repetition.repetition_stats(d)),
    "bestfit": lambda d: bestfit.best_fit_pack(bestfit.token_pieces(d, default_tokenizer("byte_bpe_50k.json"), 2)),
    "contextmix": contextmix.score_documents,
    "multisethash": multisethash.compare_edited,
    "fingerprints": multisethash.fingerprints,
    "pfair": pfair.mix_sources,
    "qda": lambda d: qda.score(qda.document_statistics(d), qda.train(qda.document_statistics(d), no_labels(d))).withColumnRenamed("id", "doc_id"),
    "bigru": lambda d: bigru.score(d, bigru.train(d, no_labels(d))).withColumnRenamed("id", "doc_id"),
    "rans": write_and_read,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_other_columns(spark, name):
    rows = odd_rows()
    docs = spark.createDataFrame(with_clashing(rows), CLASHING).repartition(3)
    got = OPERATORS[name](docs).collect()
    ids = sorted((r.doc_id for r in got if name != "bestfit" or r.piece == 0), key=str)
    assert ids == sorted((r[0] for r in rows), key=str)


def test_defined_results_of_odd_rows(spark):
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    near = {r.doc_id: r for r in OPERATORS["minhash"](docs).collect() if r.doc_id is not None}
    assert (near[1].n_shingles, near[1].component_id, near[1].kept) == (0, 1, True)
    assert near[3].component_id == 3 and near[4].kept and not near[5].kept and near[5].component_id == 4
    judged = {r.doc_id: r for r in OPERATORS["repetition"](docs).collect()}
    assert judged[1].n_words == 0 and judged[1].base_failed and not judged[1].kept and judged[6].kept
    scores = {r.doc_id: r for r in OPERATORS["contextmix"](docs).collect()}
    assert scores[1].n_tokens == 1 and scores[6].n_tokens == 60_001 and scores[1].score < 0
    prints = {r.doc_id: r.fingerprint for r in OPERATORS["fingerprints"](docs).collect()}
    assert prints[1] == prints[2] and prints[4] == prints[5] != prints[6]
    assert {r.score for r in OPERATORS["bigru"](docs).collect()} == {0.0}
    assert {r.score for r in OPERATORS["qda"](docs).collect()} == {0.5}
