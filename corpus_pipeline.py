"""Corpus pipeline over ``documents``: classify, filter, deduplicate, mix and pack.

Each stage takes all that its predecessor kept. Rows are judged and deduplicated one by one, also those
without an id or of an id that others have; nulls in any column are kept as they are. Rows of one id share the first
place of that id in the mix. Other columns than those of ``documents``, of whatever names, are handed on too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aislewise.llm import bestfit, bigru, minhash_join, pfair, qda, queries
from aislewise.llm.scratch import Scratch
from aislewise.llm.subwords import default_tokenizer


def _with_good_score(scored: DataFrame, name: str, columns: list[str], above: bool) -> DataFrame:
    good = F.col(name) >= queries.PREDICT_FROM if above else F.col(name) < queries.PREDICT_FROM
    return scored.where(good).select(*[F.col(f"`{c}`") for c in columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality discriminant predicts good, each judged by its own text."""
    name = pfair.unused(docs.columns, "quality_score")
    scored = qda.with_score(docs, queries.quality_model(spark, docs, sf_dir), name)
    return _with_good_score(scored, name, docs.columns, above=True)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity network does not predict toxic, each judged by its own text."""
    name = pfair.unused(docs.columns, "toxicity_score")
    scored = bigru.with_score(docs, queries.toxicity_model(spark, docs, sf_dir), name)
    return _with_good_score(scored, name, docs.columns, above=False)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group (five-word shingles, similarity 0.8): that of the smallest id, null
    ids last. Rows are told apart by a key of their own, written once, so unlike texts under one id all stay."""
    scratch = Scratch(spark, "near-dedup")
    key = pfair.unused(docs.columns, "row_key")
    keyed = scratch.save(docs.withColumn(key, F.monotonically_increasing_id()))
    found = minhash_join.near_duplicates(keyed, id_col=key, percent=80).select(F.col(key).alias("k"), "component_id")
    ids = keyed.select(F.col(key).alias("row"), F.col("doc_id").alias("id"))
    first = found.join(ids, F.col("k") == F.col("row")).groupBy("component_id").agg(
        F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row")).alias("first")).select(F.col("first.row").alias("kept_row"))
    return keyed.join(first, keyed[key] == F.col("kept_row"), "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order of the mix. Files may be read in any order, so packing
    takes the places from the mix itself, which is the same for the same documents."""
    return pfair.in_mixed_order(docs, pfair.mix_sources(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of sequences of 1024 ids, which
    follow the mix in the order of sequence_id."""
    pieces = bestfit.token_pieces(docs, default_tokenizer("byte_bpe_50k.json"), end_id=2)
    placed = pfair.with_position(pieces, pfair.mix_sources(docs))  # the mix is the same for the same documents
    return bestfit.pack_in_order(placed).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_classifier", quality),
    ("toxicity", toxicity),
    ("minhash_near_dedup", near_dedup),
    ("mixing_sources", mix),
    ("best_fit_packing", pack),
]
#: SQL cannot express these stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each is written and read again by the next one."""
    scratch, written = Scratch(spark, "pipeline"), None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir))
        if written is not None:
            scratch.drop(written)
        written = docs
    return STAGES[-1][1](spark, docs, sf_dir)
