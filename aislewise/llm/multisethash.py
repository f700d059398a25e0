"""Document fingerprints by a homomorphic multiset hash of paragraphs.

Paragraphs are the pieces between newlines. Each is hashed to a wide vector, and a document's
fingerprint is the sum of its paragraphs' vectors, so the order of paragraphs does not matter
and a paragraph is inserted or deleted by adding or subtracting its vector. Two parts:

* ``EXACT`` lanes modulo 2**64, uniform values of the whole paragraph, for equality;
* ``SIGNED`` lanes modulo 2**32: each pair of neighbouring words (or a lone word) of the paragraph adds
  1 or -1 to one lane. The squared distance of two such vectors estimates how many pairs two
  documents do not share, which gives the likeness.

Defined cases: a null text is empty (one empty paragraph); documents of one id are neighbours in
the order of their texts' hashes; a null id comes after all others; a single document is its
own next one; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislewise.llm.ship import map_batches
from aislewise.llm.textbatch import find_lines, find_words, mix, slices

EXACT = 4
SIGNED = 128
CHUNK_ROWS = 1024
CHUNK_BYTES = 8 << 20


def vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(exact, signed) sums of each text's paragraphs."""
    exact, signed = [np.zeros((0, EXACT), np.uint64)], [np.zeros((0, SIGNED), np.int32)]
    for _, _, texts in slices(column):
        lines, words = find_lines(texts), find_words(texts)
        hashes = texts.span_hashes(lines.starts, lines.ends)
        lanes = [np.add.reduceat(mix(hashes + np.uint64(0x9E3779B97F4A7C15 * (k + 1) % (1 << 64))), lines.rows[:-1])
                 for k in range(EXACT)]
        exact.append(np.stack(lanes, 1))
        word = texts.span_hashes(words.starts, words.ends)
        line = np.searchsorted(lines.starts, words.starts, "right") - 1
        row = lines.row_of_each()[line]
        pair = line[1:] == line[:-1]
        alone = np.ones(len(word), bool)
        alone[1:] &= ~pair
        alone[:-1] &= ~pair
        units = np.concatenate([mix(word[:-1] * np.uint64(3) + word[1:])[pair], mix(word[alone])])
        rows = np.concatenate([row[:-1][pair], row[alone]])
        at = rows * SIGNED + (units % np.uint64(SIGNED)).astype(np.int64)
        weights = ((units >> np.uint64(32)) & np.uint64(1)).astype(np.float64) * 2 - 1
        sums = np.bincount(at, weights, len(texts) * SIGNED).astype(np.int64)
        signed.append(sums.astype(np.uint32).view(np.int32).reshape(-1, SIGNED))
    return np.concatenate(exact), np.concatenate(signed)


def add(one: tuple, other: tuple, sign: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Inserts (or deletes, ``sign`` -1) the paragraphs of ``other``."""
    if sign == 1:
        return one[0] + other[0], one[1] + other[1]
    return one[0] - other[0], one[1] - other[1]


def encode(exact: np.ndarray, signed: np.ndarray) -> list[str]:
    rows = np.concatenate([exact.astype("<u8").view(np.uint8), signed.astype("<i4").view(np.uint8)], axis=1)
    return [base64.b64encode(r.tobytes()).decode() for r in rows]


def decode(fingerprints: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(map(base64.b64decode, fingerprints)), np.uint8).reshape(len(fingerprints), -1)
    return np.ascontiguousarray(raw[:, :8 * EXACT]).view("<u8"), np.ascontiguousarray(raw[:, 8 * EXACT:]).view("<i4")


def likeness(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """0 to 1 from the signed parts: 1 for equal ones, about the share of common word pairs."""
    gap = ((one - other).astype(np.float64) ** 2).sum(axis=1)
    norms = (one.astype(np.float64) ** 2).sum(axis=1) + (other.astype(np.float64) ** 2).sum(axis=1)
    return np.clip(np.where(norms > 0, 1 - gap / np.maximum(norms, 1), 1.0), 0.0, 1.0)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every document."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(encode(*vectors(batch.column(1))), pa.string())], [id_col, "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col), compute, f"`{id_col}` {kind}, fingerprint string")


def in_descending_ranges(docs: DataFrame, ranges: int) -> DataFrame:
    """(part, last, id, text) sorted by descending id within ranges of ids. The first row of the
    next range (after the last: of the first) stands at each range's end once more, ``last``."""
    spark = docs.sparkSession
    ids = docs.select("id")
    shares = [k / ranges for k in range(1, ranges)]
    bounds = sorted(set(ids.where("id is not null").approxQuantile(["id"], shares, 0.2 / ranges)[0])) if shares else []
    edges = np.array(bounds, np.int64)

    @F.pandas_udf("int")
    def part_of(values):
        # Descending: the largest ids are in part 0, null ids in the last part.
        number = values.astype("float64")
        found = len(edges) - np.searchsorted(edges, number.fillna(0).to_numpy(), "left")
        import pandas as pd

        return pd.Series(np.where(number.isna(), len(edges), found)).astype("int32")

    placed = docs.withColumn("part", part_of("id"))
    heads = ids.withColumn("part", part_of("id")).groupBy("part").agg(F.max("id").alias("id")).orderBy("part").collect()
    # One row for each range; a part's first row is read again for the part before it.
    again = [(before["part"], head["id"]) for before, head in zip(heads, heads[1:] + heads[:1])]
    helpers = F.broadcast(spark.createDataFrame(again, "part int, head bigint")) if again else None
    rows = placed.select("part", F.lit(False).alias("last"), "id", "text")
    if helpers is None:
        return rows
    twice = docs.join(helpers, F.col("id").eqNullSafe(F.col("head"))).select("part", F.lit(True).alias("last"), "id", "text")
    return rows.unionByName(twice).repartition("part").sortWithinPartitions(
        "part", "last", F.col("id").desc_nulls_last(), F.xxhash64("text"))


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text has its last half of code points replaced by as many (or all) from the
    beginning of the next document in descending id order.
    """
    ranges = ranges or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 2
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = in_descending_ranges(rows, ranges)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list, list]]:
        part, last, ids, texts, size = [], [], [], [], 0
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(3)]
            for k in range(batch.num_rows):
                text = batch.column(3)[k].as_py()
                part.append(columns[0][k])
                last.append(columns[1][k])
                ids.append(columns[2][k])
                texts.append(text)
                size += len(text)
                if len(texts) > CHUNK_ROWS or size > CHUNK_BYTES:
                    yield part, last, ids, texts
                    # The last row waits for its next one.
                    part, last, ids, texts, size = part[-1:], last[-1:], ids[-1:], texts[-1:], len(texts[-1])
        if texts:
            yield part, last, ids, texts

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, last, ids, texts in chunks(batches):
            own = vectors(pa.array(texts, pa.large_string()))
            keep = [k for k in range(len(texts) - 1) if not last[k]]
            edited, sums = [], []
            for k in keep:
                half = len(texts[k]) // 2
                text = texts[k][:len(texts[k]) - half] + texts[k + 1][:half]
                edited.append(text)
                sums.append(hashlib.sha256(text.encode()).hexdigest())
            changed = vectors(pa.array(edited, pa.large_string()))
            after = [k + 1 for k in keep]
            yield pa.RecordBatch.from_arrays([
                pa.array([ids[k] for k in keep], pa.int64()), pa.array([len(texts[k]) for k in keep], pa.int64()),
                pa.array(sums, pa.string()), pa.array(encode(own[0][keep], own[1][keep]), pa.string()),
                pa.array(encode(*changed), pa.string()), pa.array(likeness(own[1][keep], changed[1])),
                pa.array(likeness(own[1][keep], own[1][after])),
            ], names)

    names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return map_batches(ordered, compare, (
        f"`{id_col}` bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"))
