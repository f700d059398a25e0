"""Quality classifier: regularised quadratic discriminant over document statistics.

Statistics of a text (shares of letters, signs and repeats, lengths) are transformed towards
normal ones. Each class gets a mean and a covariance, shrunk towards the pooled covariance
and its diagonal; the score is the logistic function of the difference of log densities,
with Mahalanobis distances from Cholesky factors that are computed once.

Moments are sums over all labelled rows, made by Spark; only they reach the driver.

Defined cases: a null text is empty and scored like any other; rows with a null label are no
training rows; repeated label rows count as often as they occur; without training rows of
both classes every score is 0.5; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislewise.llm.repetition import in_row, seen_before
from aislewise.llm.ship import map_batches
from aislewise.llm.textbatch import Texts, find_lines, find_words, slices

SHRINK_TO_POOLED = 0.1
SHRINK_TO_DIAGONAL = 0.05
PRIOR_ROWS = 1.0
SCALE = 0.5  # statistics of one text are not independent: log density ratios are tempered

_CODES = np.arange(256)
_UPPER = (_CODES >= 65) & (_CODES <= 90)
_LETTER = _UPPER | ((_CODES >= 97) & (_CODES <= 122)) | (_CODES >= 128)
_DIGIT = (_CODES >= 48) & (_CODES <= 57)
_SYMBOL = np.isin(_CODES, np.frombuffer(b"#*$%&|<>@^~_=+\\{}[]", np.uint8))
_STRONG = np.isin(_CODES, np.frombuffer(b"!?", np.uint8))
_STOP = np.isin(_CODES, np.frombuffer(b".,;:", np.uint8))
FEATURES = (
    "words", "mean_word", "mean_line", "upper", "digits", "symbols", "strong", "stops", "wide",
    "bare_words", "symbol_ends", "repeat_next", "distinct_words", "repeat_lines", "repeat_triples",
)


def statistics(texts: Texts) -> np.ndarray:
    """Transformed statistics, one row per text."""
    data = texts.data
    words, lines = find_words(texts), find_lines(texts)
    n = np.diff(words.rows)
    hashes = texts.span_hashes(words.starts, words.ends)
    row = words.row_of_each()
    size = np.maximum(np.diff(texts.offsets), 1)
    one = np.maximum(n, 1)

    def by_row(flags: np.ndarray, rows: np.ndarray = row) -> np.ndarray:
        return np.bincount(rows[flags], minlength=len(texts))

    letters = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_LETTER[data], out=letters[1:])
    bare = letters[words.ends] == letters[words.starts]
    last = data[words.ends - 1] if len(n) and len(words.ends) else np.zeros(0, np.uint8)
    next_same = np.zeros(len(hashes), bool)
    next_same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    again = seen_before(in_row(hashes, row))
    triples = hashes[:-2] * np.uint64(31) + hashes[1:-1] * np.uint64(17) + hashes[2:] if len(hashes) > 2 else hashes[:0]
    inside = row[:len(triples)] == row[2:] if len(triples) else np.zeros(0, bool)
    triple_rows = row[:len(triples)][inside]
    triple_again = seen_before(in_row(triples[inside], triple_rows))
    line_row = lines.row_of_each()
    filled = np.flatnonzero(lines.ends > lines.starts)
    line_again = seen_before(in_row(texts.span_hashes(lines.starts[filled], lines.ends[filled]), line_row[filled]))
    n_lines = np.maximum(np.bincount(line_row[filled], minlength=len(texts)), 1)

    def share(count: np.ndarray, total: np.ndarray, scale: float = 20.0) -> np.ndarray:
        return np.log1p(scale * count / total)

    return np.stack([
        np.log1p(n), np.log1p(size / one), np.log1p(size / n_lines) / 2,
        share(texts.count_in_rows(_UPPER[data]), size), share(texts.count_in_rows(_DIGIT[data]), size),
        share(texts.count_in_rows(_SYMBOL[data]), size), share(texts.count_in_rows(_STRONG[data]), size),
        share(texts.count_in_rows(_STOP[data]), size), share(texts.count_in_rows(data >= 128), size),
        share(by_row(bare), one), share(by_row(_SYMBOL[last] | _STRONG[last]), one), share(by_row(next_same), one),
        share(by_row(again), one, 3.0), share(by_row(line_again, line_row[filled]), n_lines),
        share(np.bincount(triple_rows[triple_again], minlength=len(texts)), one),
    ], axis=1)


@dataclass(frozen=True)
class Discriminant:
    means: np.ndarray  # per class
    factors: np.ndarray  # inverse Cholesky factors
    constants: np.ndarray  # log prior less half the log determinant

    def log_ratio(self, x: np.ndarray) -> np.ndarray:
        logs = [c - 0.5 * (((x - m) @ f.T) ** 2).sum(axis=1) for m, f, c in zip(self.means, self.factors, self.constants)]
        return logs[1] - logs[0]


def fit(counts: np.ndarray, sums: np.ndarray, squares: np.ndarray) -> Discriminant | None:
    """From per-class row counts, sums and sums of outer products; None without both classes."""
    if counts.min() < 1:
        return None
    means = sums / counts[:, None]
    scatter = squares - counts[:, None, None] * means[:, :, None] * means[:, None, :]
    pooled = scatter.sum(axis=0) / counts.sum() + 1e-3 * np.eye(sums.shape[1])
    factors, constants = [], []
    for k in (0, 1):
        # Few rows lean on the pooled covariance.
        weight = max(SHRINK_TO_POOLED, sums.shape[1] / (sums.shape[1] + counts[k]))
        own = (1 - weight) * scatter[k] / counts[k] + weight * pooled
        own = (1 - SHRINK_TO_DIAGONAL) * own + SHRINK_TO_DIAGONAL * np.diag(np.diag(own))
        lower = np.linalg.cholesky(own)
        factors.append(np.linalg.inv(lower))
        constants.append(np.log((counts[k] + PRIOR_ROWS) / (counts.sum() + 2 * PRIOR_ROWS)) - np.log(np.diag(lower)).sum())
    return Discriminant(means, np.array(factors), np.array(constants))


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x): the statistics of each text."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, texts in slices(batch.column(1)):
                x = statistics(texts)
                rows = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], x.ravel())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), rows], ["id", "x"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col), compute, f"id {kind}, x array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1) if len(column) else np.zeros((0, len(FEATURES)))


def train(stats: DataFrame, labels: DataFrame) -> Discriminant | None:
    """``labels`` are (id, label) of the training rows, label 0 or 1."""
    d = len(FEATURES)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            label, x = batch.column(0).to_numpy(), _matrix(batch.column(1))
            for k in (0, 1):
                own = x[label == k]
                total[k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat([0, 1], total.shape[1])), pa.array(np.tile(np.arange(total.shape[1]), 2)),
            pa.array(total.ravel())], ["label", "at", "value"])

    rows = stats.join(labels.where("label in (0, 1)"), "id").select(F.col("label").cast("bigint"), "x")
    sums = map_batches(rows, moments, "label bigint, at bigint, value double").groupBy("label", "at").agg(F.sum("value").alias("value"))
    total = np.zeros((2, 1 + d + d * d))
    for row in sums.toLocalIterator():  # a few hundred rows at any input size
        total[row["label"], row["at"]] = row["value"]
    return fit(total[:, 0], total[:, 1:1 + d], total[:, 1 + d:].reshape(2, d, d))


def score(stats: DataFrame, model: Discriminant | None) -> DataFrame:
    """(id, score)."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            ratio = SCALE * model.log_ratio(x) if model else np.zeros(len(x))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(ratio, -500, 500))))], ["id", "score"])

    kind = stats.schema["id"].dataType.simpleString()
    return map_batches(stats.select("id", "x"), compute, f"id {kind}, score double")


def with_score(docs: DataFrame, model: Discriminant | None, name: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the score of every row's text under ``name``; rows are judged one by one, whatever their ids."""
    at = docs.columns.index(text_col)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, texts in slices(batch.column(at)):
                x = statistics(texts)
                ratio = SCALE * model.log_ratio(x) if model else np.zeros(len(x))
                own = 1 / (1 + np.exp(-np.clip(ratio, -500, 500)))
                yield batch.slice(low, high - low).append_column(name, pa.array(own))

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_batches(docs, compute, f"{columns}, `{name}` double")
