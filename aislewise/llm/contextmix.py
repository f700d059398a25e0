"""Language-model scoring by online logistic context mixing.

A text is its words (A-Z lower-cased) and an end token, which is the empty word. Texts fall
into ``CLASSES`` groups by their letters (k-means over all training texts); a text pays for
naming its group. A token is a path of bits in a code of the frequent words (``wordcode``): predictors hash each bit's
place and nothing, the group, the word before and the two words before to counts of zeros and ones; gated weights combine
their stretched predictions; an adaptive map refines the result. Weights and map are learned online over all training
texts, each bit predicted without its own count. Other words follow the code's last leaf by their share of
its tokens, mixed with their spelling, which the same kind of predictors gives byte by byte and
bit by bit to a terminator, from the last 0 to 4 bytes of the word. Within a text, the words so far
sharpen the prediction: (KAPPA * P(w) + times seen) / (KAPPA + place), with KAPPA chosen while learning.

Spark's part: every chunk of documents keeps its tokens in order, as numbers of its distinct words, and sends these words with their
training counts to hash buckets, once for each chunk however often they occur. A bucket
merges them into one written row of the lexicon, which grows with the corpus; passes over the lexicon
count and learn spelling; a word's count and spelling go back to the chunks that hold it. Passes over the chunks
count, learn and score. No text is moved, and the end token or a word of many copies has one row a chunk. Predictor
tables, weights and maps have a fixed size (``TABLE_SLOTS``, ``wordcode.table_starts``), so they are summed and broadcast; so has the code
(``wordcode.CODE_WORDS`` words). Batches between Spark and Python are cut at ``BATCH_BYTES``.

Defined cases: a null text is empty (one end token); a null id counts as the empty text for
the split; repeated rows are documents of their own; without training rows known counts are
0 and spelling is uniform; an empty table gives no rows.
"""

from __future__ import annotations

import contextlib
import ctypes
import struct
import sys
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aislewise.llm import ship, wordcode
from aislewise.llm.scratch import Scratch
from aislewise.llm.subwords import ragged
from aislewise.llm.textbatch import find_words, mix, slices

HELD_OUT_OF = 10
CHUNK_BYTES = 4 << 20
CHUNK_DOCS = 60_000
BUCKET_BYTES = 4 << 20
SIZES = (12, 16, 18, 20, 20)  # bits of the tables of orders 0 to 4
TABLE_SLOTS = sum(1 << s for s in SIZES)
STARTS = np.cumsum([0] + [1 << s for s in SIZES])
GATES = 32
LEARN = 0.15
FORGET = 0.95
MAP_STEPS = 33
MAP_PRIOR = 8.0
SPELL_BYTES = 1 << 14  # bytes of words predicted between two updates of the weights
KAPPAS = (30.0, 100.0, 300.0, 1000.0, 3000.0, 10_000.0)
END_KEY = np.uint64(0)
TERMINATOR = 0x20
CLASSES = 8
CLASS_ROUNDS = 5
CLASS_SEEDS = 512
TABLE_PARTS = 16
BATCH_BYTES = 16 << 20
TASKS_PER_CORE = 3
TASK_BUCKETS = 8


def map_batches(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``ship.map_batches`` whose workers hand freed memory back to the system at the end of a task: they are
    used again by later stages, beside which it would stay held."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        if sys.platform == "linux" and hasattr(library := ctypes.CDLL(None), "malloc_trim"):
            library.malloc_trim(0)

    return ship.map_batches(df, whole, schema)


def in_tasks(df: DataFrame, buckets: int) -> DataFrame:
    """``df`` in tasks of several rows, as each of them makes tables of fixed size."""
    return df.coalesce(max(TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism, -(-buckets // TASK_BUCKETS)))


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays with their types and lengths, one after the other."""
    out = []
    for a in arrays:
        raw = np.ascontiguousarray(a).tobytes()
        out.append(struct.pack("<4sq", a.dtype.str.encode(), len(raw)) + raw)
    return b"".join(out)


def narrow(a: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 on in their smallest type."""
    return a.astype(np.min_scalar_type(int(a.max()))) if len(a) else a


def unpacked(data: bytes) -> list[np.ndarray]:
    arrays, at = [], 0
    while at < len(data):
        kind, size = struct.unpack_from("<4sq", data, at)
        kind = np.dtype(kind.rstrip(b"\0").decode())
        arrays.append(np.frombuffer(data, kind, size // kind.itemsize, at + 12))
        at += 12 + size
    return arrays


def grouped(values: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts whole numbers from 0 on, equal ones by place, and where each distinct one begins in it."""
    n = len(values)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bits = n.bit_length()
    if below << bits < 1 << 63:  # value and place in one number: much faster to sort
        both = np.sort((values.astype(np.int64) << bits) | np.arange(n))
        order, ordered = both & ((1 << bits) - 1), both >> bits
    else:
        order = np.argsort(values, kind="stable")
        ordered = values[order]
    return order, np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))


def distinct_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct keys, first place of each, index of every key among them)."""
    place = np.uint64((1 << len(keys).bit_length()) - 1)
    both = np.sort((keys & ~place) | np.arange(len(keys), dtype=np.uint64))  # all but the last bits, and the place
    order = (both & place).astype(np.int64)
    ordered = keys[order]
    if (ordered[1:] < ordered[:-1]).any():  # the last bits matter
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
    new = np.ones(len(keys), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    index = np.empty(len(keys), np.int64)
    index[order] = np.cumsum(new) - 1
    return ordered[new], order[new], index


def is_held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % HELD_OUT_OF == 0


# --- groups of texts ----------------------------------------------------------------------

LETTER_BINS = np.zeros(256, np.int64)
LETTER_BINS[97:123] = np.arange(1, 27)
LETTER_BINS[48:58] = 27
LETTER_BINS[128:192] = 28 + np.arange(64)
LETTER_BINS[192:] = 92 + (np.arange(64) & 3)
BINS = 96


def letter_profiles(texts) -> np.ndarray:
    """Square roots of the shares of lower-cased letters, one row per text."""
    first = np.repeat(np.arange(len(texts)) * BINS, np.diff(texts.offsets))
    first += LETTER_BINS[texts.data]
    counts = np.bincount(first, minlength=len(texts) * BINS).reshape(-1, BINS)
    counts[:, 0] = 0
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))


def nearest(profiles: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.argmax(profiles @ centers.T - (centers * centers).sum(axis=1) / 2, axis=1)


def letter_groups(rows: DataFrame, scratch: Scratch) -> np.ndarray:
    """Centers of ``CLASSES`` groups of the training texts of ``rows`` (id, text)."""

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = np.array([is_held_out(i) for i in batch.column(0).to_pylist()], bool)
            for low, high, texts in slices(batch.column(1)):
                own = letter_profiles(texts.lowered())[~held[low:high]].astype(np.float32)
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in own], pa.binary())], ["profile"])

    saved = scratch.save(map_batches(rows, profile, "profile binary"))

    def matrix(column) -> np.ndarray:
        return np.array([np.frombuffer(v, np.float32) for v in column.to_pylist()], np.float32).reshape(-1, BINS)

    seeds = [np.frombuffer(r[0], np.float32) for r in saved.orderBy(F.xxhash64("profile")).limit(CLASS_SEEDS).collect()]
    seeds = np.array(seeds, np.float32).reshape(-1, BINS)
    centers = seeds[:1] if len(seeds) else np.zeros((1, BINS), np.float32)
    while len(centers) < min(CLASSES, len(seeds)):  # the seed furthest from all centers
        gap = ((seeds[:, None] - centers) ** 2).sum(axis=2).min(axis=1)
        centers = np.append(centers, seeds[np.argmax(gap)][None], axis=0)
    for _ in range(CLASS_ROUNDS):
        def assign(batches: Iterator[pa.RecordBatch], centers: np.ndarray = centers) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((len(centers), BINS + 1))
            for batch in batches:
                x = matrix(batch.column(0))
                own = nearest(x, centers)
                for k in range(len(centers)):
                    sums[k] += np.append(x[own == k].sum(axis=0), (own == k).sum())
            yield pa.RecordBatch.from_pylist([{"data": sums.tobytes()}])

        total = np.zeros((len(centers), BINS + 1))
        for row in map_batches(saved, assign, "data binary").toLocalIterator():
            total += np.frombuffer(row["data"]).reshape(total.shape)
        full = total[:, -1] > 0
        centers = np.where(full[:, None], total[:, :-1] / np.maximum(total[:, -1:], 1), centers)
    scratch.drop(saved)
    return centers


# --- chunks -------------------------------------------------------------------------------

def token_keys(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(tokens in order, as places among the distinct keys, the end token's key last; tokens of each text; distinct keys, lengths
    and bytes of their words)."""
    words = find_words(texts)
    hashes = np.maximum(texts.span_hashes(words.starts, words.ends), np.uint64(1))
    counts = np.diff(words.rows) + 1
    known, first, index = distinct_keys(hashes)
    tokens = np.full(len(hashes) + len(texts), len(known))
    inside = np.ones(len(tokens), bool)
    inside[np.cumsum(counts) - 1] = False
    tokens[inside] = index
    length = np.append(words.ends[first] - words.starts[first], 0)
    return tokens, counts, np.append(known, END_KEY), length, texts.data[ragged(words.starts[first], length[:-1])]


class Chunk:
    """Documents of one task and their tokens."""

    def __init__(self, centers: np.ndarray):
        self.centers = centers
        self.ids, self.groups, self.sizes, self.parts, self.bytes = [], [], [], [], 0

    def add(self, ids: list, texts) -> None:
        texts = texts.lowered()
        self.parts.append(token_keys(texts))
        self.ids.extend(ids)
        self.groups.append(nearest(letter_profiles(texts), self.centers))
        self.sizes.append(np.diff(texts.offsets) + 1)
        self.bytes += len(texts.data)

    def rows(self, number: int, buckets: int) -> Iterator[dict]:
        held, group = np.array([is_held_out(i) for i in self.ids]), np.concatenate(self.groups)
        counts = np.concatenate([p[1] for p in self.parts])
        words, where, merged = distinct_keys(np.concatenate([p[2] for p in self.parts]))
        of_part = np.split(merged, np.cumsum([len(p[2]) for p in self.parts])[:-1])
        index = np.concatenate([own[p[0]] for own, p in zip(of_part, self.parts)])
        train = np.bincount(index[np.repeat(~held, counts)], minlength=len(words))
        length = np.concatenate([p[3] for p in self.parts])
        blob = np.concatenate([p[4] for p in self.parts])
        begin = np.cumsum(length) - length
        length, begin = length[where], begin[where]  # in the order of ``words``
        bucket_of = (words >> np.uint64(32)) % np.uint64(buckets)
        by_bucket = np.argsort(bucket_of, kind="stable")
        bounds = np.searchsorted(bucket_of[by_bucket], np.arange(buckets + 1).astype(np.uint64))
        for bucket in np.flatnonzero(np.diff(bounds)).tolist():
            own = by_bucket[bounds[bucket]:bounds[bucket + 1]]
            yield {"bucket": bucket, "chunk": number, "data": packed(
                words[own], narrow(length[own]), blob[ragged(begin[own], length[own])], narrow(train[own]))}
        place = np.empty(len(words), np.uint32)
        place[by_bucket] = np.arange(len(words))
        yield {"bucket": buckets, "chunk": number, "data": packed(
            np.array([0 if i is None else i for i in self.ids], np.int64), np.array([i is not None for i in self.ids]),
            held, narrow(counts), narrow(np.concatenate(self.sizes)), narrow(group),
            np.frombuffer(zlib.compress(place[index].tobytes(), 1), np.uint8))}


def chunk_words(docs: DataFrame, buckets: int, centers: np.ndarray) -> DataFrame:
    """(bucket, chunk, data): words of a chunk in a bucket, with counts; a chunk's documents and uses are in bucket ``buckets``."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("data", pa.binary())])
        number, chunk = TaskContext.get().partitionId() << 20, Chunk(centers)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for low, high, texts in slices(batch.column(1)):
                for a in range(low, high, CHUNK_DOCS):  # a slice of many empty texts
                    b = min(high, a + CHUNK_DOCS)
                    part = texts if (a, b) == (low, high) else next(slices(batch.column(1).slice(a, b - a)))[2]
                    if chunk.ids and (chunk.bytes + len(part.data) > CHUNK_BYTES or len(chunk.ids) + b - a > CHUNK_DOCS):
                        yield pa.RecordBatch.from_pylist(list(chunk.rows(number, buckets)), schema)
                        number, chunk = number + 1, Chunk(centers)
                    chunk.add(ids[a:b], part)
        if chunk.ids:
            yield pa.RecordBatch.from_pylist(list(chunk.rows(number, buckets)), schema)

    return map_batches(docs, emit, "bucket int, chunk bigint, data binary")


LEXICON = "bucket int, tokens bigint, types bigint, once bigint, data binary"


def merge_buckets(rows: DataFrame, buckets: int) -> DataFrame:
    """One row of the lexicon for each bucket."""

    def merge(parts: list[tuple[int, list[np.ndarray]]]) -> dict:
        keys = np.concatenate([p[0] for _, p in parts])
        words, first, inverse = distinct_keys(keys)
        length = np.concatenate([p[1] for _, p in parts]).astype(np.int64)
        begin = np.cumsum(length) - length
        blob = np.concatenate([p[2] for _, p in parts])[ragged(begin[first], length[first])]
        train = np.bincount(inverse, np.concatenate([p[3] for _, p in parts]), len(words)).astype(np.int64)
        return {
            "tokens": int(train.sum()), "types": int((train > 0).sum()), "once": int((train == 1).sum()),
            "data": packed(length[first].astype(np.uint32), blob, train, np.array([c for c, _ in parts], np.int64),
                           np.array([len(p[0]) for _, p in parts], np.int64), inverse.astype(np.uint32), words)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, pa.int32() if n == "bucket" else pa.int64()) for n in
                            ("bucket", "tokens", "types", "once")] + [("data", pa.binary())])
        now, parts = None, []
        for batch in batches:
            for row in range(batch.num_rows):
                bucket, chunk, data = (batch.column(k)[row].as_py() for k in range(3))
                if parts and bucket != now:
                    yield pa.RecordBatch.from_pylist([{"bucket": now, **merge(parts)}], schema)
                    parts = []
                now = bucket
                parts.append((chunk, unpacked(data)))
        if parts:
            yield pa.RecordBatch.from_pylist([{"bucket": now, **merge(parts)}], schema)

    dealt = rows.repartition(buckets, "bucket").sortWithinPartitions("bucket", "chunk")
    return map_batches(dealt, run, LEXICON)


# --- bit predictors -----------------------------------------------------------------------

class Spelling:
    """Bytes of words with terminators, and the hashes of their contexts."""

    def __init__(self, length: np.ndarray, blob: np.ndarray):
        self.ends = np.cumsum(length + 1)
        self.starts = self.ends - length - 1
        self.data = np.full(self.ends[-1] if len(length) else 0, TERMINATOR, np.uint8)
        inside = np.ones(len(self.data), bool)
        inside[self.ends - 1] = False
        self.data[inside] = blob
        place = np.arange(len(self.data)) - np.repeat(self.starts, length + 1)
        last = []
        for k in range(1, 5):
            shifted = np.zeros(len(self.data), np.uint64)
            shifted[k:] = self.data[:-k]
            last.append(np.where(place >= k, shifted, 0))
        self.contexts = [np.minimum(place, 15).astype(np.uint64), last[0]]
        value = last[0]
        for k in (1, 2, 3):
            value = value * np.uint64(257) + last[k]
            self.contexts.append(mix(value + np.uint64(k)))

    def bit(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(node of the bits before, bit) of every byte."""
        node = (1 << k) | (self.data.astype(np.int64) >> (8 - k))
        return node, (self.data >> (7 - k)) & 1

    def slots(self, order: int, node: np.ndarray) -> np.ndarray:
        context = self.contexts[order]
        if order < 2:
            return STARTS[order] + (context.astype(np.int64) << 8) + node
        value = (context + node.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        return STARTS[order] + (value >> np.uint64(64 - SIZES[order])).astype(np.int64)


def spelled(length: np.ndarray, blob: np.ndarray) -> Iterator[tuple[int, int, Spelling]]:
    """Runs of words of bounded bytes."""
    length = length.astype(np.int64)
    ends = np.cumsum(length)
    low = 0
    while low < len(length):
        done = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends + np.arange(1, len(ends) + 1), done + low + SPELL_BYTES, "right")))
        yield low, high, Spelling(length[low:high], blob[done:ends[high - 1]])
        low = high


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -20, 20)))


def predictions(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Stretched predictions of counts; 0 where nothing was seen."""
    odds = np.maximum(ones, 0) + np.float32(0.02)
    odds /= np.maximum(zeros, 0) + np.float32(0.02)
    return np.log(odds, out=odds)


MAP_START = squash(np.arange(MAP_STEPS) / 2 - 8.0)


class Model:
    """Predictor counts, gated weights and the refining map, all of fixed size."""

    def __init__(self, counts: np.ndarray, weights: np.ndarray | None = None, cells: np.ndarray | None = None):
        counts = counts.astype(np.float32, copy=False)  # only their ratios matter
        self.zeros, self.ones = counts[:TABLE_SLOTS], counts[TABLE_SLOTS:]
        self.weights = np.full((GATES, len(SIZES)), 0.3) if weights is None else weights
        self.cells = np.zeros((2, 256 * MAP_STEPS)) if cells is None else cells
        self.plain = predictions(self.zeros, self.ones)
        self.curvature = np.full((GATES, len(SIZES)), 100.0)

    def without_own(self) -> np.ndarray:
        """Predictions where the coming bit's own count is taken out: for all slots if it is 0, then if it is 1."""
        return np.concatenate([predictions(self.zeros - 1, self.ones), predictions(self.zeros, self.ones - 1)])

    def refined(self, node: np.ndarray, mixed: np.ndarray, chance: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        cell = np.clip(np.rint((mixed + 8) * 2), 0, MAP_STEPS - 1).astype(np.int64)
        cell += node * MAP_STEPS
        first = int(node.min()) * MAP_STEPS
        seen, one = self.cells[:, first:(int(node.max()) + 1) * MAP_STEPS].reshape(2, -1, MAP_STEPS)
        table = ((one + MAP_PRIOR * MAP_START) / (seen + MAP_PRIOR)).ravel()
        return cell, ((squash(mixed) if chance is None else chance) + table.take(cell - first)) / 2

    def log_spelling(self, length: np.ndarray, blob: np.ndarray, own: np.ndarray | None = None,
                     learn: bool = False) -> np.ndarray:
        """Natural log probability of each word's spelling. ``own``: predictions without the word's
        own counts. ``learn``: weights and map are updated after each run of words."""
        out = np.zeros(len(length))
        for low, high, words in spelled(length, blob):
            logs = np.zeros(len(words.data))
            for k in range(8):
                node, bit = words.bit(k)
                table, shift = (self.plain, 0) if own is None else (own, bit.astype(np.int64) * TABLE_SLOTS)
                x = [table.take(words.slots(order, node) + shift, mode="clip") for order in range(len(SIZES))]
                seen = (x[2] != 0).astype(np.int64)
                for context in x[3:]:
                    seen += context != 0
                mine = slice(4 * k, 4 * k + 4)  # gates of this bit
                weights = np.ascontiguousarray(self.weights[mine].T)
                mixed = weights[0].take(seen) * x[0]
                for order in range(1, len(SIZES)):
                    mixed += weights[order].take(seen) * x[order]
                chance = squash(mixed)
                cell, p = self.refined(node, mixed, chance)
                p = np.clip(p, 1e-6, 1 - 1e-6)
                logs += np.log(np.abs(1 - bit - p))
                if learn:
                    error, spread = bit - chance, chance * (1 - chance)
                    terms = np.array([*(error * v for v in x), *(spread * v * v for v in x)])
                    found = (seen == np.arange(4)[:, None]).astype(np.float64) @ terms.T
                    self.curvature[mine] *= FORGET
                    self.curvature[mine] += found[:, len(SIZES):]
                    self.weights[mine] += LEARN * found[:, :len(SIZES)] / self.curvature[mine]
                    self.cells[0] += np.bincount(cell, minlength=256 * MAP_STEPS)
                    self.cells[1] += np.bincount(cell, bit, 256 * MAP_STEPS)
            out[low:high] = np.add.reduceat(logs, words.starts)
        return out


def _lexicon_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    for batch in batches:
        for row in range(batch.num_rows):
            yield unpacked(batch.column(0)[row].as_py())


def count_contexts(lexicon: DataFrame, scratch: Scratch) -> np.ndarray:
    """Zeros and ones of all predictors of spelling over the distinct training words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(2 * TABLE_SLOTS, np.uint32)  # of the distinct words of one task
        for row in _lexicon_rows(batches):
            length, blob, train = row[0].astype(np.int64), row[1], row[2]
            begin, own = np.cumsum(length) - length, np.flatnonzero(train > 0)
            for _, _, words in spelled(length[own], blob[ragged(begin[own], length[own])]):
                for order in range(len(SIZES)):
                    size = 1 << SIZES[order]
                    both = []
                    for k in range(8):
                        node, bit = words.bit(k)
                        both.append(words.slots(order, node) - STARTS[order] + size * bit.astype(np.int64))
                    got = np.concatenate(both)
                    if len(got) > size:
                        found = np.bincount(got, minlength=2 * size).astype(np.uint32)
                        counts[STARTS[order]:STARTS[order] + size] += found[:size]
                        counts[TABLE_SLOTS + STARTS[order]:TABLE_SLOTS + STARTS[order] + size] += found[size:]
                    else:
                        np.add.at(counts, np.where(got < size, got, got - size + TABLE_SLOTS) + STARTS[order], np.uint32(1))
        yield from _table_parts(counts)

    return summed(map_batches(lexicon.select("data"), count, "part bigint, data binary"), 2 * TABLE_SLOTS, scratch)


def summed(parts: DataFrame, size: int, scratch: Scratch) -> np.ndarray:
    """Sum of the tables of ``size`` slots that tasks emitted by ``_table_parts``. It is written before it is read part by
    part: each part would be a job of its own, and the tasks behind its shuffle run again."""
    step = -(-size // TABLE_PARTS)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                gaps, values = unpacked(data.as_py())
                if part not in sums:
                    sums[part] = np.zeros(step, np.int64)
                sums[part][np.cumsum(gaps, dtype=np.int64)] += values
        for part, values in sums.items():
            yield pa.RecordBatch.from_pylist([{"part": part, "data": zlib.compress(values.tobytes(), 1)}])

    out = np.zeros(step * TABLE_PARTS, np.float32)  # only ratios of counts matter
    sums = scratch.save(map_batches(parts.repartition(TABLE_PARTS, "part"), total, "part bigint, data binary"))
    for row in sums.toLocalIterator():
        out[row["part"] * step:(row["part"] + 1) * step] = np.frombuffer(zlib.decompress(row["data"]), np.int64)
    scratch.drop(sums)
    return out[:size]


def _table_parts(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    step = -(-len(counts) // TABLE_PARTS)
    for part in range(TABLE_PARTS):
        own = counts[part * step:(part + 1) * step]
        place = np.flatnonzero(own)
        if len(place):
            yield pa.RecordBatch.from_pylist([{"part": part, "data": packed(narrow(np.diff(place, prepend=0)), narrow(own[place]))}])


# --- words --------------------------------------------------------------------------------

def rising(n: np.ndarray, kappa: float | None) -> np.ndarray:
    """Sum of log(kappa + place) over the places of a text of ``n`` tokens."""
    if kappa is None or len(n) == 0:
        return np.zeros(len(n))
    sums = np.append(0.0, np.cumsum(np.log(kappa + np.arange(n.max()))))
    return sums[n]


def learn_spelling(lexicon: DataFrame, counts, scratch: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """Mean weights and summed map over all training words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, size = Model(np.frombuffer(zlib.decompress(counts.value), np.float32)), 0
        own = model.without_own()
        for row in _lexicon_rows(batches):
            length, blob, chosen = row[0].astype(np.int64), row[1], np.flatnonzero(row[2])
            begin = np.cumsum(length) - length
            model.log_spelling(length[chosen], blob[ragged(begin[chosen], length[chosen])], own, learn=True)
            size += int(length[chosen].sum()) + len(chosen)
        yield pa.RecordBatch.from_pylist([{"n": size, "data": packed(model.weights.ravel(), model.cells.ravel())}])

    weights, cells, n = np.zeros(GATES * len(SIZES)), np.zeros(2 * 256 * MAP_STEPS), 0
    learned = scratch.save(map_batches(lexicon.select("data"), run, "n bigint, data binary"))  # all tasks at once
    for row in learned.toLocalIterator():
        w, c = unpacked(row["data"])
        weights, cells, n = weights + row["n"] * w, cells + c, n + row["n"]
    weights = weights / n if n else weights + 0.3
    return weights.reshape(GATES, -1), cells.reshape(2, -1)


def frequent_words(lexicon: DataFrame, tokens: int) -> tuple[wordcode.WordCode, int]:
    """Code of the most frequent training words used twice or more, and how many training tokens are others."""

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _lexicon_rows(batches):
            train, keys = row[2], row[6]
            own = np.flatnonzero(train > 1)
            own = own[np.lexsort((keys[own], -train[own]))[:wordcode.CODE_WORDS]]
            yield pa.RecordBatch.from_arrays([pa.array(keys[own].view(np.int64)), pa.array(train[own])], ["key", "n"])

    best = map_batches(lexicon.select("data"), frequent, "key bigint, n bigint").orderBy(F.desc("n"), "key").limit(wordcode.CODE_WORDS)
    rows = best.collect()  # CODE_WORDS rows at most
    keys = np.array([r["key"] for r in rows], np.int64).view(np.uint64)
    counts = np.array([r["n"] for r in rows], np.int64)
    return wordcode.build_code(keys, counts, tokens - int(counts.sum())), tokens - int(counts.sum())


def word_totals(lexicon: DataFrame, counts, weights: np.ndarray, cells: np.ndarray, code) -> DataFrame:
    """(chunk, part, data): key, training count and leaf of each word that a chunk has in a bucket, and the log spelling of
    those outside the code."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(np.frombuffer(zlib.decompress(counts.value), np.float32), weights, cells)
        for batch in batches:
            for row in range(batch.num_rows):
                bucket = batch.column(0)[row].as_py()
                length, blob, train, chunks, sizes, inverse, keys = unpacked(batch.column(1)[row].as_py())
                length = length.astype(np.int64)
                leaf, logs = code.value.leaf(keys), np.zeros(len(length), np.float32)
                begin, own = np.cumsum(length) - length, np.flatnonzero(leaf == code.value.other)
                logs[own] = model.log_spelling(length[own], blob[ragged(begin[own], length[own])])
                at, found = 0, []
                for chunk, size in zip(chunks.tolist(), sizes.tolist()):
                    word = inverse[at:at + size]
                    at += size
                    found.append({"chunk": chunk, "part": bucket, "data": packed(
                        keys[word], narrow(train[word]), narrow(leaf[word]), logs[word])})
                yield pa.RecordBatch.from_pylist(found)

    return map_batches(lexicon.select("bucket", "data"), run, "chunk bigint, part bigint, data binary")


def join_back(totals: DataFrame, documents: DataFrame, parts: int) -> DataFrame:
    """(data): one row for each chunk, its documents and tokens with the totals of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        words: list[list[np.ndarray]] = []

        def done() -> Iterator[pa.RecordBatch]:
            if held:
                yield pa.RecordBatch.from_pylist([{"data": packed(*held, *(np.concatenate(x) for x in zip(*words)))}])

        for batch in batches:
            for row in range(batch.num_rows):
                data = unpacked(batch.column(2)[row].as_py())
                if batch.column(1)[row].as_py() < 0:
                    yield from done()
                    held, words = data, []
                else:
                    words.append(data)
        yield from done()

    rows = documents.select("chunk", F.lit(-1).cast("bigint").alias("part"), "data").unionByName(totals)
    dealt = rows.repartition(parts, "chunk").sortWithinPartitions("chunk", "part")
    return map_batches(dealt, run, "data binary")


# --- texts --------------------------------------------------------------------------------

class Texts:
    """Documents of a chunk, their tokens in order and the totals of its words."""

    def __init__(self, row: list[np.ndarray]):
        self.ids, self.valid, self.held = row[0].astype(np.int64), row[1], row[2]
        self.n_tokens, self.n_bytes, self.group = (a.astype(np.int64) for a in row[3:6])
        self.word = np.frombuffer(zlib.decompress(row[6]), np.uint32)
        self.key, self.train, self.leaf, self.logs = row[7], row[8].astype(np.int64), row[9].astype(np.int64), row[10]
        self.doc = np.repeat(np.arange(len(self.ids)), self.n_tokens)

    def tokens(self) -> wordcode.Tokens:
        return wordcode.in_order(self.key[self.word], self.leaf[self.word], self.group[self.doc], self.n_tokens)

    def training(self) -> np.ndarray:
        return ~self.held[self.doc]

    def seen(self) -> np.ndarray:
        """How often each token stood in its text before."""
        pair = self.doc * len(self.key) + self.word
        order, first = grouped(pair, len(self.ids) * len(self.key))
        out = np.empty(len(order), np.int64)
        out[order] = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
        return out


class Others:
    """Chances of words outside the code, given that it is one of them: their share of the training tokens, and spelling
    as often as such a token was the only one of its word."""

    def __init__(self, tokens: int, once: int):
        self.tokens, self.spelled = max(tokens, 1), (once + 1) / (tokens + 2)

    def log_chance(self, count: np.ndarray, log_spelling: np.ndarray) -> np.ndarray:
        spelling = np.exp(np.maximum(log_spelling.astype(np.float64), -650.0))
        return np.log((1 - self.spelled) * np.maximum(count, 0) / self.tokens + self.spelled * spelling)


def count_texts(chunks: DataFrame, code, scratch: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones of all predictors over the training texts, and how many training texts each group has."""
    slots = int(wordcode.table_starts(CLASSES)[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(2 * slots + CLASSES, np.uint32)  # of the tokens of one task
        for row in _lexicon_rows(batches):
            texts = Texts(row)
            wordcode.count_decisions(code.value, texts.tokens().where(texts.training()), counts[:2 * slots], CLASSES)
            counts[2 * slots:] += np.bincount(texts.group[~texts.held], minlength=CLASSES).astype(np.uint32)
        yield from _table_parts(counts)

    out = summed(map_batches(chunks, run, "part bigint, data binary"), 2 * slots + CLASSES, scratch)
    return out[:2 * slots], out[2 * slots:].astype(np.float64)


def sharpened(logs: np.ndarray, seen: np.ndarray, kappa: float | None) -> np.ndarray:
    """log(kappa * p + times before) of tokens."""
    return logs if kappa is None else np.log(kappa * np.exp(logs) + seen)


def learn_texts(chunks: DataFrame, code, counts, others: Others, scratch: Scratch) -> tuple[np.ndarray, np.ndarray, float | None]:
    """Mean weights and summed map over all training texts, and the kappa under which these are likeliest; each
    token is predicted without its own counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = wordcode.TextModel(code.value, np.frombuffer(zlib.decompress(counts.value), np.float32), CLASSES, learning=True)
        gains, size = np.zeros(len(KAPPAS) + 1), 0
        for row in _lexicon_rows(batches):
            texts = Texts(row)
            own = texts.training()
            logs, word = model.log_leaves(texts.tokens().where(own)), texts.word[own]
            outside = np.flatnonzero(texts.leaf[word] == code.value.other)
            logs[outside] += others.log_chance(texts.train[word[outside]] - 1, texts.logs[word[outside]])
            seen, n_tokens = texts.seen()[own], texts.n_tokens[~texts.held]
            again = np.flatnonzero(seen)
            chances, seen, fresh = np.exp(logs[again]), seen[again], logs.sum() - logs[again].sum()
            gains += [*(np.log(kappa * chances + seen).sum() + fresh + (len(logs) - len(again)) * np.log(kappa)
                        - rising(n_tokens, kappa).sum() for kappa in KAPPAS), logs.sum()]
            size += len(logs)
        yield pa.RecordBatch.from_pylist([{"n": size, "data": packed(model.weights.ravel(), model.cells.ravel(), gains)}])

    total = [np.zeros(wordcode.GATES * wordcode.ORDERS), np.zeros(2 * wordcode.GATES * wordcode.STEPS), np.zeros(len(KAPPAS) + 1)]
    n = 0
    learned = scratch.save(map_batches(chunks, run, "n bigint, data binary"))
    for row in learned.toLocalIterator():
        weights, cells, gains = unpacked(row["data"])
        total = [total[0] + row["n"] * weights, total[1] + cells, total[2] + gains]
        n += row["n"]
    weights = total[0] / n if n else total[0] + 0.3
    return weights.reshape(wordcode.GATES, -1), total[1].reshape(2, -1), (*KAPPAS, None)[int(np.argmax(total[2]))]


def score_texts(chunks: DataFrame, code, counts, learned: tuple, others: Others, groups: np.ndarray, tokens: int, types: int) -> DataFrame:
    """Scores of the documents of each chunk."""
    weights, cells, kappa = learned
    log_group = np.log((groups + 1) / (groups.sum() + CLASSES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = wordcode.TextModel(code.value, np.frombuffer(zlib.decompress(counts.value), np.float32), CLASSES, False, weights, cells)
        for row in _lexicon_rows(batches):
            texts = Texts(row)
            base = np.log10((texts.train + 0.1) / (tokens + 0.1 * (types + 1)))
            logs, word = model.log_leaves(texts.tokens()), texts.word
            outside = np.flatnonzero(texts.leaf[word] == code.value.other)
            logs[outside] += others.log_chance(texts.train[word[outside]], texts.logs[word[outside]])
            known, base_score, own = [np.bincount(texts.doc, v, len(texts.ids)) for v in (
                texts.train[word] > 0, base[word], sharpened(logs, texts.seen(), kappa))]
            score = (own - rising(texts.n_tokens, kappa) + log_group[texts.group]) / np.log(10)
            yield pa.RecordBatch.from_arrays([
                pa.array(texts.ids, mask=~texts.valid), pa.array(texts.held), pa.array(texts.n_tokens),
                pa.array(np.rint(known).astype(np.int64)), pa.array(np.full(len(texts.ids), tokens)), pa.array(base_score),
                pa.array(score), pa.array(-score * np.log2(10) / texts.n_bytes),
            ], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"])

    return map_batches(chunks, run, (
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
        "score double, bits_per_byte double"))


@contextlib.contextmanager
def chunk_settings(spark: SparkSession) -> Iterator[None]:
    """Within it, batches to and from Python are bounded in bytes, as rows here are whole chunks, and shuffle files go
    when the table that needed them is written."""
    settings = {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES),
                "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte).

    ``base_score`` is the log10 probability by add-0.1 word counts, ``score`` by the model.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "contextmix")
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    with chunk_settings(spark):
        return _scores(spark, scratch, rows)


def _scores(spark: SparkSession, scratch: Scratch, rows: DataFrame) -> DataFrame:
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(1, -(-int(size) // BUCKET_BYTES))
    centers = letter_groups(rows, scratch)
    table = scratch.save(chunk_words(rows, buckets, centers))
    lexicon = scratch.save(merge_buckets(table.where(F.col("bucket") < buckets), buckets))
    tokens, types, once = lexicon.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("tokens", "types", "once")]).first()

    documents = scratch.save(table.where(F.col("bucket") == buckets))
    scratch.drop(table)  # the words stay in the lexicon

    def shared(counts: np.ndarray):
        return spark.sparkContext.broadcast(zlib.compress(counts.tobytes(), 1))

    lexicon, written = in_tasks(lexicon, buckets), lexicon
    spelling = shared(count_contexts(lexicon, scratch))
    code, outside = frequent_words(lexicon, tokens)
    code, others = spark.sparkContext.broadcast(code), Others(outside, once)
    saved = scratch.save(join_back(word_totals(lexicon, spelling, *learn_spelling(lexicon, spelling, scratch), code), documents, buckets))
    scratch.drop(documents, written)
    chunks = in_tasks(saved, buckets)
    counts, groups = count_texts(chunks, code, scratch)
    counts = shared(counts)
    learned = learn_texts(chunks, code, counts, others, scratch)
    scores = scratch.save(score_texts(chunks, code, counts, learned, others, groups, tokens, types))
    scratch.drop(saved)
    return scores
