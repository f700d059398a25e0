"""Token ids as static range asymmetric numeral system (rANS) blocks.

The frequency table is counted over all ids and shared by all blocks. A block holds whole
documents in order and is decoded on its own: ``LANES`` interleaved coders work side by side,
and every ``CHECKPOINT_STEPS`` steps the coder states and the place in the words are noted, so
the parts between two checkpoints are decoded in parallel too. Blocks carry checksums of
their bytes and of their ids, and of the table they need.

Files are Parquet tables below one folder, so they can be in any store Spark writes to:
``table`` (id, freq) and ``blocks`` (part, block, n_docs, n_tokens, start, data), parts in
ascending order of document ids.

Block data, little-endian: magic, counts (documents, ids, steps, words), table checksum, ids
checksum; document ids (int64), whether each is not null (uint8), their lengths (uint32); per
checkpoint the lanes' states (uint64) and the word it starts at (uint32); words (uint32);
checksum of all before.

Defined cases: a null text is empty (the end id alone); a null id sorts first; rows of one id
are kept next to each other, in order of their ids' checksums; an empty table gives empty files.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aislewise.llm.ship import map_batches
from aislewise.llm.subwords import subwords, with_end
from aislewise.llm.textbatch import slices

LANES = 1024
CHECKPOINT_STEPS = 128
BLOCK_TOKENS = 1 << 19
PART_TOKENS = 8 << 20
SCALE_BITS = 22
LOW = np.uint64(1 << 31)
MAGIC = b"RNSB"
HEADER = struct.Struct("<4sIIIIII")


class CorruptBlock(ValueError):
    pass


@dataclass(frozen=True)
class FrequencyTable:
    """``freq`` per id, 2 ** SCALE_BITS in all; ids with no count have none."""

    freq: np.ndarray

    @classmethod
    def from_counts(cls, counts: np.ndarray) -> FrequencyTable:
        """Shares of the counts, at least 1 for every id that occurs."""
        used = np.flatnonzero(counts)
        freq = np.zeros(len(counts), np.int64)
        if len(used):
            total, room = counts[used].sum(), (1 << SCALE_BITS) - len(used)
            share = counts[used].astype(object) * room // int(total)
            freq[used] = 1 + share.astype(np.int64)
            freq[used[np.argmax(counts[used])]] += (1 << SCALE_BITS) - freq.sum()
        return cls(freq.astype(np.uint64))

    @property
    def checksum(self) -> int:
        return zlib.crc32(self.freq.astype("<u4").tobytes())

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.freq) - self.freq

    def symbols(self) -> np.ndarray:
        """Id at each of the 2 ** SCALE_BITS places."""
        return np.repeat(np.arange(len(self.freq), dtype=np.int32), self.freq.astype(np.int64))


def encode_ids(ids: np.ndarray, table: FrequencyTable, lanes: int = LANES,
               every: int = CHECKPOINT_STEPS) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(steps, states at checkpoints, words before them, words)."""
    steps = -(-len(ids) // lanes)
    padded = np.full(steps * lanes, ids[0] if len(ids) else 0, np.int64)
    padded[:len(ids)] = ids
    freq, start = table.freq[padded].reshape(steps, lanes), table.starts[padded].reshape(steps, lanes)
    state = np.full(lanes, LOW, np.uint64)
    words: list[np.ndarray] = []
    states, sizes = [], np.zeros(steps, np.int64)
    bits, word = np.uint64(SCALE_BITS), np.uint64(32)
    limit = (LOW >> bits) << word
    for k in range(steps - 1, -1, -1):
        f = freq[k]
        full = state >= limit * f
        words.append(state[full].astype(np.uint32))
        sizes[k] = len(words[-1])
        state = np.where(full, state >> word, state)
        quotient = state // f
        state = (quotient << bits) + (state - quotient * f) + start[k]
        if k % every == 0:
            states.append(state)
    before = np.cumsum(sizes) - sizes
    flat = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
    return steps, np.array(states[::-1], np.uint64).reshape(-1, lanes), before[::every].astype(np.uint32), flat


def decode_ids(n: int, steps: int, states: np.ndarray, before: np.ndarray, words: np.ndarray,
               table: FrequencyTable, symbols: np.ndarray, every: int = CHECKPOINT_STEPS) -> np.ndarray:
    """All parts between checkpoints side by side."""
    parts, lanes = states.shape
    out = np.zeros((parts, every, lanes), np.int32)
    state, at = states.copy(), before.astype(np.int64)
    starts, freq = table.starts, table.freq
    bits, mask, word = np.uint64(SCALE_BITS), np.uint64((1 << SCALE_BITS) - 1), np.uint64(32)
    words = np.append(words, np.zeros(1, np.uint32)).astype(np.uint64)
    for k in range(min(every, steps)):
        live = parts if k < steps - (parts - 1) * every else parts - 1
        x = state[:live]
        place = x & mask
        found = symbols[place]
        out[:live, k] = found
        x = freq[found] * (x >> bits) + place - starts[found]
        need = x < LOW
        order = np.cumsum(need, axis=1)
        index = np.minimum(at[:live, None] + order - 1, len(words) - 1)
        state[:live] = np.where(need, (x << word) | words[np.maximum(index, 0)], x)
        at[:live] += order[:, -1]
    return out.reshape(-1)[:n]


def pack_block(doc_ids: np.ndarray, valid: np.ndarray, lengths: np.ndarray, ids: np.ndarray, table: FrequencyTable) -> bytes:
    steps, states, before, words = encode_ids(ids, table)
    body = b"".join((
        HEADER.pack(MAGIC, len(lengths), len(ids), steps, len(words), table.checksum, zlib.crc32(ids.astype("<u4").tobytes())),
        doc_ids.astype("<i8").tobytes(), valid.astype(np.uint8).tobytes(), lengths.astype("<u4").tobytes(),
        states.astype("<u8").tobytes(), before.astype("<u4").tobytes(), words.astype("<u4").tobytes(),
    ))
    return body + struct.pack("<I", zlib.crc32(body))


def unpack_block(data: bytes, table: FrequencyTable, symbols: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document ids, whether not null, lengths, ids); raises ``CorruptBlock``."""
    if len(data) < HEADER.size + 4 or struct.unpack("<I", data[-4:])[0] != zlib.crc32(data[:-4]):
        raise CorruptBlock("block bytes do not match their checksum")
    magic, n_docs, n, steps, n_words, table_sum, ids_sum = HEADER.unpack_from(data)
    if magic != MAGIC or table_sum != table.checksum:
        raise CorruptBlock("block of another format or table")
    place = HEADER.size

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal place
        values = np.frombuffer(data, kind, count, place)
        place += values.nbytes
        return values

    doc_ids, valid, lengths = take("<i8", n_docs), take("u1", n_docs), take("<u4", n_docs)
    parts = -(-steps // CHECKPOINT_STEPS)
    states = take("<u8", parts * LANES).reshape(parts, LANES)
    before, words = take("<u4", parts), take("<u4", n_words)
    ids = decode_ids(n, steps, states, before, words, table, symbols)
    if zlib.crc32(ids.astype("<u4").tobytes()) != ids_sum:
        raise CorruptBlock("decoded ids do not match their checksum")
    return doc_ids, valid.astype(bool), lengths.astype(np.int64), ids


def tokenize(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n_tokens, ids): ids as little-endian bytes of 16 or 32 bits, with the end id."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = subwords(tokenizer, spaces=False)
        kind = _kind(encoder.tokenizer.get_vocab_size())
        for batch in batches:
            for low, high, texts in slices(batch.column(1)):
                ids, offsets = with_end(*encoder.encode(texts), end_id)
                raw = ids.astype(kind)
                packed = pa.Array.from_buffers(pa.binary(), high - low, [
                    None, pa.py_buffer((offsets * raw.itemsize).astype(np.int32)), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low).cast(pa.int64()), pa.array(np.diff(offsets)), packed],
                    ["id", "n_tokens", "ids"])

    return map_batches(docs.select(id_col, text_col), encode, "id bigint, n_tokens bigint, ids binary")


def _kind(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def count_ids(tokens: DataFrame, vocabulary: int) -> np.ndarray:
    """Occurrences of every id; each partition sends its own counts."""
    kind = _kind(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(vocabulary, np.int64)
        for batch in batches:
            counts += np.bincount(_flat(batch.column(0), kind), minlength=vocabulary)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["id", "n"])

    rows = map_batches(tokens.select("ids"), count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    out = np.zeros(vocabulary, np.int64)
    for row in rows.toLocalIterator():  # one row for each id of the vocabulary at most
        out[row["id"]] = row["n"]
    return out


def _flat(column: pa.Array, kind: str) -> np.ndarray:
    """All ids of a binary column, one row after the other."""
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, kind)
    at = np.frombuffer(offsets, np.int32, len(column) + 1, column.offset * 4)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]].view(kind)


def encode_blocks(tokens: DataFrame, table: FrequencyTable, vocabulary: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(part, block, n_docs, n_tokens, start, data) of partitions in order of ids."""
    kind = _kind(vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, start = TaskContext.get().partitionId(), 0, 0
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size, block, start
            doc_ids = np.concatenate([h[0] for h in held])
            valid, lengths = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            data = pack_block(doc_ids, valid, lengths, np.concatenate([h[3] for h in held]), table)
            row = pa.RecordBatch.from_pylist([{
                "part": part, "block": block, "n_docs": len(lengths), "n_tokens": size, "start": start, "data": data}])
            block, start, held, size = block + 1, start + size, [], 0
            return row

        for batch in batches:
            lengths = batch.column("n_tokens").to_numpy()
            ids = _flat(batch.column("ids"), kind)
            doc_ids = batch.column("id").fill_null(0).to_numpy()
            valid = batch.column("id").is_valid().to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            low = 0
            while low < len(lengths):
                done = ends[low - 1] if low else 0
                high = max(low + 1, int(np.searchsorted(ends, done + block_tokens - size, "right")))
                if size and ends[low] - done + size > block_tokens:
                    yield flush()
                    continue
                held.append((doc_ids[low:high], valid[low:high], lengths[low:high], ids[done:ends[high - 1]].astype(np.int32)))
                size += int(ends[high - 1] - done)
                low = high
        if held:
            yield flush()

    return map_batches(tokens, encode, (
        "part bigint, block bigint, n_docs bigint, n_tokens bigint, start bigint, data binary"))


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text", part_tokens: int = PART_TOKENS) -> None:
    """Writes the files of ``docs`` below ``folder``, in ascending order of ids."""
    spark = docs.sparkSession
    vocabulary = subwords(tokenizer, spaces=False).tokenizer.get_vocab_size()
    staged = f"{folder}/staged"
    tokenize(docs, tokenizer, end_id, id_col, text_col).write.option("compression", "zstd").parquet(staged)
    tokens = spark.read.parquet(staged)
    counts = count_ids(tokens, vocabulary)
    table = FrequencyTable.from_counts(counts)
    spark.createDataFrame([(int(i), int(table.freq[i])) for i in np.flatnonzero(counts)], "id int, freq bigint") \
        .coalesce(1).write.parquet(f"{folder}/table")
    parts = max(1, -(-int(counts.sum()) // part_tokens), spark.sparkContext.defaultParallelism)
    ordered = tokens.repartitionByRange(parts, F.col("id").asc_nulls_first()).sortWithinPartitions(
        F.col("id").asc_nulls_first(), F.crc32("ids"))
    encode_blocks(ordered, table, vocabulary).write.option("compression", "none").parquet(f"{folder}/blocks")
    path = spark._jvm.org.apache.hadoop.fs.Path(staged)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_token_files(spark: SparkSession, folder: str, vocabulary: int, with_ids: bool = False) -> DataFrame:
    """(part, block, at, id, start, n_tokens, ids_crc32[, ids]): decoded documents; ``start``
    counts the ids of all documents before, ``at`` is the place in the block."""
    freq = np.zeros(vocabulary, np.uint64)
    for row in spark.read.parquet(f"{folder}/table").toLocalIterator():
        freq[row["id"]] = row["freq"]
    blocks = spark.read.parquet(f"{folder}/blocks")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = FrequencyTable(freq)
        symbols = table.symbols()
        for batch in batches:
            for row in range(batch.num_rows):
                part, block, start = (batch.column(k)[row].as_py() for k in range(3))
                doc_ids, valid, lengths, ids = unpack_block(batch.column(3)[row].as_py(), table, symbols)
                ends = np.cumsum(lengths)
                n, raw = len(lengths), ids.astype("<u4")
                sums = [zlib.crc32(raw[a:b]) for a, b in zip((ends - lengths).tolist(), ends.tolist())]
                arrays = [
                    pa.array(np.full(n, part)), pa.array(np.full(n, block)), pa.array(np.arange(n)),
                    pa.array(doc_ids, mask=~valid), pa.array(start + ends - lengths), pa.array(lengths),
                    pa.array(sums, pa.int64()),
                ]
                if with_ids:
                    arrays.append(pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), ids))
                yield pa.RecordBatch.from_arrays(arrays, names)

    names = ["part", "block", "at", "id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    decoded = map_batches(blocks.select("part", "block", "start", "data"), decode, (
        ", ".join(f"{n} bigint" for n in names[:7]) + ", ids array<int>" * with_ids))
    sizes = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # One row for each file part: their running sum is small.
    before = sizes.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
    rows = decoded.withColumnRenamed("start", "local").join(before, "part")
    return rows.withColumn("start", F.col("local") + F.col("before")).select(*names)
