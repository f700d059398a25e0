"""Best-fit packing into sequences of fixed capacity by hierarchical residuals.

Level 0: each partition packs its own items, longest first, each into the fullest bin that
still takes it. Bins with at most ``slack`` places left are emitted. The underfull bins go up
as items of the next level, where bins of several partitions meet, and so on until one node
holds all that is left, or a level no longer helps (bins that no other bin fits into). Only
(bin, fill) rows move; a node gets ``NODE_ITEMS`` rows at most on average.

Items with a place in an order are packed by ``pack_in_order`` instead: best fit within windows
of ``WINDOW_PLACES`` places, a window in one task, and sequences numbered by their first place.
Only underfull bins of neighbouring windows go up, for ``MERGE_ROUNDS`` rounds at most, so that no item ends far from its place.

Defined cases: a null text is empty (one piece with the end id); equal lengths go in row
order; repeated rows are packed as often as they occur; a null id is kept as it is; an empty
table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewise.llm.scratch import Scratch
from aislewise.llm.ship import map_batches
from aislewise.llm.subwords import subwords, with_end
from aislewise.llm.textbatch import slices

CAPACITY = 1024
NODE_ITEMS = 200_000
WINDOW_PLACES = 1024
#: Windows whose bins merge in a round, as a power of two, rounds, and bits of a bin's number in its window.
MERGE_BITS = 3
MERGE_ROUNDS = 3
BIN_BITS = 28
PIECES = "piece int, start bigint, length bigint, ids_crc32 bigint"


def cut(n: int, capacity: int) -> np.ndarray:
    """Bounds of the pieces of ``n`` ids: only the first may be shorter than the capacity."""
    first = n - (n - 1) // capacity * capacity
    return np.concatenate([[0], np.arange(first, n + 1, capacity)])


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of each document's ids and the end id."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = subwords(tokenizer, spaces=True)
        for batch in batches:
            for low, _, texts in slices(batch.column(1)):
                ids, offsets = with_end(*encoder.encode(texts), end_id)
                raw = ids.astype("<u4")
                rows = []
                for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                    bounds = cut(b - a, capacity).tolist() if b - a > capacity else (0, b - a)
                    for k, (s, e) in enumerate(zip(bounds[:-1], bounds[1:])):
                        rows.append((low + i, k, s, e - s, zlib.crc32(raw[a + s:a + e]), a + s))
                columns = np.array(rows, np.int64).reshape(-1, 6).T
                arrays = [
                    batch.column(0).take(pa.array(columns[0])), pa.array(columns[1].astype(np.int32)),
                    *(pa.array(c) for c in columns[2:5]),
                ]
                names = [id_col, "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.ListArray.from_arrays(np.append(columns[5], len(ids)).astype(np.int32), ids))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, {PIECES}" + ", ids array<int>" * with_ids
    return map_batches(docs.select(id_col, text_col), pieces, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin of each item, its offset there, fill of each bin), longest items first."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    fills: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: a bin with r places left
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, chosen = capacity, len(fills)
            fills.append(0)
        bins[item], offsets[item] = chosen, fills[chosen]
        fills[chosen] += length
        room -= length
        by_room[room].append(chosen)
        rooms |= 1 << room
    return bins, offsets, np.array(fills, np.int64)


def pack_partitions(items: DataFrame, level: int, capacity: int, slack: int) -> DataFrame:
    """Adds (bin, offset, fill, open) to items with a ``length``, partition by partition."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        lengths = table.column("length").to_numpy()
        bins, offsets, fills = best_fit(lengths, capacity)
        fill = fills[bins] if len(bins) else bins
        base = (level << 58) + (TaskContext.get().partitionId() << 28)
        for name, values in (("bin", base + bins), ("offset", offsets), ("fill", fill), ("open", fill < capacity - slack)):
            table = table.append_column(name, pa.array(values))
        yield from table.to_batches(max_chunksize=10_000)

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
    return map_batches(items, pack, f"{columns}, bin bigint, offset bigint, fill bigint, open boolean")


def best_fit_pack(items: DataFrame, capacity: int = CAPACITY, slack: int | None = None,
                  node_items: int = NODE_ITEMS) -> DataFrame:
    """``items`` (any columns, with ``length`` from 1 to ``capacity``) with ``sequence_id`` and
    ``offset``: gapless places in as few sequences as best fit finds."""
    scratch = Scratch(items.sparkSession, "bestfit")
    slack = capacity // 64 if slack is None else slack
    packed = scratch.save(pack_partitions(items, 0, capacity, slack))
    onto: list[DataFrame] = []
    below, before = packed, None
    while True:
        left = below.where("open and offset = 0").select(F.col("bin").alias("child"), F.col("fill").alias("length"))
        n = left.count()
        nodes = -(-n // node_items)
        if n <= 1 or before is not None and (nodes > 1 and n > 0.9 * before or nodes == before_nodes == 1):
            break
        level = scratch.save(pack_partitions(left.repartition(nodes), len(onto) + 1, capacity, slack))
        onto.append(level)
        below, before, before_nodes = level, n, nodes
    moves = None
    for level in reversed(onto):
        own = level.select("child", "bin", "offset")
        if moves is not None:
            up = moves.select(F.col("child").alias("bin"), F.col("bin").alias("up_bin"), F.col("offset").alias("up_offset"))
            own = own.join(up, "bin", "left").select(
                "child", F.coalesce("up_bin", "bin").alias("bin"),
                (F.col("offset") + F.coalesce("up_offset", F.lit(0))).alias("offset"))
        moves = own
    columns = [F.col(f"`{c}`") for c in items.columns]
    if moves is None:
        return packed.select(*columns, F.col("bin").alias("sequence_id"), "offset")
    moves = moves.select(F.col("child").alias("bin"), F.col("bin").alias("up_bin"), F.col("offset").alias("up_offset"))
    return packed.join(moves, "bin", "left").select(
        *columns, F.coalesce("up_bin", "bin").alias("sequence_id"),
        (F.col("offset") + F.coalesce("up_offset", F.lit(0))).alias("offset"))


def pack_in_order(items: DataFrame, capacity: int = CAPACITY, window_places: int = WINDOW_PLACES,
                  run_items: int = NODE_ITEMS, slack: int | None = None, rounds: int = MERGE_ROUNDS) -> DataFrame:
    """``items`` (with ``length`` and ``position``) with ``sequence_id`` and ``offset``. Sequences in
    the order of their ids follow the smallest position they hold, but for equal positions of more than
    ``run_items`` items, which are packed in runs.

    Windows of places are packed by best fit. Then underfull bins of ``2 ** MERGE_BITS`` neighbouring windows are
    packed as items, and those of as many such groups, for ``rounds`` rounds or until one saves no bin: that bounds how far
    from its place in the order an item may end. A merged bin takes the id of its first part.
    """
    scratch = Scratch(items.sparkSession, "ordered")
    slack = capacity // 64 if slack is None else slack
    window = F.floor(F.col("position") / window_places).cast("bigint")
    order = [F.col("position"), *[F.col(c) for c in ("piece",) if c in items.columns]]
    packed = scratch.save(_pack_windows(items, window, order, capacity, run_items))
    moves, below = None, packed
    for level in range(1, rounds + 1):
        left = below.where((F.col("offset") == 0) & (F.col("fill") < capacity - slack)).select(
            F.col("bin").alias("child"), F.col("fill").alias("length"))
        group = F.shiftright("child", BIN_BITS + level * MERGE_BITS)
        merged = scratch.save(_pack_windows(left, group, [F.col("child")], capacity, run_items))
        n, bins = merged.agg(F.count(F.lit(1)), F.count_if(F.col("offset") == 0)).first()
        if n == bins:
            break
        # A bin is named by its first part, and its children by theirs: one look-up a level.
        own = merged.select("child", "bin", "offset")
        if moves is None:
            moves = own
        else:
            up = own.select(F.col("child").alias("up_child"), F.col("bin").alias("up_bin"), F.col("offset").alias("up_offset"))
            moves = moves.join(up, F.col("bin") == F.col("up_child"), "left").select(
                "child", F.coalesce("up_bin", "bin").alias("bin"), (F.col("offset") + F.coalesce("up_offset", F.lit(0))).alias("offset"))
        below = merged
    columns = [F.col(f"`{c}`") for c in items.columns]
    if moves is None:
        return packed.select(*columns, F.col("bin").alias("sequence_id"), "offset")
    moves = moves.select(F.col("child").alias("own_bin"), F.col("bin").alias("up_bin"), F.col("offset").alias("up_offset"))
    return packed.join(moves, F.col("bin") == F.col("own_bin"), "left").select(
        *columns, F.coalesce("up_bin", "bin").alias("sequence_id"),
        (F.col("offset") + F.coalesce("up_offset", F.lit(0))).alias("offset"))


def _pack_windows(items: DataFrame, window: Column, order: list[Column], capacity: int, run_items: int) -> DataFrame:
    """Adds (bin, offset, fill) to items, packed window by window in ``order``. Bins of items are numbered by their
    first item within the window; bins of bins (items with ``child``) take the least number they hold."""
    names = items.columns
    nested = "child" in names

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now, rows, used = None, 0, 0

        def done() -> Iterator[pa.RecordBatch]:
            nonlocal held, rows, used
            if not held:
                return
            table = pa.Table.from_batches(held)
            bins, offsets, fills = best_fit(table.column("length").to_numpy(), capacity)
            first = np.full(len(fills), len(bins))
            np.minimum.at(first, bins, np.arange(len(bins)))  # rows come in order
            if nested:
                number = table.column("child").to_numpy()[first]
            else:
                rank = np.empty(len(fills), np.int64)
                rank[np.argsort(first)] = np.arange(len(fills))
                number = (now << BIN_BITS) + used + rank
            for name, values in (("bin", number[bins]), ("offset", offsets), ("fill", fills[bins])):
                table = table.append_column(name, pa.array(values, pa.int64()))
            yield from table.to_batches(max_chunksize=10_000)
            held, rows, used = [], 0, used + len(fills)

        for batch in batches:
            own = batch.column(batch.num_columns - 1).to_numpy()
            cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
            for low, high in zip(cuts[:-1], cuts[1:]):
                if low == high:
                    continue
                if own[low] != now or rows >= run_items:
                    yield from done()
                if own[low] != now:
                    now, used = int(own[low]), 0
                held.append(batch.slice(low, high - low))
                rows += high - low
        yield from done()

    dealt = items.withColumn("_window", window)
    dealt = dealt.repartition("_window").sortWithinPartitions("_window", *order)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
    return map_batches(dealt, pack, f"{columns}, bin bigint, offset bigint, fill bigint").drop("_window")
