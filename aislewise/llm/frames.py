"""Texts as seekable sequences of independent zstandard frames, and fill-in-middle over them.

A text is stored as an array of frames. A frame holds at most ``FRAME_BYTES`` bytes of UTF-8,
cut between code points, compressed on its own, with the units (lines) and code points that end
before it. A place given in units is found by its cumulative count, and only the frame that
holds it is decompressed; whole frames pass from a text to its rearrangement as they are.

``frame_texts`` writes such a column, ``fill_in_middle`` rearranges stored texts into a frame
column of their output, ``digests`` streams the frames of an output in order, once for its own
digest and once for the text rebuilt from it, a frame in memory at a time.

Units are lines: pieces matching ``[^\\n]*\\n|[^\\n]+``. A cut after k units is after the k-th
newline, or at the end of the text where k counts a last line without one.

Defined cases: a null text is empty, has no units and no frames, and stays plain; a null id
draws its cuts from ``7:`` alone; repeated rows are rearranged alike, each on its own; an empty
table gives no rows; a very long line spans frames, and very long texts are held as one value of
their row (as in the input) and its compressed frames. Other columns are not handed on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewise.llm.ship import map_batches

FRAME_BYTES = 1 << 16
LEVEL = 3
CHUNK_BYTES = 8 << 20
MARKS = ("<P>", "<S>", "<M>")
FRAME = "struct<units_before:bigint,chars_before:bigint,n_bytes:int,data:binary>"
_FRAME_TYPE = pa.list_(pa.struct([
    ("units_before", pa.int64()), ("chars_before", pa.int64()), ("n_bytes", pa.int32()), ("data", pa.binary())]))


def count_chars(data: bytes) -> int:
    """Code points of whole UTF-8 text."""
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


@dataclass
class FrameWriter:
    """Collects pieces of a text into frames; ready frames may be appended between them."""

    compressor: zstandard.ZstdCompressor
    size: int = FRAME_BYTES

    def __post_init__(self) -> None:
        self.frames: list[dict] = []
        self.open = bytearray()
        self.units = self.chars = 0

    def write(self, data: bytes | memoryview) -> None:
        at = 0
        while at < len(data):
            end = min(len(data), at + self.size - len(self.open))
            while end < len(data) and data[end] & 0xC0 == 0x80:
                end -= 1
            if end > at:
                self.open += data[at:end]
            elif not self.open:
                raise ValueError("a frame must hold at least one code point")
            at = max(end, at)
            if at < len(data):
                self.flush()

    def flush(self) -> None:
        if self.open:
            data = bytes(self.open)
            self._append(self.compressor.compress(data), len(data), data.count(b"\n"), count_chars(data))
            self.open.clear()

    def _append(self, compressed: bytes, n_bytes: int, units: int, chars: int) -> None:
        self.frames.append({
            "units_before": self.units, "chars_before": self.chars, "n_bytes": n_bytes, "data": compressed})
        self.units += units
        self.chars += chars

    def append(self, frame: dict, units: int, chars: int) -> None:
        """A ready frame of that many units and code points, as it is."""
        self.flush()
        self._append(frame["data"], frame["n_bytes"], units, chars)

    def close(self) -> list[dict]:
        self.flush()
        return self.frames


class FramedText:
    """Random access to a stored text by units."""

    def __init__(self, frames: list[dict], decompressor: zstandard.ZstdDecompressor, units: int, chars: int):
        self.frames, self.decompressor = frames, decompressor
        self.units_before = [f["units_before"] for f in frames]
        self.units_end = [*self.units_before[1:], units]
        self.chars_end = [*[f["chars_before"] for f in frames[1:]], chars]
        self.cached: tuple[int, bytes] = (-1, b"")

    def data(self, k: int) -> bytes:
        """Decompressed frame ``k``; the last one stays at hand."""
        if self.cached[0] != k:
            frame = self.frames[k]
            self.cached = k, self.decompressor.decompress(frame["data"], max_output_size=frame["n_bytes"])
        return self.cached[1]

    def locate(self, units: int) -> tuple[int, int, int]:
        """(frame, byte in it, code points before) of the end of the first ``units`` units."""
        if units == 0:
            return 0, 0, 0
        k = int(np.searchsorted(self.units_end, units, "left"))
        if k >= len(self.frames):  # the last line, without a newline
            return len(self.frames), 0, self.chars_end[-1] if self.frames else 0
        data, at = self.data(k), -1
        for _ in range(units - self.units_before[k]):
            at = data.index(b"\n", at + 1)
        return k, at + 1, self.frames[k]["chars_before"] + count_chars(data[:at + 1])

    def copy(self, start: tuple, end: tuple, out: FrameWriter) -> None:
        """Writes the text between two places; whole frames are passed on compressed."""
        (k, at), (last, stop) = start[:2], end[:2]
        while k < last:
            if at == 0:
                units = self.units_end[k] - self.units_before[k]
                out.append(self.frames[k], units, self.chars_end[k] - self.frames[k]["chars_before"])
            else:
                out.write(self.data(k)[at:])
            k, at = k + 1, 0
        if k == last and stop > at:
            out.write(self.data(k)[at:stop])


def read_frames(frames: list[dict], decompressor: zstandard.ZstdDecompressor) -> Iterator[bytes]:
    """Text of the frames in order, a frame at a time."""
    for frame in frames:
        yield decompressor.decompress(frame["data"], max_output_size=frame["n_bytes"])


def _in_chunks(sizes: Iterator[tuple[int, tuple]]) -> Iterator[list[tuple]]:
    """Rows in lists of about ``CHUNK_BYTES``, or one longer row."""
    rows, size = [], 0
    for n_bytes, row in sizes:
        rows.append(row)
        size += n_bytes
        if size >= CHUNK_BYTES:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def frame_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", marks: tuple[str, ...] = MARKS,
                frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """(id, marked, n_units, n_newlines, n_chars, frames) of every text; ``marked``: it holds one of ``marks``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    marked = F.lit(False)
    for mark in marks:
        marked = marked | F.contains(text, F.lit(mark))
    rows = docs.select(F.col(id_col).alias("id"), marked.alias("marked"), text.alias("text"))

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=LEVEL)

        def framed(batch: pa.RecordBatch) -> Iterator[tuple[int, tuple]]:
            data = batch.column(2).cast(pa.large_binary())
            for k in range(batch.num_rows):
                raw = memoryview(data[k].as_buffer())
                writer = FrameWriter(compressor, frame_bytes)
                writer.write(raw)
                frames = writer.close()
                units = writer.units + (len(raw) > 0 and raw[-1] != 0x0A)
                size = sum(len(f["data"]) for f in frames)
                yield size, (k, units, writer.units, writer.chars, frames)

        for batch in batches:
            for rows in _in_chunks(framed(batch)):
                at, units, newlines, chars, frames = zip(*rows, strict=True)
                taken = pa.array(at, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(taken), batch.column(1).take(taken), pa.array(units, pa.int64()),
                    pa.array(newlines, pa.int64()), pa.array(chars, pa.int64()), pa.array(frames, _FRAME_TYPE),
                ], ["id", "marked", "n_units", "n_newlines", "n_chars", "frames"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(rows, store, (
        f"id {kind}, marked boolean, n_units bigint, n_newlines bigint, n_chars bigint, frames array<{FRAME}>"))


def drawn(id_column: Column, k: int) -> Column:
    """The ``k``-th 8-digit group of the sha256 of ``7:id`` as a number."""
    digest = F.sha2(F.concat(F.lit("7:"), F.coalesce(id_column.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint")


def fill_in_middle(store: DataFrame, rate: int = 100, spm_rate: int = 50) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of stored texts; ``output`` is a frame column.

    ``rate`` percent of the texts are rearranged, ``spm_rate`` percent of them in the form spm.
    """
    first, second = (drawn(F.col("id"), k) % (F.col("n_units") + 1) for k in (0, 1))
    plain = (F.col("n_units") == 0) | F.col("marked") | (drawn(F.col("id"), 2) % 100 >= rate)
    form = F.when(plain, "plain").when(drawn(F.col("id"), 3) % 100 < spm_rate, "spm").otherwise("psm")
    chosen = store.select(
        "id", F.col("n_units").alias("n"), form.alias("form"), F.least(first, second).alias("low"),
        F.greatest(first, second).alias("high"), "n_newlines", "n_chars", "frames")

    def rearrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor, decompressor = zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor()
        mark_p, mark_s, mark_m = (m.encode() for m in MARKS)

        def arranged(batch: pa.RecordBatch) -> Iterator[tuple[int, tuple]]:
            n, forms, lows, highs, newlines, chars = (batch.column(k).to_pylist() for k in range(1, 7))
            for k in range(batch.num_rows):
                frames = batch.column(7)[k].as_py()
                size = sum(len(f["data"]) for f in frames)
                if forms[k] == "plain":
                    yield size, (k, None, None, frames)
                    continue
                text = FramedText(frames, decompressor, newlines[k], chars[k])
                start, end = (0, 0, 0), (len(frames), 0, chars[k])
                one, two = text.locate(lows[k]), text.locate(highs[k])
                out = FrameWriter(compressor)
                parts = [(mark_p, start, one), (mark_s, two, end), (mark_m, one, two)]
                for mark, begin, stop in parts if forms[k] == "psm" else [parts[1], parts[0], parts[2]]:
                    out.write(mark)
                    text.copy(begin, stop, out)
                yield size, (k, one[2], two[2] - one[2], out.close())

        for batch in batches:
            for rows in _in_chunks(arranged(batch)):
                at, prefix, middle, output = zip(*rows, strict=True)
                taken = pa.array(at, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    *[batch.column(c).take(taken) for c in range(3)], pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()), pa.array(output, _FRAME_TYPE),
                ], ["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = store.schema["id"].dataType.simpleString()
    return map_batches(chosen, rearrange, (
        f"id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output array<{FRAME}>"))


def _mark_places(pieces: Iterator[bytes], marks: list[bytes]) -> list[int]:
    """Byte places of the first of each mark, each searched after the one before."""
    places, passed, tail = [], 0, b""
    for piece in pieces:
        window = tail + piece
        start = passed - len(tail)
        after = max(0, places[-1] + len(marks[len(places) - 1]) - start) if places else 0
        while len(places) < len(marks):
            at = window.find(marks[len(places)], after)
            if at < 0:
                break
            after = at + len(marks[len(places)])
            places.append(start + at)
        passed += len(piece)
        tail = window[-2:]
    if len(places) < len(marks):
        raise ValueError("a mark is missing from the output")
    return places


def _stream_part(frames: list[dict], start: int, end: int | None, decompressor, digest) -> None:
    """Feeds bytes start..end of the text to ``digest``; frames outside are not decompressed."""
    at = 0
    for frame in frames:
        stop = at + frame["n_bytes"]
        if stop > start and (end is None or at < end):
            data = decompressor.decompress(frame["data"], max_output_size=frame["n_bytes"])
            digest.update(data[max(0, start - at):len(data) if end is None else min(len(data), end - at)])
        at = stop


def restored_digest(frames: list[dict], form: str, decompressor: zstandard.ZstdDecompressor):
    """sha256 of the text that an output and its form give back."""
    digest = hashlib.sha256()
    if form == "plain":
        for piece in read_frames(frames, decompressor):
            digest.update(piece)
        return digest
    order = MARKS if form == "psm" else (MARKS[1], MARKS[0], MARKS[2])
    marks = [m.encode() for m in order]
    places = _mark_places(read_frames(frames, decompressor), marks)
    ends = [*places[1:], None]
    parts = {mark: (place + len(raw), end) for mark, raw, place, end in zip(order, marks, places, ends, strict=True)}
    for mark in (MARKS[0], MARKS[2], MARKS[1]):
        _stream_part(frames, *parts[mark], decompressor, digest)
    return digest


def digests(outputs: DataFrame) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) read from ``output``."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompressor = zstandard.ZstdDecompressor()
        for batch in batches:
            forms, sums, restored = batch.column(2).to_pylist(), [], []
            for k in range(batch.num_rows):
                frames, digest = batch.column(5)[k].as_py(), hashlib.sha256()
                for piece in read_frames(frames, decompressor):
                    digest.update(piece)
                sums.append(digest.hexdigest())
                restored.append(restored_digest(frames, forms[k], decompressor).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sums, pa.string()), pa.array(restored, pa.string())],
                [*batch.schema.names[:5], "output_sha256", "restored_sha256"])

    kind = outputs.schema["id"].dataType.simpleString()
    return map_batches(outputs.select("id", "n", "form", "prefix_chars", "middle_chars", "output"), compute, (
        f"id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, "
        "restored_sha256 string"))


def texts_of(outputs: DataFrame, frames_col: str = "output") -> DataFrame:
    """(id, text): the texts of a frame column, as training rows."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompressor = zstandard.ZstdDecompressor()
        for batch in batches:
            def texts(batch: pa.RecordBatch = batch) -> Iterator[tuple[int, tuple]]:
                for k in range(batch.num_rows):
                    text = b"".join(read_frames(batch.column(1)[k].as_py(), decompressor))
                    yield len(text), (k, text.decode())

            for rows in _in_chunks(texts()):
                at, text = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at, pa.int32())), pa.array(text, pa.string())], ["id", "text"])

    kind = outputs.schema["id"].dataType.simpleString()
    return map_batches(outputs.select("id", frames_col), decode, f"id {kind}, text string")
