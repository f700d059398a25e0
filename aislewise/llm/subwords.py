"""Subword ids of whole texts by the ``tokenizers`` library, a distinct chunk at a time.

Texts are cut where every pre-tokenizer of the two supported files cuts them anyway: before
a run of ASCII white space, and between an ASCII letter and one of ``.,!?;:``. Each distinct
chunk is encoded once per worker and its ids are gathered from then on, so the ids are those
of the whole text at a fraction of the time (a test compares them).
"""

from __future__ import annotations

import os

import numpy as np

from aislewise.llm.textbatch import LOWER, SPACE, Texts, distinct, find_words

MAX_CACHED = 1_000_000
_LETTER = np.isin(np.arange(256), np.frombuffer(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", np.uint8))
_STOP = np.isin(np.arange(256), np.frombuffer(b".,!?;:", np.uint8))


def default_tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _after_wide_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before ``at`` is white space outside ASCII."""
    one, two, three = (np.where(at >= k, data[at - k], 0) for k in (1, 2, 3))
    return (
        ((two == 0xC2) & ((one == 0x85) | (one == 0xA0)))
        | ((three == 0xE1) & (two == 0x9A) & (one == 0x80))
        | ((three == 0xE2) & (two == 0x80) & ((one <= 0x8A) | np.isin(one, (0xA8, 0xA9, 0xAF))))
        | ((three == 0xE2) & (two == 0x81) & (one == 0x9F))
        | ((three == 0xE3) & (two == 0x80) & (one == 0x80))
    )


def ragged(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Indexes first[0], first[0] + 1, ... (count[0] of them), first[1], ..."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - count), count)


class Subwords:
    """``spaces``: whether white space is part of the ids (a byte-level file) or dropped and
    ASCII lower-cased (a file with word ends)."""

    def __init__(self, path: str, spaces: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.spaces = spaces
        self.mark = self.tokenizer.encode("\0", add_special_tokens=False).ids[0]
        self._clear()

    def _clear(self) -> None:
        self.tiers = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))] * 2
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.int32)

    def _cut(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        data = texts.data
        stops = np.flatnonzero(_STOP[data[1:]] & _LETTER[data[:-1]]) + 1 if len(data) else np.zeros(0, np.int64)
        rows = texts.offsets[:-1][np.diff(texts.offsets) > 0]
        if self.spaces:
            gaps = np.flatnonzero(SPACE[data[1:]] & ~SPACE[data[:-1]]) + 1 if len(data) else stops
            gaps = gaps[~_after_wide_space(data, gaps)] if len(gaps) else gaps
            starts = distinct(np.concatenate([rows, gaps, stops]))
            return starts, np.append(starts[1:], len(data))[:len(starts)]
        words = find_words(texts)
        return distinct(np.concatenate([words.starts, stops])), distinct(np.concatenate([words.ends, stops]))

    def _look_up(self, keys: np.ndarray) -> np.ndarray:
        slots = np.full(len(keys), -1, np.int64)
        for known, slot in self.tiers:
            if len(known):
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                found = known[at] == keys
                slots[found] = slot[at[found]]
        return slots

    def _encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of each chunk's ids, their number, all ids). Chunks go to the library joined
        by a mark that no merge crosses; those that the mark could change go alone."""
        mark = "\0" if self.spaces else " \0 "
        alone = [k for k, c in enumerate(chunks) if "\0" in c or c[0] == "'" or c[-1].isspace()]
        joined = np.delete(np.arange(len(chunks)), alone)
        first, counts = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        parts, size = [np.zeros(0, np.int32)], 0
        for k, e in zip(alone, self.tokenizer.encode_batch_fast([chunks[k] for k in alone], add_special_tokens=False)):
            first[k], counts[k] = size, len(e.ids)
            parts.append(np.array(e.ids, np.int32))
            size += len(e.ids)
        for low in range(0, len(joined), 4096):
            at = joined[low:low + 4096]
            texts = [mark.join([chunks[k] for k in at[i:i + 64]]) + mark for i in range(0, len(at), 64)]
            flat = np.concatenate([
                np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
            ends = np.flatnonzero(flat == self.mark)
            counts[at] = np.diff(ends, prepend=-1) - 1
            first[at] = size + ends - counts[at]
            parts.append(flat)
            size += len(flat)
        return first, counts, np.concatenate(parts)

    def _add(self, keys: np.ndarray, first: np.ndarray, counts: np.ndarray, fresh: np.ndarray) -> None:
        """``keys`` are sorted and new."""
        slots = len(self.count) + np.arange(len(keys))
        self.first = np.append(self.first, len(self.pool) + first)
        self.count, self.pool = np.append(self.count, counts), np.append(self.pool, fresh)
        old, recent = self.tiers
        recent = self._merged(recent, (keys, slots))
        if len(recent[0]) > 20_000 + len(old[0]) // 3:
            old, recent = self._merged(old, recent), (keys[:0], slots[:0])
        self.tiers = [old, recent]

    @staticmethod
    def _merged(one, other):
        keys, slots = np.append(one[0], other[0]), np.append(one[1], other[1])
        order = np.argsort(keys, kind="stable")
        return keys[order], slots[order]

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, offsets of each row in them)."""
        if not self.spaces:
            texts = Texts(LOWER[texts.data], texts.offsets)
        starts, ends = self._cut(texts)
        if len(starts) == 0:
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        keys, at, inverse = np.unique(texts.span_hashes(starts, ends), return_index=True, return_inverse=True)
        if len(self.count) + len(keys) > MAX_CACHED:
            self._clear()
        slots = self._look_up(keys)
        new = np.flatnonzero(slots < 0)
        if len(new):
            raw = texts.data.tobytes()
            chunks = [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[at[new]], ends[at[new]])]
            self._add(keys[new], *self._encode_chunks(chunks))
            slots = self._look_up(keys)
        own = slots[inverse]
        count = self.count[own]
        totals = np.zeros(len(count) + 1, np.int64)
        np.cumsum(count, out=totals[1:])
        return self.pool[ragged(self.first[own], count)], totals[np.searchsorted(starts, texts.offsets)]


_loaded: dict[tuple[str, bool], Subwords] = {}


def subwords(path: str, spaces: bool) -> Subwords:
    """One encoder for each file and worker process."""
    key = (path, spaces)
    if key not in _loaded:
        _loaded[key] = Subwords(path, spaces)
    return _loaded[key]


def with_end(ids: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Appends the id ``end`` to every row."""
    return np.insert(ids, offsets[1:], end), offsets + np.arange(len(offsets))
