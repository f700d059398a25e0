"""Binary code of words, and bit predictors over the words of a text.

The most frequent words are leaves of a Huffman tree, all others share one leaf, so that a token is some ten
binary decisions. Predictors hash a decision's node with nothing, the text's group, the word before, and the two words
before to counts of zeros and ones. Their stretched predictions are combined by weights that a gate (depth, and
which of the two word contexts were seen) selects; an adaptive map from (gate, quantised prediction) to
observed frequencies refines the result. At every node both bits have chances that sum to one, so all leaves do.

Tokens are taken in runs, longest codes first, and a run is predicted depth by depth: the tokens that go on are its first
ones, so that contexts and sums are slices, and nothing is repeated for each decision.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np

from aislewise.llm.subwords import ragged
from aislewise.llm.textbatch import mix

CODE_WORDS = (1 << 15) - 1
NODES = 1 << 15
ORDERS = 4
WORD_BITS = (20, 21)  # bits of the tables of one and two words before
DEPTHS = 8
GATES = 4 * DEPTHS
STEPS = 33
LEAST = np.float32(0.3)  # added to counts; a context seen once says less than one seen often
LEARN = 0.15
FORGET = 0.98
MAP_PRIOR = 16.0
STEP_TOKENS = 1 << 14  # tokens predicted between two updates of the weights
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def table_starts(groups: int) -> np.ndarray:
    """First slots of the tables of the predictors, and the number of all slots."""
    return np.cumsum([0, NODES, groups * NODES, *(1 << b for b in WORD_BITS)])


@dataclass
class WordCode:
    """``keys`` (sorted) have the leaves ``leaves``; the last leaf is that of all other words."""

    keys: np.ndarray
    leaves: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    nodes: np.ndarray
    bits: np.ndarray
    depths: np.ndarray

    @property
    def other(self) -> int:
        return len(self.keys)

    def leaf(self, words: np.ndarray) -> np.ndarray:
        if len(self.keys) == 0:
            return np.zeros(len(words), np.int32)
        at = np.minimum(np.searchsorted(self.keys, words), len(self.keys) - 1)
        return np.where(self.keys[at] == words, self.leaves[at], self.other).astype(np.int32)

    @cached_property
    def steps(self) -> list[np.ndarray]:
        """For each depth, 2 * node + bit of the leaves that go through it."""
        out = []
        for depth in range(int(self.lengths.max(initial=0))):
            own = np.flatnonzero(self.lengths > depth)
            at = self.starts[own] + depth
            out.append(np.zeros(len(self.lengths), np.int32))
            out[-1][own] = 2 * self.nodes[at] + self.bits[at]
        return out


def build_code(keys: np.ndarray, counts: np.ndarray, others: int) -> WordCode:
    """Huffman code of at most ``CODE_WORDS`` words and the leaf of the ``others`` tokens."""
    weights = [*counts.tolist(), max(int(others), 1)]
    heap = [(w, k) for k, w in enumerate(weights)]
    heapq.heapify(heap)
    children = []
    while len(heap) > 1:
        (a, left), (b, right) = heapq.heappop(heap), heapq.heappop(heap)
        heapq.heappush(heap, (a + b, len(weights) + len(children)))
        children.append((left, right))
    paths: list[list[tuple[int, int]]] = [[] for _ in weights]
    level, numbered = [(heap[0][1], [])], 0
    while level:  # nodes are numbered from the root down, so those met most are neighbours
        below = []
        for node, path in level:
            if node < len(weights):
                paths[node] = path
                continue
            for bit, child in enumerate(children[node - len(weights)]):
                below.append((child, [*path, (numbered, bit)]))
            numbered += 1
        level = below
    lengths = np.array([len(p) for p in paths], np.int64)
    flat = np.array([step for p in paths for step in p], np.int32).reshape(-1, 2)
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(keys)
    return WordCode(keys[order], order.astype(np.int32), starts, lengths, flat[:, 0].copy(), flat[:, 1].astype(np.uint8),
                    ragged(np.zeros(len(lengths), np.int64), lengths).astype(np.uint8))


@dataclass
class Tokens:
    """Tokens of texts: leaves, groups of their texts, and the hashed words before them."""

    leaf: np.ndarray
    group: np.ndarray
    one: np.ndarray
    two: np.ndarray

    def __len__(self) -> int:
        return len(self.leaf)

    def where(self, own: np.ndarray) -> Tokens:
        return Tokens(self.leaf[own], self.group[own], self.one[own], self.two[own])

    def runs(self) -> Iterator[tuple[int, int, Tokens]]:
        for low in range(0, len(self), STEP_TOKENS):
            high = min(len(self), low + STEP_TOKENS)
            yield low, high, self.where(slice(low, high))


def in_order(keys: np.ndarray, leaf: np.ndarray, group: np.ndarray, lengths: np.ndarray) -> Tokens:
    """Tokens of texts of ``lengths``; contexts do not cross texts."""
    begin = (np.cumsum(lengths) - lengths)[lengths > 0]
    one, two = np.ones(len(keys), np.uint64), np.ones(len(keys), np.uint64)
    one[1:], two[2:] = keys[:-1], keys[:-2]
    one[begin], two[begin], two[begin[lengths[lengths > 0] > 1] + 1] = 1, 1, 1
    return Tokens(leaf, group, mix(one), mix(one * np.uint64(0xD6E8FEB86659FD93) + two))


class Run:
    """Decisions of a run of tokens, depth by depth. ``order``: its tokens, longest codes first."""

    def __init__(self, code: WordCode, tokens: Tokens):
        n = code.lengths[tokens.leaf].astype(np.uint8)
        self.order = np.argsort(np.uint8(255) - n, kind="stable")
        self.steps = code.steps
        self.left = len(n) - np.cumsum(np.bincount(n, minlength=len(self.steps) + 1))  # tokens that go beyond a depth
        self.leaf = tokens.leaf[self.order].astype(np.int64)
        self.group = tokens.group[self.order].astype(np.int64) * NODES
        self.contexts = [c[self.order] * SPREAD for c in (tokens.one, tokens.two)]

    def __iter__(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(depth, number of tokens that go on, 2 * node + bit of each)."""
        for depth, n in enumerate(self.left[:len(self.steps)].tolist()):
            if n:
                yield depth, n, self.steps[depth].take(self.leaf[:n], mode="clip")

    def words_before(self, k: int, node: np.ndarray) -> np.ndarray:
        """Slots in the table of one (``k`` 0) or two (1) words before."""
        slot = node.astype(np.uint64)
        slot *= SPREAD
        slot += self.contexts[k][:len(node)]
        slot >>= np.uint64(64 - WORD_BITS[k])
        return slot.view(np.int64)


def decisions(code: WordCode, tokens: Tokens, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """(token, bit, depth, slots of every predictor) of all decisions of some tokens."""
    run = Run(code, tokens)
    found: list[list[np.ndarray]] = [[] for _ in range(3 + ORDERS)]
    for depth, n, step in run:
        node = step >> 1
        one, two = run.words_before(0, node), run.words_before(1, node)
        for held, part in zip(found, (run.order[:n], (step & 1).astype(np.uint8), np.full(n, depth, np.uint8), node.astype(np.int64),
                                      starts[1] + run.group[:n] + node, starts[2] + one, starts[3] + two)):
            held.append(part)
    token, bit, depths, *slots = (np.concatenate(f) if f else np.zeros(0, np.int64) for f in found)
    return token, bit, depths, slots


def count_decisions(code: WordCode, tokens: Tokens, counts: np.ndarray, groups: int) -> None:
    """Adds the zeros (first half) and ones (second half) of all slots."""
    starts = table_starts(groups)
    leaves = len(code.lengths)
    pairs = np.bincount(tokens.group * leaves + tokens.leaf, minlength=groups * leaves)
    met = np.flatnonzero(pairs)  # without words before, equal tokens of a group decide alike
    n = code.lengths[met % leaves]
    at = ragged(code.starts[met % leaves], n)
    node, bit, times = code.nodes[at].astype(np.int64), code.bits[at], np.repeat(pairs[met], n)
    for order, slot in ((0, node), (1, starts[1] + np.repeat(met // leaves, n) * NODES + node)):
        for b in (0, 1):
            own = slice(b * starts[-1] + starts[order], b * starts[-1] + starts[order + 1])
            found = np.bincount(slot[bit == b] - starts[order], times[bit == b], starts[order + 1] - starts[order])
            counts[own] += found.astype(counts.dtype)
    one = counts.dtype.type(1)
    for _, _, part in tokens.runs():
        run = Run(code, part)
        steps = [step for _, _, step in run]
        for k in range(len(WORD_BITS)):  # one table at a time, as its pages are soon all at hand
            for step in steps:
                slot = (step & 1) * starts[-1]
                slot += run.words_before(k, step >> 1)
                slot += starts[2 + k]
                np.add.at(counts, slot, one)


def bounded(x: np.ndarray, least: float, most: float) -> None:
    """``np.clip`` in place, without its cost on short arrays."""
    np.minimum(np.maximum(x, np.float32(least), out=x), np.float32(most), out=x)


def squash(x: np.ndarray) -> np.ndarray:
    out = np.negative(x)
    np.exp(out, out=out)
    out += 1
    return np.divide(1, out, out=out)


def stretched(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    odds = np.maximum(ones, 0) + LEAST
    odds /= np.maximum(zeros, 0) + LEAST
    return np.log(odds, out=odds)


class TextModel:
    """Predictors' counts, gated weights and the refining map."""

    def __init__(self, code: WordCode, counts: np.ndarray, groups: int, learning: bool = False,
                 weights: np.ndarray | None = None, cells: np.ndarray | None = None):
        self.code, starts, n = code, table_starts(groups), len(counts) // 2
        zeros, ones = counts[:n], counts[n:]
        self.learning = learning
        if learning:  # the coming bit's own count is taken out: a slot's entry if it is 0 is followed by that if it is 1
            both = np.empty((n, 2), np.float32)
            both[:, 0], both[:, 1] = stretched(zeros - 1, ones), stretched(zeros, ones - 1)
            self.tables = [both[a:b].ravel() for a, b in zip(starts[:-1], starts[1:])]
        else:
            plain = stretched(zeros, ones)
            self.tables = [plain[a:b] for a, b in zip(starts[:-1], starts[1:])]
        self.weights = np.full((GATES, ORDERS), 0.3) if weights is None else weights
        self.cells = np.zeros((2, GATES * STEPS)) if cells is None else cells
        self.curvature = np.full((GATES, ORDERS), 100.0)

    def refining(self) -> np.ndarray:
        """Observed frequencies of the map, a row of ``4 * STEPS`` for each depth."""
        prior = squash(np.arange(STEPS) / 2 - 8.0)
        table = (self.cells[1].reshape(GATES, STEPS) + MAP_PRIOR * prior) / (self.cells[0].reshape(GATES, STEPS) + MAP_PRIOR)
        return table.reshape(DEPTHS, -1).astype(np.float32)

    def met(self, order: int, run: Run, n: int, step: np.ndarray) -> np.ndarray:
        """Stretched predictions of an order for decisions of one depth."""
        node = step >> 1
        if order < 2:
            slot = node.astype(np.int64)
            if order:
                slot += run.group[:n]
        else:
            slot = run.words_before(order - 2, node)
        if self.learning:
            slot += slot
            slot += step & 1
        return self.tables[order].take(slot, mode="clip")

    def log_leaves(self, tokens: Tokens) -> np.ndarray:
        """Natural log probability of each token's leaf."""
        out = np.zeros(len(tokens))
        for low, high, part in tokens.runs():
            run = Run(self.code, part)
            logs, sums = np.zeros(high - low), Sums() if self.learning else None
            weights = np.ascontiguousarray(self.weights.T, np.float32).reshape(ORDERS, DEPTHS, 4)
            refining = self.refining()
            levels = list(run)  # one table at a time, as its pages are soon all at hand
            found = [[self.met(order, run, n, step) for _, n, step in levels] for order in range(ORDERS)]
            for (depth, n, step), *x in zip(levels, *found):
                d = min(depth, DEPTHS - 1)
                bit = (step & 1).astype(np.float32)
                seen = (x[3] != 0).view(np.int8)
                seen += seen
                seen += x[2] != 0
                seen = seen.astype(np.int64)
                mixed = weights[0, d].take(seen, mode="clip")
                mixed *= x[0]
                for order in range(1, ORDERS):
                    term = weights[order, d].take(seen, mode="clip")
                    term *= x[order]
                    mixed += term
                bounded(mixed, -15, 15)
                chance = squash(mixed)
                mixed += 8
                mixed *= 2
                bounded(np.rint(mixed, out=mixed), 0, STEPS - 1)
                cell = mixed.astype(np.int64)
                cell += STEPS * seen
                p = refining[d].take(cell, mode="clip")
                p += chance
                p /= 2
                own = np.abs(np.subtract(1 - bit, p, out=p), out=p)
                bounded(own, 1e-6, 1 - 1e-6)
                logs[:n] += np.log(own, out=own)
                if sums:
                    sums.add(d, bit, seen, x, chance, cell)
            out[low + run.order] = logs
            if sums:
                self.learn(sums)
        return out

    def learn(self, sums: Sums) -> None:
        self.curvature *= FORGET
        self.curvature += sums.curvature.reshape(GATES, ORDERS)
        self.weights += LEARN * sums.slope.reshape(GATES, ORDERS) / np.maximum(self.curvature, 1)
        zeros, ones = sums.cells.reshape(-1, 2).T
        self.cells[0] += zeros + ones
        self.cells[1] += ones


class Sums:
    """What a run teaches: by gate and order the slope and curvature of the loss, by cell of the map its bits."""

    def __init__(self):
        self.slope, self.curvature = np.zeros((DEPTHS, 4, ORDERS)), np.zeros((DEPTHS, 4, ORDERS))
        self.cells = np.zeros((DEPTHS, 8 * STEPS))

    def add(self, d: int, bit: np.ndarray, seen: np.ndarray, x: list[np.ndarray], chance: np.ndarray, cell: np.ndarray) -> None:
        error, spread = bit - chance, chance * (1 - chance)
        terms = np.empty((2 * ORDERS, len(bit)), np.float32)
        for order in range(ORDERS):
            np.multiply(error, x[order], out=terms[order])
            np.multiply(spread, x[order], out=terms[ORDERS + order])
            terms[ORDERS + order] *= x[order]
        most = int(np.argmax(np.bincount(seen)))  # of all four, the sums of this one are what the others leave
        rest = np.flatnonzero(seen != most)
        found = (seen[rest] == np.arange(4)[:, None]).astype(np.float64) @ terms[:, rest].astype(np.float64).T
        found[most] = terms.sum(axis=1, dtype=np.float64) - found.sum(axis=0)
        self.slope[d] += found[:, :ORDERS]
        self.curvature[d] += found[:, ORDERS:]
        cell *= 2
        cell += bit > 0
        self.cells[d] += np.bincount(cell, minlength=8 * STEPS)
