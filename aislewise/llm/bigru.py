"""Toxicity: bidirectional gated recurrent network with attention pooling, in numpy.

Words (runs of letters and digits, A-Z lower-cased) enter as a word embedding beside the mean
embedding of all their hashed character n-grams. Runs over ``PIECE_BYTES`` are cut into words
of that size that overlap by half; in scripts without spaces every two characters in a row are
a word. No byte of a run is left out. The network reads overlapping windows of
``WINDOW`` words, one every ``STRIDE``, in both directions; attention pools the states. A
document's score is that of its worst window, calibrated on training documents.

Training takes at most ``TRAIN_DOCS`` labelled texts, half of them toxic where there are
as many, in the order of a hash of their ids. Its model has bounds too: embeddings of the ``VOCABULARY``
most frequent words (others enter by their n-grams alone), and ``EPOCH_WINDOWS`` windows an epoch, of which the worst
window of every text is one. All windows of all texts are scored. Embeddings start from log odds, and a toxic document trains the window
that the network finds worst.

Defined cases: a null text is empty; a text without words scores 0; rows with a null label
are no training rows; without training rows of both classes every score is 0; repeated rows
are scored alike; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislewise.llm.scratch import Scratch
from aislewise.llm.ship import map_batches
from aislewise.llm.subwords import ragged
from aislewise.llm.textbatch import Texts, Words, distinct, find_runs, mix, slices

WINDOW = 32
STRIDE = 16
TRAIN_DOCS = 3000
VOCABULARY = 20_000
MIN_DOCS = 3
CHAR_SLOTS = 1 << 14
DIM = 8
HIDDEN = 8
ATTEND = 8
EPOCHS = 5
SURE = 1.5
EMBED_RATE = 0.05
CALIBRATE_ON = 4  # every so many-th training document only calibrates the scores
EPOCH_WINDOWS = 12_000
BATCH = 256
RATE = 0.01
PIECE_BYTES = 24
GRAMS = (3, 4, 5)

_CODES = np.arange(256)
_INSIDE = ((_CODES >= 48) & (_CODES <= 57)) | ((_CODES >= 65) & (_CODES <= 90)) | ((_CODES >= 97) & (_CODES <= 122)) | (_CODES >= 128)


def unspaced(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to characters of scripts written without spaces, such as Thai, Khmer, Han and Kana."""
    if not (data >= 0xE0).any():
        return np.zeros(len(data), bool)
    lead = (data & 0xC0) != 0x80
    second = np.append(data[1:], 0).astype(np.uint8)
    own = (data == 0xE0) & (second >= 0xB8)  # Thai, Lao, Tibetan
    own |= (data == 0xE1) & ((second <= 0x82) | (second == 0x9E) | (second == 0x9F))  # Myanmar, Khmer
    own |= (data == 0xE2) & (second >= 0xBA) | (data >= 0xE3) & (data <= 0xE9)  # radicals, Kana, Han
    own |= (data == 0xEF) & (second >= 0xA4) & (second <= 0xBE) | (data == 0xF0) & (second >= 0xA0)
    at = np.flatnonzero(lead)
    return own[at[np.maximum(np.cumsum(lead) - 1, 0)]] if len(at) else own


def pieces(data: np.ndarray, runs: Words) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the runs; of those over ``PIECE_BYTES``, pieces that overlap by half."""
    length = runs.ends - runs.starts
    count = np.where(length > PIECE_BYTES, -(-(length - PIECE_BYTES) // (PIECE_BYTES // 2)) + 1, 1)
    owner = np.repeat(np.arange(len(count)), count)
    starts = runs.starts[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * (PIECE_BYTES // 2)
    return starts, np.minimum(np.where(length[owner] > PIECE_BYTES, starts + PIECE_BYTES, runs.ends[owner]), runs.ends[owner])


def pairs(data: np.ndarray, runs: Words) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of each two characters in a row of the runs, and of runs of one."""
    begins = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    first, last = np.searchsorted(begins, runs.starts, "right") - 1, np.searchsorted(begins, runs.ends)
    count = np.maximum(last - first - 1, 1)
    at = ragged(first, count)
    return begins[at], np.minimum(begins[np.minimum(at + 2, len(begins) - 1)], np.repeat(runs.ends, count))


def words_of(texts: Texts):
    """(lower-cased texts, their words, hash of each word)."""
    texts = texts.lowered()
    inside, dense = _INSIDE[texts.data], unspaced(texts.data)
    parts = [pieces(texts.data, find_runs(texts, inside & ~dense))]
    if dense.any():
        parts.append(pairs(texts.data, find_runs(texts, inside & dense)))
    starts, ends = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    words = Words(starts, ends, np.searchsorted(starts, texts.offsets))
    return texts, words, texts.span_hashes(words.starts, words.ends)


def character_slots(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slot of each n-gram, word it is in) of words between boundary marks."""
    total = ends - starts + 2
    first = np.cumsum(total) - total
    marked = np.zeros(int(total.sum()), np.uint64)
    marked[first], marked[first + total - 1] = 1, 2
    owner = np.repeat(np.arange(len(starts), dtype=np.int32), total)
    place = np.arange(len(marked)) - first[owner]
    letters = (place > 0) & (place < total[owner] - 1)
    marked[letters] = data[ragged(starts, ends - starts)]
    slots, owners = [], []
    for n in GRAMS:
        size = max(len(marked) - n + 1, 0)
        value = np.full(size, n, np.uint64)
        for k in range(n):
            value = value * np.uint64(1_000_003) + marked[k:size + k]
        inside = place[:size] + n <= total[owner[:size]]
        owners.append(owner[:size][inside])
        slots.append((mix(value[inside]) % np.uint64(CHAR_SLOTS)).astype(np.int32))
    return np.concatenate(slots), np.concatenate(owners)


@dataclass
class Network:
    vocabulary: np.ndarray  # sorted word hashes; word k has row k + 1 of ``words``, others row 0
    weights: dict[str, np.ndarray] = field(default_factory=dict)
    slope: float = 1.0
    shift: float = 0.0

    def word_rows(self, hashes: np.ndarray) -> np.ndarray:
        if len(self.vocabulary) == 0:
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)


def window_starts(n: int) -> np.ndarray:
    """Starts of overlapping windows that cover ``n`` words; the last one ends with them."""
    if n == 0:
        return np.zeros(0, np.int64)
    return np.arange(0, max(n - WINDOW, 0) + STRIDE, STRIDE) if n > WINDOW else np.zeros(1, np.int64)


def layout(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word places of each window, mask, row of each window) from word offsets of rows."""
    starts, owner, stop = [], [], []
    for i, (low, high) in enumerate(zip(rows[:-1].tolist(), rows[1:].tolist())):
        own = low + window_starts(high - low)
        own = own[own < high]
        starts.append(own)
        owner.append(np.full(len(own), i))
        stop.append(np.full(len(own), high))
    first = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    place = first[:, None] + np.arange(WINDOW)
    mask = place < (np.concatenate(stop) if stop else first)[:, None]
    return np.where(mask, place, 0).astype(np.int32), mask, np.concatenate(owner) if owner else first


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def recur(gates: np.ndarray, mask: np.ndarray, u: np.ndarray, backward: bool, keep: bool = False):
    """States (step, window, HIDDEN) of one direction; ``gates`` are (step, window, 3 HIDDEN)."""
    steps, n = mask.shape[1], mask.shape[0]
    h = np.zeros((n, HIDDEN), np.float32)
    out, tape = np.zeros((steps, n, HIDDEN), np.float32), []
    for t in range(steps - 1, -1, -1) if backward else range(steps):
        m = mask[:, t:t + 1]
        a = h @ u
        zr = sigmoid(gates[t][:, :2 * HIDDEN] + a[:, :2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        c = np.tanh(gates[t][:, 2 * HIDDEN:] + r * a[:, 2 * HIDDEN:])
        new = np.where(m, h + z * (c - h), h)
        if keep:
            tape.append((t, h, z, r, c, a[:, 2 * HIDDEN:], m))
        h = new
        out[t] = h
    return out, tape


def recur_back(grad: np.ndarray, tape: list, u: np.ndarray):
    """Gradients of the gates and of ``u``."""
    gates, du = np.zeros((len(grad), grad.shape[1], 3 * HIDDEN), np.float32), np.zeros_like(u)
    dh = np.zeros(grad.shape[1:], np.float32)
    for t, h, z, r, c, a, m in reversed(tape):
        dh = dh + grad[t]
        live = dh * m
        dc = live * z * (1 - c * c)
        dz = live * (c - h) * z * (1 - z)
        dr = dc * a * r * (1 - r)
        da = np.concatenate([dz, dr, dc * r], axis=1)
        gates[t] = np.concatenate([dz, dr, dc], axis=1)
        du += h.T @ da
        dh = dh * (1 - m) + live * (1 - z) + da @ u.T
    return gates, du


def pool(states: np.ndarray, mask: np.ndarray, w: dict):
    """Attention over the states (step, window, 2 HIDDEN): pooled states, shares, projections."""
    hidden = np.tanh(states @ w["attend"])
    energy = np.where(mask.T, hidden @ w["query"], -1e9)
    share = np.exp(energy - energy.max(axis=0))
    share /= share.sum(axis=0)
    return (share[:, :, None] * states).sum(axis=0), share, hidden


def window_logits(inputs: np.ndarray, place: np.ndarray, mask: np.ndarray, w: dict) -> np.ndarray:
    """Logit of each window; ``inputs`` are the words' vectors."""
    out = np.zeros(len(place), np.float32)
    forward, backward = inputs @ w["in_f"] + w["b_f"], inputs @ w["in_b"] + w["b_b"]
    for low in range(0, len(place), 4096):
        p, m = place[low:low + 4096].T, mask[low:low + 4096]
        f, _ = recur(forward[p], m, w["u_f"], False)
        b, _ = recur(backward[p], m, w["u_b"], True)
        out[low:low + 4096] = pool(np.concatenate([f, b], axis=2), m, w)[0] @ w["out"] + w["bias"]
    return out


def word_inputs(rows: np.ndarray, slots: np.ndarray, owners: np.ndarray, w: dict) -> np.ndarray:
    """Vectors of words from their embedding rows and character slots."""
    count = np.maximum(np.bincount(owners, minlength=len(rows)), 1)
    # Slots come n-gram length by n-gram length; sums go per dimension.
    chars = np.stack([np.bincount(owners, w["chars"][slots, k], len(rows)) for k in range(DIM)], axis=1) / count[:, None]
    return np.concatenate([w["words"][rows], chars], axis=1).astype(np.float32)


class Trainer:
    """Fits a network on texts and their labels."""

    def __init__(self, texts: list[str], labels: np.ndarray, seed: int = 7):
        self.rng = np.random.default_rng(seed)
        self.labels = labels.astype(np.float64)
        # Documents that only calibrate have no part in odds and training windows.
        self.fitted = np.ones(len(labels), bool)
        for label in (0, 1):
            self.fitted[np.flatnonzero(labels == label)[CALIBRATE_ON - 1::CALIBRATE_ON]] = False
        hashes, rows, slots, owners, base = [], [0], [], [], 0
        lookup: dict[int, int] = {}
        ids = []
        for _, _, part in slices(pa.array(texts, pa.large_string())):
            low, words, own = words_of(part)
            values, first, inverse = np.unique(own, return_index=True, return_inverse=True)
            fresh = [k for k, v in enumerate(values.tolist()) if v not in lookup]
            if fresh:
                s, o = character_slots(low.data, words.starts[first[fresh]], words.ends[first[fresh]])
                slots.append(s)
                owners.append(o + np.int32(base))
                for k in fresh:
                    lookup[int(values[k])] = base
                    hashes.append(values[k])
                    base += 1
            number = np.array([lookup[v] for v in values.tolist()], np.int64)
            ids.append(number[inverse].astype(np.int32) if len(own) else np.zeros(0, np.int32))
            rows.extend((rows[-1] + words.rows[1:]).tolist())
        self.ids = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        self.rows = np.array(rows)
        self.hashes = np.array(hashes, np.uint64)
        owner = np.concatenate(owners) if owners else np.zeros(0, np.int32)
        self.slots = (np.concatenate(slots) if slots else owner)[np.argsort(owner, kind="stable")]
        self.slot_ends = np.append(0, np.cumsum(np.bincount(owner, minlength=len(self.hashes))))
        self.place, self.mask, self.owner = layout(self.rows)

    def _odds(self, units: np.ndarray, docs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(log odds of a unit in toxic documents less ``SURE`` standard errors, documents that hold it)."""
        fitted = self.fitted[docs]
        units = units.astype(np.int64)
        pairs = distinct(units[fitted] * np.int64(len(self.labels)) + docs[fitted])
        unit, doc = pairs // len(self.labels), pairs % len(self.labels)
        toxic = np.bincount(unit, self.labels[doc], n)
        total = np.bincount(unit, minlength=n)
        return self.sure_odds(toxic, total), total

    def sure_odds(self, toxic: np.ndarray, total: np.ndarray) -> np.ndarray:
        t, c = self.labels[self.fitted].sum(), (1 - self.labels[self.fitted]).sum()
        odds = np.log((toxic + 0.5) / (t + 1)) - np.log((total - toxic + 0.5) / (c + 1))
        error = np.sqrt(1 / (toxic + 0.5) + 1 / (total - toxic + 0.5))
        return np.sign(odds) * np.maximum(np.abs(odds) - SURE * error, 0)

    def slots_of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(character slots of ``words``, place in ``words`` of each)."""
        first, count = self.slot_ends[words], np.diff(self.slot_ends)[words]
        return self.slots[ragged(first, count)], np.repeat(np.arange(len(words)), count)

    def start(self) -> Network:
        doc_of = np.repeat(np.arange(len(self.labels)), np.diff(self.rows))
        odds, seen = self._odds(self.ids, doc_of, len(self.hashes))
        frequent = np.flatnonzero(seen >= MIN_DOCS)
        frequent = frequent[np.argsort(-seen[frequent], kind="stable")[:VOCABULARY]]
        frequent = frequent[np.argsort(self.hashes[frequent])]
        network = Network(self.hashes[frequent])
        # Character n-grams of a document: those of its distinct words.
        toxic, char_seen = np.zeros(CHAR_SLOTS), np.zeros(CHAR_SLOTS)
        for doc in np.flatnonzero(self.fitted):
            slots, _ = self.slots_of(distinct(self.ids[self.rows[doc]:self.rows[doc + 1]]))
            held = distinct(slots)
            char_seen[held] += 1
            toxic[held] += self.labels[doc]
        char_odds = self.sure_odds(toxic, char_seen)

        def random(*shape: int, scale: float) -> np.ndarray:
            return self.rng.normal(0, scale, shape).astype(np.float32)

        words, chars = random(len(frequent) + 1, DIM, scale=0.1), random(CHAR_SLOTS, DIM, scale=0.1)
        words[0] = 0
        words[1:, 0] = odds[frequent]
        chars[:, 0] = np.where(char_seen >= MIN_DOCS, char_odds, 0)
        size = 2 * DIM
        network.weights = {
            "words": words, "chars": chars, "in_f": random(size, 3 * HIDDEN, scale=0.25), "in_b": random(size, 3 * HIDDEN, scale=0.25),
            "b_f": np.zeros(3 * HIDDEN, np.float32), "b_b": np.zeros(3 * HIDDEN, np.float32),
            "u_f": random(HIDDEN, 3 * HIDDEN, scale=0.3), "u_b": random(HIDDEN, 3 * HIDDEN, scale=0.3),
            "attend": random(2 * HIDDEN, ATTEND, scale=0.3), "query": random(ATTEND, scale=0.3),
            "out": random(2 * HIDDEN, scale=0.3), "bias": np.zeros((), np.float32),
        }
        # A window's first score: the worst word by its odds.
        word_odds = np.where(seen >= MIN_DOCS, odds, 0)
        self.first_scores = np.where(self.mask, word_odds[self.ids[self.place]] if len(self.ids) else 0, -9).max(axis=1)
        return network

    def doc_worst(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(worst score of each document, its window), -1 where there is none."""
        order = np.lexsort((scores, self.owner))
        last = np.searchsorted(self.owner[order], np.arange(len(self.labels)), "right") - 1
        ok = (last >= 0) & (self.owner[order[np.maximum(last, 0)]] == np.arange(len(self.labels))) if len(order) else np.zeros(len(self.labels), bool)
        window = np.where(ok, order[np.maximum(last, 0)] if len(order) else 0, -1)
        return np.where(ok, scores[window] if len(order) else 0, -30.0), window

    def step(self, network: Network, windows: np.ndarray, target: np.ndarray, weight: np.ndarray, state: dict) -> None:
        w = network.weights
        place, mask = self.place[windows], self.mask[windows]
        used, inverse = np.unique(self.ids[place], return_inverse=True)
        inverse = inverse.reshape(place.shape)
        slots, owners = self.slots_of(used)
        rows = self.table_rows[used]
        inputs = word_inputs(rows, slots, owners, w)
        x = inputs[inverse.T]
        f, tape_f = recur(x @ w["in_f"] + w["b_f"], mask, w["u_f"], False, True)
        b, tape_b = recur(x @ w["in_b"] + w["b_b"], mask, w["u_b"], True, True)
        states = np.concatenate([f, b], axis=2)
        pooled, share, hidden = pool(states, mask, w)
        error = ((sigmoid(pooled @ w["out"] + w["bias"]) - target) * weight / len(windows)).astype(np.float32)
        grads = {"out": pooled.T @ error, "bias": error.sum()}
        dpooled = error[:, None] * w["out"]
        dshare = (states * dpooled).sum(axis=2)
        denergy = share * (dshare - (share * dshare).sum(axis=0))
        grads["query"] = (hidden * denergy[:, :, None]).sum(axis=(0, 1))
        dhidden = denergy[:, :, None] * w["query"] * (1 - hidden * hidden)
        grads["attend"] = np.einsum("twi,twj->ij", states, dhidden, optimize=True)
        dstates = share[:, :, None] * dpooled + dhidden @ w["attend"].T
        dinputs = np.zeros_like(x)
        for name, tape, part in (("f", tape_f, dstates[:, :, :HIDDEN]), ("b", tape_b, dstates[:, :, HIDDEN:])):
            gates, grads[f"u_{name}"] = recur_back(part, tape, w[f"u_{name}"])
            grads[f"in_{name}"] = np.einsum("twi,twj->ij", x, gates, optimize=True)
            grads[f"b_{name}"] = gates.sum(axis=(0, 1))
            dinputs += gates @ w[f"in_{name}"].T
        dinputs *= mask.T[:, :, None]
        per_word = np.zeros_like(inputs)
        np.add.at(per_word, inverse.T.ravel(), dinputs.reshape(-1, inputs.shape[1]))
        state["t"] += 1
        for name, grad in grads.items():
            m, v = state.setdefault(name, [np.zeros_like(grad), np.zeros_like(grad)])
            m = state[name][0] = 0.9 * m + 0.1 * grad
            v = state[name][1] = 0.99 * v + 0.01 * grad * grad
            step = RATE * (m / (1 - 0.9 ** state["t"])) / (np.sqrt(v / (1 - 0.99 ** state["t"])) + 1e-8)
            w[name] = (w[name] - step).astype(np.float32)
        np.add.at(w["words"], rows, -EMBED_RATE * per_word[:, :DIM])
        w["words"][0] = 0
        count = np.maximum(np.bincount(owners, minlength=len(used)), 1)
        np.add.at(w["chars"], slots, -EMBED_RATE * (per_word[:, DIM:] / count[:, None])[owners])

    def all_scores(self, weights: dict) -> np.ndarray:
        """Logits of all windows, in runs of words and windows that bound the memory."""
        inputs = np.zeros((len(self.hashes), 2 * DIM), np.float32)
        for low in range(0, len(inputs), 20_000):
            own = np.arange(low, min(low + 20_000, len(inputs)))
            inputs[own] = word_inputs(self.table_rows[own], *self.slots_of(own), weights)
        return window_logits(inputs, self.ids[self.place], self.mask, weights).astype(np.float64)

    def calibrated(self, worst: np.ndarray) -> tuple[float, float]:
        spare = ~self.fitted
        enough = spare.any() and 0 < self.labels[spare].sum() < spare.sum()
        return calibrate(worst[spare], self.labels[spare]) if enough else calibrate(worst, self.labels)

    def fit(self, prior: float | None = None) -> Network | None:
        """``prior``: share of toxic documents to calibrate for, else that of the given ones."""
        if self.labels.sum() < 1 or (1 - self.labels).sum() < 1 or len(self.place) == 0:
            return None
        network = self.start()
        self.table_rows = network.word_rows(self.hashes)
        state: dict = {"t": 0}
        scores = self.first_scores.astype(np.float64)
        clean = np.flatnonzero((self.labels[self.owner] == 0) & self.fitted[self.owner])
        toxic_docs = np.flatnonzero((self.labels == 1) & self.fitted)
        for _ in range(EPOCHS):
            worst, window = self.doc_worst(scores)
            positive = window[toxic_docs]
            positive = positive[positive >= 0]
            hard = window[(self.labels == 0) & self.fitted & (window >= 0)]
            room = max(BATCH, min(EPOCH_WINDOWS, 8 * len(positive)) - len(hard))
            spare = self.rng.choice(clean, min(len(clean), room), replace=False) if len(clean) else clean
            copies = max(1, min(20, EPOCH_WINDOWS // (4 * max(1, len(positive)))))
            chosen = np.concatenate([np.repeat(positive, copies), hard, spare])
            target = np.zeros(len(chosen))
            target[:len(positive) * copies] = 1
            order = self.rng.permutation(len(chosen))
            for low in range(0, len(order), BATCH):
                at = order[low:low + BATCH]
                self.step(network, chosen[at], target[at], np.ones(len(at)), state)
            scores = self.all_scores(network.weights)
        network.slope, network.shift = self.calibrated(self.doc_worst(scores)[0])
        if prior is not None:
            share = self.labels.mean()
            network.shift += float(np.log(prior / (1 - prior)) - np.log(share / (1 - share)))
        return network


def calibrate(logits: np.ndarray, labels: np.ndarray, rounds: int = 200) -> tuple[float, float]:
    """Slope and shift of a logistic fit of labels on documents' worst logits."""
    center, scale = logits.mean(), logits.std() + 1e-6
    x, a, b = (logits - center) / scale, 1.0, 0.0
    target = np.where(labels == 1, 1 - 1 / (labels.sum() + 2), 1 / ((1 - labels).sum() + 2))
    for _ in range(rounds):
        p = sigmoid(a * x + b)
        weight = np.maximum(p * (1 - p), 1e-6)
        g = np.array([((p - target) * x).sum() + 1e-2 * a, (p - target).sum()])
        h = np.array([[(weight * x * x).sum() + 1e-2, (weight * x).sum()], [(weight * x).sum(), weight.sum() + 1e-6]])
        move = np.clip(np.linalg.solve(h, g), -1, 1)
        a, b = a - move[0], b - move[1]
    return float(a / scale), float(b - a * center / scale)


def score_texts(texts: Texts, network: Network) -> np.ndarray:
    low, words, hashes = words_of(texts)
    scores = np.full(len(texts), -np.inf)
    if len(hashes):
        values, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        slots, owners = character_slots(low.data, words.starts[first], words.ends[first])
        inputs = word_inputs(network.word_rows(values), slots, owners, network.weights)
        place, mask, owner = layout(words.rows)
        np.maximum.at(scores, owner, window_logits(inputs, inverse[place], mask, network.weights))
    return np.where(np.isinf(scores), 0.0, sigmoid(network.slope * np.where(np.isinf(scores), 0, scores) + network.shift))


def score(docs: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) over all windows of all texts."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, texts in slices(batch.column(1)):
                own = score_texts(texts, network) if network else np.zeros(len(texts))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array(own)], ["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col), compute, f"id {kind}, score double")


def with_score(docs: DataFrame, network: Network | None, name: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the score of every row's text under ``name``; rows are judged one by one, whatever their ids."""
    at = docs.columns.index(text_col)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, texts in slices(batch.column(at)):
                own = score_texts(texts, network) if network else np.zeros(len(texts))
                yield batch.slice(low, high - low).append_column(name, pa.array(own))

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_batches(docs, compute, f"{columns}, `{name}` double")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          train_docs: int = TRAIN_DOCS) -> Network | None:
    """``labels`` are (id, label) of the training rows; at most ``train_docs`` labelled texts of ``docs`` are used.

    Labels are joined with the ids at hand before the sample is drawn, and a text counts once, however often its row is
    repeated. One task fits the network on the sample; only the weights reach the driver.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"))
    labelled = keyed.join(labels.where("label in (0, 1)"), "id").groupBy("id", "h", "label").agg(F.count(F.lit(1)).alias("n"))
    labelled = Scratch(docs.sparkSession, "labelled").save(labelled)
    seen = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    if not seen.get(0) or not seen.get(1):
        return None
    prior = (seen[1] + 1) / (seen[0] + seen[1] + 2)
    chosen = None
    for label in (1, 0):
        part = labelled.where(F.col("label") == label).orderBy(F.xxhash64("id"), "h").limit(train_docs // 2)
        chosen = part if chosen is None else chosen.unionByName(part)
    own = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))
    sample = own.join(F.broadcast(chosen.select("id", "h", "label")), ["id", "h"]).dropDuplicates(["id", "h", "label"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, targets = [], []
        for batch in batches:
            texts += batch.column(0).to_pylist()
            targets += batch.column(1).to_pylist()
        network = Trainer(texts, np.array(targets, np.int64)).fit(prior) if texts else None
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(network)], pa.binary())], ["network"])

    # ``train_docs`` rows at most, in one task; their order is fixed.
    ordered = sample.repartition(1).sortWithinPartitions("id", "h").select("text", "label")
    fitted = map_batches(ordered, fit, "network binary").collect()
    return pickle.loads(fitted[0]["network"]) if fitted else None
