"""Counting of item pairs in numpy, for ``mapInArrow``: batches in, batches out, in bounded steps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pairs held at once, and values of one step that cuts baskets.
STEP = 1 << 19
#: Products summed at once: few enough for the cache, as they are sorted.
PRODUCTS = 1 << 18
#: Rows of an emitted batch.
EMITTED = 100_000
CELL_COLUMNS = ["cell", "grps", "sizes", "left", "others", "right"]


def _packed(values: np.ndarray) -> bytes:
    """Numbers below 2**32 as two planes of 16 bits, of which the upper one compresses well."""
    return values.astype("<u4").view("<u2").reshape(-1, 2).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    low, high = np.frombuffer(data, "<u2").reshape(2, -1)
    return low.astype(np.int32) | (high.astype(np.int32) << 16)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def steps(weights: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs of ``weights`` that sum to about ``most``; one weight at least."""
    ends, start = np.cumsum(weights), 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield start, end
        start = end


def cell_of(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Number of the cell of two parts, ``low <= high``."""
    return high * (high + 1) // 2 + low


def cell_rows(parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From baskets (grp, nos): rows (cell, grps, sizes, left, others, right), one of each cell and batch.

    A number belongs to part ``no % parts``, where it is ``no // parts``. A cell of two parts gets what each basket has of
    either, ``sizes`` and ``others`` of them at a time; a cell of one part gets its numbers once. ``grps`` has the group of
    each basket.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, grps = batch.column("nos"), batch.column("grp").to_numpy(zero_copy_only=False)
            lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            place = np.repeat(np.arange(len(lengths)), lengths) * parts + flat % parts
            order = np.argsort(place)
            place, local = place[order], (flat // parts)[order].astype(np.int32)
            first = np.flatnonzero(np.diff(place, prepend=-1))
            size = np.diff(np.append(first, len(place)))
            basket, part = np.divmod(place[first], parts)
            last = np.searchsorted(basket, basket, "right")
            many = last - np.arange(len(first))
            sums = np.concatenate([[0], np.cumsum(size)])
            for a, b in steps(many * size + sums[last] - sums[:-1], 4 * STEP):
                left = np.repeat(np.arange(a, b), many[a:b])
                right = ranges(np.arange(a, b), many[a:b])
                met = (left != right) | (size[left] > 1)
                left, right = left[met], right[met]
                cell = cell_of(part[left], part[right])
                by_cell = np.argsort(cell, kind="stable")
                cell, left, right = cell[by_cell], left[by_cell], right[by_cell]
                begins = np.flatnonzero(np.diff(cell, prepend=-1))
                out = []
                for s, e in zip(begins, [*begins[1:], len(cell)]):
                    mine, other = left[s:e], right[s:e]
                    same = mine[0] == other[0]
                    row = [int(cell[s]), _packed(grps[basket[mine]]), _packed(size[mine]), _packed(local[ranges(first[mine], size[mine])])]
                    out.append([*row, b"", b""] if same else [
                        *row, _packed(size[other]), _packed(local[ranges(first[other], size[other])])])
                cells, *data = zip(*out) if out else [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells, pa.int32()), *[pa.array(d, pa.binary()) for d in data]], CELL_COLUMNS)

    return run


def pair_counts(
    left: np.ndarray, sizes: np.ndarray, right: np.ndarray, others: np.ndarray, ordered: bool, own: np.ndarray | None = None,
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(a, b, n) by steps: how often each a of ``left`` meets each b of ``right`` in rows of ``sizes`` and ``others`` values.
    ``ordered`` leaves only a < b, or ``own[a]`` < b where given. All counts of an a are in one step, so they are final."""
    order = np.argsort(left)
    row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[order]
    a, starts = left[order], np.cumsum(others) - others
    firsts = np.flatnonzero(np.diff(a, prepend=-1))
    pairs = np.add.reduceat(others[row].astype(np.int64), firsts) if len(firsts) else firsts
    ends = np.append(firsts, len(a))
    for s, e in steps(pairs, STEP):
        lo, hi = ends[s], ends[e]
        if pairs[s] > STEP:  # one item: its counts are added up
            found = np.zeros(int(right.max()) + 1, np.int64)
            for x, y in steps(others[row[lo:hi]], STEP):
                rows = row[lo + x:lo + y]
                found += np.bincount(right[ranges(starts[rows], others[rows])], minlength=len(found))
            least = (int(a[lo]) if own is None else int(own[a[lo]])) + 1 if ordered else 0
            b = np.flatnonzero(found[least:]) + least
            yield np.repeat(a[lo], len(b)), b, found[b]
            continue
        rows = row[lo:hi]
        b = right[ranges(starts[rows], others[rows])]
        key = (np.repeat(a[lo:hi].astype(np.int64), others[rows]) << 32) | b
        if ordered:
            mine = key >> 32
            key = key[(mine if own is None else own[mine]) < b]
        key.sort()
        at = np.flatnonzero(np.diff(key, prepend=-1))
        yield key[at] >> 32, key[at] & 0xFFFFFFFF, np.diff(np.append(at, len(key)))


def _names(chunks: list[tuple[pa.Array, pa.Array]]) -> pa.Array:
    """Names in the order of their numbers, which have no gaps."""
    order = np.argsort(np.concatenate([n.to_numpy(zero_copy_only=False) for n, _ in chunks]))
    return pa.concat_arrays([names for _, names in chunks]).take(pa.array(order))


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray], dict[int, list]]]:
    """(cell, its columns, names by side) of rows of ``cell_rows`` and, by ``side``, the names of its parts."""
    cells: dict[int, tuple[list, dict[int, list]]] = {}
    for batch in batches:
        numbers, side, named = batch.column("cell").to_pylist(), batch.column("side").to_pylist(), batch.column("names")
        for k, cell in enumerate(numbers):
            rows, names = cells.setdefault(cell, ([], {0: [], 1: []}))
            if side[k] is None:
                rows.append([_unpacked(batch.column(c)[k].as_buffer()) for c in CELL_COLUMNS[1:]])
            else:
                entries = named[k].values
                names[side[k]].append((entries.field(0), entries.field(1)))
    for cell in list(cells):
        rows, names = cells.pop(cell)
        columns = [np.concatenate(x) for x in zip(*rows)]
        del rows
        if columns:
            yield cell, columns, names


def count_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(grp, item, other, cnt): every pair of a cell and a group."""
    for _, (grps, sizes, left, others, right), names in _cells(batches):
        mine = _names(names[0])
        other = _names(names[1]) if names[1] else mine
        if not names[1]:
            others, right = sizes, left
        # A number of each group and item that there is.
        units, left = np.unique(np.repeat(grps.astype(np.int64), sizes) * len(mine) + left, return_inverse=True)
        grp, own = np.divmod(units, len(mine))
        for a, b, n in pair_counts(left, sizes, right, others, not names[1], own):
            for s in range(0, len(a), EMITTED):
                at = a[s:s + EMITTED]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grp[at], pa.int32()), mine.take(pa.array(own[at])), other.take(pa.array(b[s:s + EMITTED])),
                     pa.array(n[s:s + EMITTED], pa.int64())], ["grp", "item", "other", "cnt"])


def _lists(no: np.ndarray, others: np.ndarray, cnts: np.ndarray, begins: np.ndarray, **more: np.ndarray) -> pa.RecordBatch:
    """(no, ..., others, cnts): the values from each of ``begins`` on up to the next."""
    ends = pa.array(np.append(begins, len(others)), pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(no[begins], pa.int32()), *[pa.array(m, pa.int32()) for m in more.values()],
         pa.ListArray.from_arrays(ends, pa.array(others, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(cnts, pa.int64()))],
        ["no", *more, "others", "cnts"])


def vector_parts(parts: int, min_cnt: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(no, others, cnts): of every cell the pairs counted more than ``min_cnt`` times over all groups, in both directions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, (_, sizes, left, others, right), names in _cells(batches):
            high = next(h for h in range(parts) if cell < (h + 1) * (h + 2) // 2)
            low = cell - high * (high + 1) // 2
            if low == high:
                others, right = sizes, left
            for a, b, n in pair_counts(left, sizes, right, others, low == high):
                kept = n > min_cnt
                a, b, n = a[kept] * parts + low, b[kept] * parts + high, n[kept]
                if len(a):
                    yield _lists(a, b, n, np.flatnonzero(np.diff(a, prepend=-1)))
                    order = np.argsort(b)
                    a, b, n = a[order], b[order], n[order]
                    yield _lists(b, a, n, np.flatnonzero(np.diff(b, prepend=-1)))

    return run


def whole_vectors(limit: int | None, block: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(no, n, at, others, cnts): the parts of each item's vector as one, the largest counts first, then the smaller numbers,
    up to ``limit``; in lists of ``block`` at most, of which ``at`` partners come before, of ``n`` in all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [[], [], []]
        for batch in batches:
            lists = batch.column("others")
            found[0].append(np.repeat(batch.column("no").to_numpy(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)))
            found[1].append(lists.flatten().to_numpy())
            found[2].append(batch.column("cnts").flatten().to_numpy())
        if not found[0]:
            return
        no, others, cnts = (np.concatenate(x) for x in found)
        order = np.lexsort((others, -cnts, no))
        no, others, cnts = no[order], others[order], cnts[order]
        first = np.flatnonzero(np.diff(no, prepend=-1))
        size = np.diff(np.append(first, len(no)))
        if limit is not None and len(size):
            kept = ranges(first, np.minimum(size, limit))
            no, others, cnts, size = no[kept], others[kept], cnts[kept], np.minimum(size, limit)
        ends = np.cumsum(size)
        place = np.arange(len(no)) - np.repeat(ends - size, size)
        at = np.flatnonzero(place % block == 0)
        n = np.repeat(size, size)[at]
        for s in range(0, len(at), EMITTED // 100):
            mine = at[s:s + EMITTED // 100]
            end = at[s + len(mine)] if s + len(mine) < len(at) else len(no)
            lo = mine[0]
            yield _lists(no[lo:end], others[lo:end], cnts[lo:end], mine - lo, n=n[s:s + len(mine)], at=place[mine])

    return run


def _joined(found: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate(found) if found else np.zeros(0, kind)


def _first_places(sums: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` largest sums, equal ones in their order."""
    if len(sums) > top:
        last = np.partition(sums, len(sums) - top)[len(sums) - top]
        above = np.flatnonzero(sums > last)
        places = np.concatenate([above, np.flatnonzero(sums == last)[:top - len(above)]])
    else:
        places = np.arange(len(sums))
    return places[np.lexsort((places, -sums[places]))]


def summed_products(top: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(uno, no, milli, rank) from rows (takers, others, cnts, held): every taker's ``milli`` times the counts, summed by other
    item; those ``held`` for the taker are left out. Only the ``top`` largest of a user, equal ones by number, or all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unos, millis, rows, lengths, all_others, all_cnts, holds, seen = [], [], [], [], [], [], [], 0
        for batch in batches:
            takers, others = batch.column("takers"), batch.column("others")
            taken = takers.flatten()
            unos.append(taken.field(0).to_numpy())
            millis.append(taken.field(1).to_numpy())
            rows.append(np.repeat(np.arange(seen, seen + len(takers)), pc.list_value_length(takers).to_numpy(zero_copy_only=False)))
            lengths.append(pc.list_value_length(others).to_numpy(zero_copy_only=False))
            all_others.append(others.flatten().to_numpy())
            all_cnts.append(batch.column("cnts").flatten().to_numpy())
            holds.append(batch.column("held").to_numpy(zero_copy_only=False))
            seen += len(takers)
        uno, milli, row = _joined(unos, np.int64), _joined(millis, np.int64), _joined(rows, np.int64)
        length, other, cnt = _joined(lengths, np.int64).astype(np.int64), _joined(all_others, np.int32), _joined(all_cnts, np.int64)
        del unos, millis, rows, lengths, all_others, all_cnts
        held = _joined(holds, bool).astype(bool)[row]
        people, user = np.unique(uno, return_inverse=True)
        start = np.cumsum(length) - length

        def keyed(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Key of user and other for each product of ``places``, and where it is among the counts."""
            at = ranges(start[row[places]], length[row[places]])
            return (np.repeat(user[places].astype(np.int64) << 32, length[row[places]])) | other[at], at

        barred = np.unique(keyed(np.flatnonzero(held))[0])
        wanted = np.flatnonzero(~held)
        wanted = wanted[np.argsort(user[wanted])]
        if not len(wanted):
            return
        firsts = np.flatnonzero(np.diff(user[wanted], prepend=-1))
        ends = np.append(firsts, len(wanted))
        for s, e in steps(np.add.reduceat(length[row[wanted]], firsts), PRODUCTS):
            places = wanted[ends[s]:ends[e]]
            key, at = keyed(places)
            made = cnt[at] * np.repeat(milli[places], length[row[places]])
            order = np.argsort(key)
            key, made = key[order], made[order]
            begins = np.flatnonzero(np.diff(key, prepend=-1))
            if not len(begins):
                continue
            sums, key = np.add.reduceat(made, begins), key[begins]
            if len(barred):
                free = barred[np.minimum(np.searchsorted(barred, key), len(barred) - 1)] != key
                sums, key = sums[free], key[free]
            who = key >> 32
            rank = np.zeros(len(key), np.int32)
            if top is not None:
                bounds = np.append(np.flatnonzero(np.diff(who, prepend=-1)), len(who))
                chosen = [lo + _first_places(sums[lo:hi], top) for lo, hi in zip(bounds[:-1], bounds[1:])]
                rank = _joined([np.arange(1, len(c) + 1) for c in chosen], np.int64)
                kept = _joined(chosen, np.int64)
                sums, key, who = sums[kept], key[kept], who[kept]
            yield pa.RecordBatch.from_arrays(
                [pa.array(people[who], pa.int64()), pa.array(key & 0xFFFFFFFF, pa.int32()), pa.array(sums, pa.int64()),
                 pa.array(rank, pa.int32())], ["uno", "no", "milli", "rank"])

    return run


def ranked_others(unit: list[str], top: int, min_score: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(unit..., other, score, rank) from rows (unit..., low, high, others): how often each unit meets each other, twice that where
    it is from ``low`` to ``high``; above ``min_score`` the ``top`` largest of a unit, equal ones by number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, lists, sizes = {c: [] for c in (*unit, "low", "high")}, [], []
        for batch in batches:
            for c, values in found.items():
                values.append(pc.fill_null(batch.column(c), -1).to_numpy(zero_copy_only=False).astype(np.int64))
            lists.append(batch.column("others").flatten().to_numpy())
            sizes.append(pc.list_value_length(batch.column("others")).to_numpy(zero_copy_only=False))
        other, size = _joined(lists, np.int32), _joined(sizes, np.int64).astype(np.int64)
        columns = {c: _joined(values, np.int64) for c, values in found.items()}
        start = np.cumsum(size) - size
        order = np.lexsort([columns[c] for c in unit])
        if not len(order):
            return
        change = np.zeros(len(order), bool)
        change[0] = True
        for c in unit:
            values = columns[c][order]
            change[1:] |= values[1:] != values[:-1]
        firsts = np.flatnonzero(change)
        ends, heads = np.append(firsts, len(order)), order[firsts]
        for s, e in steps(np.add.reduceat(size[order], firsts), PRODUCTS):
            rows = order[ends[s]:ends[e]]
            number = np.repeat(np.arange(s, e), np.diff(ends[s:e + 1]))
            key = (np.repeat(number, size[rows]) << 32) | other[ranges(start[rows], size[rows])]
            key.sort()
            at = np.flatnonzero(np.diff(key, prepend=-1))
            count, key = np.diff(np.append(at, len(key))), key[at]
            who, met = heads[key >> 32], key & 0xFFFFFFFF
            score = count * np.where((met >= columns["low"][who]) & (met <= columns["high"][who]), 2, 1)
            kept = score > min_score
            score, who, met = score[kept], who[kept], met[kept]
            if not len(who):
                continue
            bounds = np.append(np.flatnonzero(np.append(True, who[1:] != who[:-1])), len(who))
            chosen = [lo + _first_places(score[lo:hi], top) for lo, hi in zip(bounds[:-1], bounds[1:])]
            rank = np.concatenate([np.arange(1, len(c) + 1) for c in chosen])
            chosen = np.concatenate(chosen)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(columns[c][who[chosen]], pa.int64()) for c in unit], pa.array(met[chosen], pa.int64()),
                 pa.array(score[chosen], pa.int64()), pa.array(rank, pa.int32())], [*unit, "other", "score", "rank"])

    return run
