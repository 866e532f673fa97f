"""Near pairs of the texts of many cells, in numpy: keys, candidates and the exact measure stay in the task's memory.

Only rows of cells go in and only pairs that reach the threshold come out.  What a task holds at once is bounded: candidates are made
for a slice of the texts at a time, and all that one text finds is in its slice.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lifeloom.functions.similarity import FREQUENT, KEYS, PREFIX_LIMIT, PREFIX_SCALE, WHOLE, length_plan

#: Rows that are taken together at least (whole units); candidates, and pairs, made at once at most, beyond those of one text.
ROWS, AT_ONCE = 1 << 16, 1 << 20
#: Pairs whose letters are compared at once.
CHUNK = 1 << 15


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spread(counts: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, step): each place ``counts`` times, with steps from 0; about ``most`` of them at once, a place's whole."""
    ends = np.cumsum(counts)
    at = 0
    while at < len(counts):
        done = ends[at - 1] if at else 0
        to = max(int(np.searchsorted(ends, done + most, "right")), at + 1)
        some = counts[at:to]
        place = np.repeat(np.arange(at, to), some)
        yield place, np.arange(len(place)) - np.repeat(ends[at:to] - some - done, some)
        at = to


class Letters:
    """Texts of one length: letters as numbers (rare letters first), a column per text, and hashes of what they begin with."""

    def __init__(self, items: np.ndarray, texts: list[str], length: int, order: Callable[[np.ndarray], np.ndarray], unit: np.ndarray):
        self.items, self.length, self.unit = items, length, unit[items]
        codes = np.frombuffer("".join(texts[i] for i in items).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        self.rows = order(codes).reshape(len(items), length)
        self.columns = np.ascontiguousarray(self.rows.T)
        heads = [mixed(self.unit.astype(np.uint64) + np.uint64(1 << 40))]
        for p in range(PREFIX_LIMIT + 1):
            heads.append(mixed(heads[-1] ^ (self.next(p).astype(np.uint64) + np.uint64(1 << 41))))
        self.heads = heads

    def next(self, prefix: int) -> np.ndarray:
        """The letter behind the prefix, or 0."""
        return self.columns[prefix].astype(np.uint32) + np.uint32(1) if prefix < self.length else np.zeros(len(self.items), np.uint32)

    def keys(self, prefix: int, first: int, k: int) -> np.ndarray:
        """Hashes of the head and of each combination of ``k`` among the ``first`` numbered letters behind the prefix: a row per text."""
        head = self.heads[prefix][:, None]
        if k == 0:
            return head
        rest = np.sort(self.rows[:, prefix:], axis=1).astype(np.int64)
        number = np.zeros_like(rest)
        for j in range(1, rest.shape[1]):
            number[:, j] = np.where(rest[:, j] == rest[:, j - 1], number[:, j - 1] + 1, 0)
        hashed = mixed((rest[:, :first] * (1 << 24) + number[:, :first]).astype(np.uint64) + np.uint64(1 << 60))
        return np.stack([head[:, 0] + hashed[:, list(some)].sum(axis=1, dtype=np.uint64) for some in itertools.combinations(range(first), k)], axis=1)


class Meeting:
    """Who of ``a`` meets whom of ``b`` under equal keys; of one class with itself each pair is met from its smaller text."""

    def __init__(self, a: np.ndarray, b: np.ndarray | None):
        n = len(a) + (0 if b is None else len(b))
        bits = np.uint64(max(n.bit_length(), 1))
        parts = [a] if b is None else [a, b]
        offset = np.uint64(0)
        packed = []
        for part in parts:
            row = np.repeat(np.arange(len(part), dtype=np.uint64) + offset, part.shape[1])
            packed.append((part.ravel() >> bits << bits) | row)
            offset += np.uint64(len(part))
        packed = np.sort(np.concatenate(packed))
        row = (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        cut = np.flatnonzero(np.concatenate(([True], (packed[1:] >> bits) != (packed[:-1] >> bits), [True])))
        size = np.diff(cut)
        end = np.repeat(cut[1:], size)
        place = np.arange(len(row))
        if b is None:
            start = place + 1
        else:
            ours = row < len(a)
            start = np.repeat(cut[:-1] + np.add.reduceat(ours.astype(np.int64), cut[:-1]), size)
            place, start, end = place[ours], start[ours], end[ours]
        some = end > start
        place, start, end = place[some], start[some], end[some]
        by_row = np.argsort(row[place], kind="stable")
        self.ours, self.start, self.count = row[place][by_row], start[by_row], (end - start)[by_row]
        self.theirs = row if b is None else row - len(a)
        self.total = int(self.count.sum())
        self.once = a.shape[1] == 1

    def slices(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (a, b), all of one ``a`` in one slice; a pair may come under several keys."""
        where = np.flatnonzero(np.concatenate(([True], self.ours[1:] != self.ours[:-1])))[: len(self.ours)]
        if not len(where):
            return
        ends = np.cumsum(np.add.reduceat(self.count, where))
        edges = np.append(where, len(self.ours))
        at = 0
        while at < len(where):
            done = ends[at - 1] if at else 0
            to = max(int(np.searchsorted(ends, done + AT_ONCE, "right")), at + 1)
            part = slice(edges[at], edges[to])
            for place, step in spread(self.count[part], 1 << 62):
                yield self.ours[part][place], self.theirs[self.start[part][place] + step]
            at = to


def reached(a: Letters, b: Letters, i: np.ndarray, j: np.ndarray, prefix: int, threshold: float) -> np.ndarray:
    """Which pairs begin with ``prefix`` equal letters and reach the threshold: ``jaro_winkler_text``, many pairs at once."""
    found = np.zeros(len(i), bool)
    step = max(CHUNK * 16 // (a.length + b.length), 1)
    for at in range(0, len(i), step):
        x, y = (np.take(c.columns, z[at : at + step], axis=1, mode="clip") for c, z in ((a, i), (b, j)))
        found[at : at + step] = _reached(x, y, prefix, threshold)
    return found


def _reached(x: np.ndarray, y: np.ndarray, prefix: int, threshold: float) -> np.ndarray:
    """Of the columns of two matrices of letters; those of ``x`` are not longer than those of ``y``."""
    la, lb, n = len(x), len(y), x.shape[1]
    reach = max(max(la, lb) // 2 - 1, 0)
    bonus = prefix * PREFIX_SCALE

    def least() -> int:
        """Letters that have to match, were none of them out of order."""
        jaro = lambda m: (m / la + m / lb + 1.0) / 3.0
        return next((m for m in range(1, la + 1) if jaro(m) + bonus * (1.0 - jaro(m)) >= threshold - 1e-9), la + 1)

    # Equal first letters match each other, so the measure begins behind them.
    begin = np.ones(n, bool)
    for p in range(prefix):
        begin &= x[p] == y[p]
    hit, free, m = np.zeros((la, n), bool), np.ones((lb, n), bool), np.full(n, prefix, np.uint16 if la < 1 << 16 else np.int64)
    hit[:prefix], free[:prefix] = True, False
    for p in range(prefix, la):
        own = hit[p]
        for q in range(max(prefix, p - reach), min(lb, p + reach + 1)):
            now = x[p] == y[q]
            now &= free[q]
            now &= ~own
            free[q] ^= now
            own |= now
        m += own
    good = begin & (m >= least())
    if not good.any():
        return good
    some = np.flatnonzero(good)
    x, y, hit, free = (np.take(z, some, axis=1, mode="clip") for z in (x, y, hit, free))
    m = m[some].astype(np.int64)
    swaps = _unlike(x[prefix:], hit[prefix:], y[prefix:], ~free[prefix:]) // 2
    jaro = (m / la + m / lb + (m - swaps) / m) / 3.0
    good[some] = jaro + bonus * (1.0 - jaro) >= threshold
    return good


def _unlike(x: np.ndarray, hit: np.ndarray, y: np.ndarray, taken: np.ndarray) -> np.ndarray:
    """At how many places the letters of ``x`` that match, in order, are other ones than those of ``y``."""
    width = max(int(max(x.max(initial=0), y.max(initial=0))).bit_length(), 1)
    if len(x) * width <= 64:
        # The letters that match as one number each.
        packed = []
        for letters, mine in ((x, hit), (y, taken)):
            number = np.zeros(letters.shape[1], np.uint64)
            for letter, now in zip(letters, mine):
                number <<= now * np.uint64(width)
                number |= letter * now
            packed.append(number)
        apart = packed[0] ^ packed[1]
        unlike = np.zeros(len(apart), np.int64)
        low = np.uint64((1 << width) - 1)
        for _ in range(len(x)):
            unlike += (apart & low) != 0
            apart >>= np.uint64(width)
        return unlike
    return (_in_order(x, hit) != _in_order(y, taken)[: len(x)]).sum(axis=0)


def _in_order(letters: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """The letters that match, moved to the front; -1 behind them."""
    out = np.full(letters.shape, -1, np.int64)
    place = np.cumsum(hit, axis=0) - 1
    at, column = np.nonzero(hit)
    out[place[at, column], column] = letters[at, column]
    return out


def near_items(texts: list[str], unit: np.ndarray, side: np.ndarray, cross: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(x, y): pairs of different texts (places in the lists) of one unit that reach the threshold, each pair once.

    Texts meet as ``similarity.length_plan`` says: under the number of equal letters they begin with, both lengths, and letters that have to
    match behind the beginning.  In a unit that is ``cross`` only texts of different sides meet.  ``left``, ``right``: pairs without a left one and
    a right one are passed over.
    """
    lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    points = np.unique(np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4"))
    ranked = sorted(points.tolist(), key=lambda c: (-FREQUENT.find(chr(c)), c))
    rank = np.empty(len(points), np.uint8 if len(points) < 256 else np.uint16 if len(points) < 1 << 16 else np.uint32)
    rank[np.searchsorted(points, ranked)] = np.arange(len(points))
    order = lambda codes: rank[np.searchsorted(points, codes)]
    several, crossed, all_meet = bool(len(unit)) and bool((unit != unit[0]).any()), bool(cross.any()), bool((left & right).all())
    by_length = {n: Letters(np.flatnonzero(lengths == n), texts, n, order, unit) for n in np.unique(lengths).tolist()}
    for prefix in range(PREFIX_LIMIT + 1):
        for short, long in itertools.combinations_with_replacement(by_length, 2):
            plans = [length_plan(own, [other], prefix, threshold) for own, other in ((short, long), (long, short))]
            if not plans[0]:
                continue
            a, b, one = by_length[short], by_length[long], short == long
            ended = short == long == prefix
            if prefix < PREFIX_LIMIT and not ended and len(_all(a, b, prefix)) == len(_all(a, b, prefix + 1)):
                continue  # None begin with so many equal letters and no more.
            sides = [(a, plans[0][0])] if one else [(a, plans[0][0]), (b, plans[1][0])]
            met = Meeting(a.keys(prefix, 0, 0), None if one else b.keys(prefix, 0, 0))
            if not met.total:
                continue
            k = plans[0][0][2]
            cost = sum(len(c.items) * math.comb(first, k) for c, (_, first, _) in sides)
            if k and met.total > WHOLE * cost:
                keyed = [c.keys(prefix, first, k) for c, (_, first, _) in sides]
                under = Meeting(keyed[0], None if one else keyed[1])
                met = under if under.total < met.total else met
            behind = a.next(prefix), b.next(prefix)
            for i, j in met.slices():
                if prefix < PREFIX_LIMIT and not ended:
                    keep = behind[0][i] != behind[1][j]
                    i, j = i[keep], j[keep]
                if not met.once:
                    code = np.sort(i * len(b.items) + j)
                    i, j = np.divmod(code[np.concatenate(([True], code[1:] != code[:-1]))[: len(code)]], len(b.items))
                if several or crossed or not all_meet:
                    x, y = a.items[i], b.items[j]
                    keep = (unit[x] == unit[y]) & ((left[x] & right[y]) | (left[y] & right[x])) & (~cross[x] | (side[x] != side[y]))
                    i, j = i[keep], j[keep]
                good = reached(a, b, i, j, prefix, threshold)
                i, j = i[good], j[good]
                if len(i):
                    yield a.items[i], b.items[j]


def _all(a: Letters, b: Letters, prefix: int) -> np.ndarray:
    return np.unique(a.heads[prefix] if a is b else np.concatenate((a.heads[prefix], b.heads[prefix])))


def units(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole units, rows of equal values ``by`` that come one after the other, ROWS of them together; and the number of each row's unit."""
    held: list[pa.RecordBatch] = []
    number = 0

    def numbered(table: pa.Table) -> np.ndarray:
        changed = np.zeros(max(table.num_rows - 1, 0), bool)
        for name in by:
            values = table.column(name).combine_chunks()
            changed |= pc.not_equal(values[1:], values[:-1]).to_numpy(zero_copy_only=False)
        return np.concatenate(([0], np.cumsum(changed)))

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        number += batch.num_rows
        if number < ROWS:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        unit = numbered(table)
        cut = int(np.searchsorted(unit, unit[-1]))
        if cut:
            yield table.slice(0, cut), unit[:cut]
        held = table.slice(cut).combine_chunks().to_batches()
        # Rows of one unit are joined again when there are twice as many, not with every batch.
        number = table.num_rows - cut if cut else 0
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, numbered(table)


def near_rows(by: list[str], threshold: float, once: bool, names: tuple[str, str]):
    """A function for ``mapInArrow``: rows sorted by ``by`` (cell, _lo, _hi) become the pairs of rows of each unit that are near."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, unit in units(batches, by):
            tile, lo, hi = (table.column(c).to_numpy() for c in ("_tile", "_lo", "_hi"))
            left, right = (table.column(c).to_numpy() for c in ("_left", "_right"))
            row = table.column("_row").combine_chunks()
            rank = np.asarray(pc.rank(row, tiebreaker="dense", null_placement="at_end").to_numpy(), np.int64)
            known = row.is_valid().to_numpy(zero_copy_only=False)
            # Equal texts of one side of a unit are one item.
            text = table.column("_text").combine_chunks().dictionary_encode()
            cross, side = lo != hi, (tile != lo).astype(np.int64)
            code = (unit * 2 + side) * len(text.dictionary) + text.indices.to_numpy()
            items, first, item = np.unique(code, return_index=True, return_inverse=True)
            rows = np.argsort(item, kind="stable")
            count = np.bincount(item, minlength=len(items))
            start = np.cumsum(count) - count
            texts = text.dictionary.take(text.indices.take(pa.array(first))).to_pylist()
            any_left, any_right = (np.bincount(item, weights=flag, minlength=len(items)) > 0 for flag in (left, right))
            same = np.flatnonzero(any_left & any_right & ~cross[first])
            near = near_items(texts, unit[first], side[first], cross[first], any_left, any_right, threshold)
            for x, y in itertools.chain([(same, same)], near):
                for pair, step in spread(count[x], AT_ONCE):
                    ours = rows[start[x[pair]] + step]
                    for place, other in spread(count[y[pair]], AT_ONCE):
                        r, s = ours[place], rows[start[y[pair[place]]] + other]
                        both = [(r, s)] if x is y else [(r, s), (s, r)]
                        for p, q in both:
                            keep = left[p] & right[q]
                            if once:
                                keep &= known[p] & known[q] & (rank[p] < rank[q])
                            p, q = p[keep], q[keep]
                            for at in range(0, len(p), ROWS):
                                yield pa.RecordBatch.from_arrays([row.take(pa.array(z[at : at + ROWS])) for z in (p, q)], names=list(names))

    return run
