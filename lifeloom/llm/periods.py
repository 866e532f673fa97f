"""Periodic runs of words, found on a grammar of the text.

A run is a stretch of words with smallest period q and at least max(12, 2q) words that cannot be extended.

1. A run's words lie in six-word strings that occur again q words away in the same text.  Words outside all repeated six-word
   strings are set aside; what is left falls into stretches.
2. Re-Pair: the word ids of the stretches are compressed in rounds.  A round replaces adjacent pairs that occur at least
   twice by a new symbol, more frequent pairs first where two overlap.  What stays uncompressed is paired up evenly until each
   stretch is one symbol.
3. Every symbol is looked at once: a run that lies in its text and in neither of its halves crosses the boundary between
   them.  All periods of such runs come from two matching tables of the halves, in time linear in the symbol's words.
4. A symbol's runs are translated to all places where it was put; of pieces of one period the maximal stay, and of equal
   stretches the smallest period.

The texts of a batch share one grammar, so copies are worked on once.  Work per text is O(n log n) whatever it holds.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The least words of a run.  Half of them match in any run, which the sieve relies on.
LEAST = 12
GRAM = LEAST // 2
#: Words that share one grammar; a longer text has its own.
BLOCK = 1 << 19

_FACTORS = np.random.default_rng(42).integers(1, 2**63, GRAM, dtype=np.uint64) | np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8: what blanks, tabs and line ends leave."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def rewritten(count: int, doc_id: int | None) -> np.ndarray:
    """Which original word stands at each place of the text that is judged: a tenth of the ids get a periodic end."""
    at = np.arange(count, dtype=np.int64)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not count:
        return at
    g = h // 10
    a = g % count
    p = 1 + (count - a) // (3 + g % 8)
    at[a:] = a + (at[a:] - a) % p
    return at


# ---------------------------------------------------------------- six-word strings


def neighbours(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place, the places before and after it in its text where the same GRAM words start (-1 and len if none).

    Strings are told apart by a hash; equal hashes of different strings only let more through.
    """
    n = len(ids)
    before, after = np.full(n, -1, dtype=np.int64), np.full(n, n, dtype=np.int64)
    if n < GRAM:
        return before, after
    value = (ids.astype(np.uint64) + np.uint64(1)) * _MIX
    value ^= value >> np.uint64(29)
    text = np.zeros(n, dtype=np.uint64)
    text[starts] = 1
    text = np.cumsum(text, dtype=np.uint64)
    m = n - GRAM + 1
    key = text[:m] * np.uint64(0xBF58476D1CE4E5B9)
    for j in range(GRAM):
        key += value[j : j + m] * _FACTORS[j]
    key ^= key >> np.uint64(31)
    inside = text[:m] == text[GRAM - 1 :]
    place = np.flatnonzero(inside)
    place = place[np.argsort(key[place], kind="stable")]
    same = key[place[1:]] == key[place[:-1]]
    after[place[:-1][same]] = place[1:][same]
    before[place[1:][same]] = place[:-1][same]
    return before, after


# ---------------------------------------------------------------- grammar


def grammar(ids: np.ndarray, place: np.ndarray):
    """Yields (places, half, length) per symbol: the texts from each place over ``length`` words are equal, cut after ``half``.

    ``place`` are the places that take part, ascending; neighbours pair only if one ends where the next starts.
    """
    symbol, at = ids[place].astype(np.int64), place.astype(np.int64)
    length = np.ones(len(at), dtype=np.int64)
    fresh = int(ids.max()) + 1 if len(ids) else 0
    while len(at) > 1:
        joins = at[:-1] + length[:-1] == at[1:]
        code = np.where(joins, symbol[:-1] * fresh + symbol[1:], -1)
        _, which, count = np.unique(code, return_inverse=True, return_counts=True)
        rank = np.where(joins & (count[which] > 1), count[which] * len(code) + which, 0)
        chosen = _apart(rank)
        chosen = chosen[np.bincount(which[chosen], minlength=len(count))[which[chosen]] > 1]
        if not len(chosen):
            break
        order = chosen[np.argsort(which[chosen], kind="stable")]
        first = np.flatnonzero(np.concatenate(([True], which[order][1:] != which[order][:-1])))
        for group in np.split(order, first[1:]):
            i = group[0]
            yield at[group], int(length[i]), int(length[i] + length[i + 1])
        name = np.zeros(len(count), dtype=np.int64)
        name[which[order[first]]] = fresh + np.arange(len(first))
        fresh += len(first)
        symbol[chosen] = name[which[chosen]]
        length[chosen] += length[chosen + 1]
        symbol, at, length = (np.delete(x, chosen + 1) for x in (symbol, at, length))
    while len(at) > 1:
        joins = at[:-1] + length[:-1] == at[1:]
        # Even places within each stretch.
        head = np.flatnonzero(np.concatenate(([True], ~joins)))
        inside = np.arange(len(at)) - np.repeat(head, np.diff(np.concatenate((head, [len(at)]))))
        chosen = np.flatnonzero(joins & (inside[:-1] % 2 == 0))
        if not len(chosen):
            break
        for i in chosen:
            yield at[i : i + 1], int(length[i]), int(length[i] + length[i + 1])
        length[chosen] += length[chosen + 1]
        at, length = np.delete(at, chosen + 1), np.delete(length, chosen + 1)


def _apart(rank: np.ndarray) -> np.ndarray:
    """Places of ``rank`` above both neighbours; of a row of equal ones that is above both its ends, every other place."""
    head = np.flatnonzero(np.concatenate(([True], rank[1:] != rank[:-1])))
    size = np.diff(np.concatenate((head, [len(rank)])))
    value = rank[head]
    higher = (value > np.concatenate(([0], value[:-1]))) & (value > np.concatenate((value[1:], [0])))
    inside = np.arange(len(rank)) - np.repeat(head, size)
    return np.flatnonzero(np.repeat(higher, size) & (inside % 2 == 0))


# ---------------------------------------------------------------- runs across a boundary


def _match(text: list) -> list[int]:
    """For each place, how far the text from there agrees with the text's beginning."""
    n = len(text)
    out = [0] * n
    out[0] = n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = out[i - left]
            if k < right - i:
                out[i] = k
                continue
            k = right - i
        while i + k < n and text[k] == text[i + k]:
            k += 1
        out[i] = k
        if i + k > right:
            left, right = i, i + k
    return out


def crossing(text: list[int], half: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of stretches of ``text`` with the period, maximal in it, around the boundary at ``half``.

    A stretch of two periods or more reaches a whole period to the right of the boundary or to the left.  Of equal stretches
    only the smallest period is named: any run that holds such a stretch has it too.
    """
    n = len(text)
    a, b = text[:half], text[half:]
    back, whole = a[::-1], text[::-1]
    left = np.array(_match([*back, -1, *whole]) + [0], dtype=np.int64)  # backwards, against the end of the left half
    right = np.array(_match([*b, -1, *text]) + [0], dtype=np.int64)  # forwards, against the start of the right half
    found: dict[tuple[int, int], int] = {}

    def note(start, end, period):
        for s, e, p in zip(start.tolist(), end.tolist(), period.tolist()):
            if found.get((s, e), p) >= p:
                found[s, e] = p

    q = np.arange(1, n - half + 1)
    ahead = np.where(q < n - half, right[np.minimum(q, n - half)], 0)
    behind = left[half + 1 + n - half - q]
    keep = (behind >= 1) & (ahead + behind >= np.maximum(q, LEAST - q))
    note(half - behind[keep], (half + q + ahead)[keep], q[keep])
    q = np.arange(1, half + 1)
    behind = np.where(q < half, left[np.minimum(q, half)], 0)
    ahead = right[n - half + 1 + half - q]
    keep = (ahead >= 1) & (ahead + behind >= np.maximum(q, LEAST - q))
    note((half - q - behind)[keep], (half + ahead)[keep], q[keep])
    return [(s, e, p) for (s, e), p in found.items()]


def runs_of(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(start, end, period) of every run of texts put behind one another; ``starts`` are their first places.  Sorted."""
    before, after = neighbours(ids, starts)
    n = len(ids)
    twice = np.flatnonzero((before >= 0) | (after < n))
    none = np.empty((0, 3), dtype=np.int64)
    if not len(twice):
        return none
    cover = np.zeros(n + 1, dtype=np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, np.minimum(twice + GRAM, n), -1)
    covered = np.cumsum(cover[:n]) > 0
    # Texts must not touch: one unused place before each.
    text = np.zeros(n, dtype=np.int64)
    text[starts] = 1
    shift = np.cumsum(text)
    wide = np.full(n + int(shift[-1]) + 1, -1, dtype=np.int64)
    spot = np.arange(n) + shift
    wide[spot] = ids
    soon = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(after - np.arange(n) < LEAST + GRAM, out=soon[1:])
    pieces = []
    for places, half, length in grammar(wide, spot[covered]):
        if length < LEAST:
            continue
        lo = int(places[0]) - int(shift[np.searchsorted(spot, places[0])])
        hi, m = lo + length, lo + half
        # A run of period 18 or more shows in one of three strings near the boundary, a shorter one in a string that
        # occurs again at once.
        if not (
            soon[m] > soon[max(lo, m - LEAST - 2 * GRAM)]
            or (m < n and after[m] + GRAM <= hi)
            or (m - GRAM >= lo and before[m - GRAM] >= lo)
            or (m - LEAST >= lo and after[m - LEAST] + GRAM <= hi)
        ):
            continue
        for start, end, period in crossing(ids[lo:hi].tolist(), half):
            pieces.append(np.stack((places + start, places + end, np.full(len(places), period)), axis=1))
    if not pieces:
        return none
    found = np.concatenate(pieces)
    # Of one period: pieces that another one holds, or repeats, go.
    found = found[np.lexsort((-found[:, 1], found[:, 0], found[:, 2]))]
    far = found[:, 1] + found[:, 2] * len(wide)
    held = np.concatenate(([False], np.maximum.accumulate(far)[:-1] >= far[1:]))
    found = found[~held]
    # Of one stretch: the smallest period.
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    again = np.concatenate(([False], (found[1:, :2] == found[:-1, :2]).all(axis=1)))
    found = found[~again]
    origin = shift[np.searchsorted(spot, found[:, 0])]
    found[:, 0] -= origin
    found[:, 1] -= origin
    return found[np.lexsort((found[:, 2], found[:, 0]))]


# ---------------------------------------------------------------- documents

NAMES = ["doc_id", "n_words", "kept", "runs"]
KINDS = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))]
RUNS = "array<struct<start:long,length:long,period:long>>"


def _solved(texts: list[tuple[int | None, list[bytes]]]) -> list[tuple]:
    """One row per text: id, number of words, kept words, runs."""
    known: dict[bytes, int] = {}
    parts, starts, total = [], [], 0
    for doc_id, words in texts:
        own = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)
        parts.append(own[rewritten(len(own), doc_id)])
        starts.append(total)
        total += len(own)
    ids = np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)
    first = np.array(starts, dtype=np.int64)
    found = runs_of(ids, np.unique(first[first < total])) if total else np.empty((0, 3), dtype=np.int64)
    cuts = np.searchsorted(found[:, 0], np.array([*starts, total]))
    listed = None
    out = []
    for i, (doc_id, words) in enumerate(texts):
        own = found[cuts[i] : cuts[i + 1]].copy()
        own[:, :2] -= starts[i]
        if zlib.crc32(str(doc_id).encode()) % 10 == 0 and doc_id is not None:
            listed = listed or list(known)
            words = [listed[w] for w in parts[i]]
        if len(own):
            edge = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(edge, own[:, 0] + own[:, 2], 1)
            np.add.at(edge, own[:, 1], -1)
            words = [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
        runs = [{"start": s, "length": e - s, "period": p} for s, e, p in own.tolist()]
        out.append((doc_id, len(parts[i]), b" ".join(words).decode("utf-8", "surrogatepass"), runs))
    return out


def collapsed(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, kept, runs) of every row: its runs by start and period, and its words without repetitions, joined by a blank.

    ``kept`` lacks each word that some run holds after its first period.  Null and empty texts have no words and no runs;
    a text whose id is null is judged as it is, all others after the rewriting of ids whose crc32 ends in zero.
    Every row is judged on its own: ties and repeated rows stay.  A text is held whole by its task.  An empty table gives an
    empty result; further columns are ignored.
    """

    def run(batches):
        block, size = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                words = words_of(text.as_py())
                if block and size + len(words) > BLOCK:
                    yield from packed(block)
                    block, size = [], 0
                block.append((doc_id, words))
                size += len(words)
        if block:
            yield from packed(block)

    def packed(block):
        # Results leave in parts that stay far below the limits of one Arrow array.
        rows = _solved(block)
        for at in range(0, len(rows), 1000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at : at + 1000]), KINDS)], NAMES)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, n_words long, kept string, runs {RUNS}")


def report(docs: DataFrame) -> DataFrame:
    """The contract's columns.  The longest run comes first by length, then start, then period."""
    found = collapsed(docs)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("r"), lines.alias("lines"), "kept").select(
        "doc_id",
        "n_runs",
        (-F.col("r.s")).alias("start"),
        F.col("r.l").alias("length"),
        (-F.col("r.p")).alias("period"),
        F.floor(F.col("r.l") * 1000 / -F.col("r.p")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join("lines", ""), 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )
