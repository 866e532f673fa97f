"""Repeated substrings by linear grouping suffix sorting, and their removal.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts somewhere else.

1. Every window of ``LENGTH`` bytes names an anchor: the leftmost smallest of the hashes of its
   ``GRAM``-byte strings.  Equal windows name equal anchors at equal offsets, so windows that are equal meet
   under one anchor hash.  Neighbouring windows mostly share an anchor; one row per anchor holds how far they reach
   and a hash of the bytes they span (the anchor's context).
2. Anchors whose hash occurs once are done.  Of the others, equal contexts collapse into one with a count.
   A context that occurs twice is repeated as a whole.
3. Different contexts under one anchor may still share windows.  One copy of each is fetched, and blocks of them are
   suffix sorted by the grouping construction below; neighbours in the order that agree over ``LENGTH`` bytes
   are repeated windows.
4. An anchor with more than ``HOT_CONTEXTS`` different contexts is not put into one block: its windows
   are counted by (anchor, offset, hash of the window's bytes), which combines before it is shuffled.

So no group is gathered whole, no pairs are formed, and only texts that a step needs are shuffled.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import runs, same, settled

LENGTH = 200
GRAM = 32
REACH = LENGTH - GRAM + 1
#: Bytes whose hashes are computed at once, and bytes of contexts that are suffix sorted at once.
BLOCK = 1 << 20
SORT_BLOCK = 1 << 18
#: Neighbouring windows that are looked at together before sorting.
STRETCH = 16
#: Most different contexts of an anchor in one block; with at most 2 * LENGTH bytes each, a block stays under two megabytes.
HOT_CONTEXTS = 4000
#: Bits of the sieve that keeps texts without relevance out of a shuffle; its size is fixed.
SIEVE_BITS = 1 << 22

_BASE = 0x9E3779B97F4A7C15
#: A second hash of another kind, over a prime field: texts that are built to collide modulo a power of two do not collide in it.
_PRIME = (1 << 31) - 1
_PRIME_BASE = 1_103_515_245
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_BYTE_VALUE = np.random.default_rng(42).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


# ---------------------------------------------------------------- suffix sorting


def suffix_order(text: bytes) -> list[int]:
    """Starts of all suffixes of ``text`` in lexicographic order, by grouping on Lyndon prefixes.

    First phase: suffixes are grouped by their first byte; a group is known by where it starts in the order.  Groups
    are taken in descending order.  Each member gets a pointer to the nearest suffix before it in a smaller group.
    The suffixes pointed at have their Lyndon prefix extended by the group's, once per pointer:
    they leave their groups for new ones right behind, those with more pointers farther up.
    Second phase: the order is read from the front; a suffix places the one before it and, along the pointers, all
    others that are not placed yet, each at the next free place of its group.  Nothing is renamed or recursed into.
    """
    # The end of the text, smaller than any byte, is a suffix of its own.
    n = len(text) + 1
    values = [b + 1 for b in text] + [0]
    by_value = defaultdict(list)
    for i, v in enumerate(values):
        by_value[v].append(i)
    group = [0] * n  # start of the suffix's group
    members, end_of, start_at = {}, {}, {}
    at = 0
    for v in sorted(by_value):
        listed = by_value[v]
        for i in listed:
            group[i] = at
        members[at], end_of[at], start_at[at + len(listed)] = listed, at + len(listed), at
        at += len(listed)
    previous = [-1] * n
    upto = n
    while upto > 0:
        start = start_at[upto]
        pointed: dict[int, int] = {}
        for i in members.pop(start):
            if group[i] != start:
                continue  # has moved on to another group
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = previous[j]
            previous[i] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        upto = start
        by_count = defaultdict(lambda: defaultdict(list))
        for j, k in pointed.items():
            by_count[k][group[j]].append(j)
        for k in sorted(by_count, reverse=True):
            for old, moved in by_count[k].items():
                end = end_of[old]
                new = end - len(moved)
                if new == old:
                    continue  # the whole group: its place does not change
                end_of[old], start_at[new] = new, old
                moved.sort()
                for j in moved:
                    group[j] = new
                members[new], end_of[new], start_at[end] = moved, end, new
    order = [-1] * n
    placed = bytearray(n)
    free = group  # next free place of a group, kept at its start
    nxt = dict.fromkeys(set(group))
    for g in nxt:
        nxt[g] = g
    order[0] = n - 1
    placed[n - 1] = 1
    for r in range(n):
        j = order[r] - 1
        while j >= 0 and not placed[j]:
            g = free[j]
            order[nxt[g]] = j
            nxt[g] += 1
            placed[j] = 1
            j = previous[j]
    return order[1:]


def repeated_windows(contexts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each text, a mask over its windows of ``length`` bytes: which of them occur elsewhere in ``contexts``.

    A zero byte is put behind each text; windows never span it.
    """
    joined = b"\0".join(contexts) + b"\0"
    starts = np.concatenate(([0], np.cumsum([len(c) + 1 for c in contexts])[:-1])).astype(np.int64)
    windows = np.array([max(0, len(c) - length + 1) for c in contexts], dtype=np.int64)
    whole = np.zeros(len(joined), dtype=bool)
    for s, w in zip(starts, windows):
        whole[s : s + w] = True
    order = np.array(suffix_order(joined), dtype=np.int64)
    order = order[whole[order]]
    found = np.zeros(len(joined), dtype=bool)
    if len(order) > 1:
        data = np.frombuffer(joined, dtype=np.uint8)
        view = np.lib.stride_tricks.sliding_window_view(data, length)
        for at in range(0, len(order) - 1, 1 << 14):
            a, b = order[at : at + (1 << 14)], order[at + 1 : at + 1 + (1 << 14)]
            a = a[: len(b)]
            equal = (view[a] == view[b]).all(axis=1)
            found[a[equal]] = True
            found[b[equal]] = True
    return [found[s : s + w] for s, w in zip(starts, windows)]


# ---------------------------------------------------------------- anchors


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo the prime, by doubling."""
    out = np.ones(n, dtype=np.int64)
    done, step = 1, base
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * step % _PRIME
        done, step = done + more, step * step % _PRIME
    return out


class _Hashes:
    """Hashes of substrings of one block from running sums modulo 2**64, and on demand from sums modulo a prime."""

    powers = np.ones(1, dtype=np.uint64)
    inverse = np.ones(1, dtype=np.uint64)
    prime_powers = np.ones(1, dtype=np.int64)
    prime_inverse = np.ones(1, dtype=np.int64)

    def __init__(self, data: np.ndarray) -> None:
        n = len(data) + 1
        if len(self.powers) < n:
            base, back = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
            _Hashes.powers = np.cumprod(np.full(n, base), dtype=np.uint64) * np.uint64(pow(_BASE, -1, 1 << 64))
            _Hashes.inverse = np.cumprod(np.full(n, back), dtype=np.uint64) * base
            _Hashes.prime_powers = _powers(_PRIME_BASE, n)
            _Hashes.prime_inverse = _powers(pow(_PRIME_BASE, -1, _PRIME), n)
        self.data = data
        self.sums = np.zeros(n, dtype=np.uint64)
        np.cumsum(_BYTE_VALUE[data] * self.powers[: n - 1], out=self.sums[1:])
        self.prime_sums = None

    def of(self, start, end) -> np.ndarray:
        x = (self.sums[end] - self.sums[start]) * self.inverse[start]
        x ^= x >> np.uint64(31)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))

    def sure(self, start, end) -> np.ndarray:
        """Both hashes in one: for equality that nothing checks afterwards."""
        if self.prime_sums is None:
            # Values up to 256 times a power below 2**31: 2**24 of them fit a long before the remainder is taken.
            self.prime_sums = np.zeros(len(self.data) + 1, dtype=np.int64)
            np.cumsum((self.data.astype(np.int64) + 1) * self.prime_powers[: len(self.data)], out=self.prime_sums[1:])
        part = (self.prime_sums[end] - self.prime_sums[start]) % _PRIME * self.prime_inverse[start] % _PRIME
        return self.of(start, end) ^ (part.astype(np.uint64) * _SPREAD)


def anchors_of(data: bytes) -> tuple[np.ndarray, ...]:
    """(lowest window, highest window, anchor, anchor hash, context hash) for runs of windows that share an anchor."""
    parts = []
    for at in range(0, max(0, len(data) - LENGTH + 1), BLOCK):
        block = np.frombuffer(data, dtype=np.uint8, count=min(BLOCK + LENGTH - 1, len(data) - at), offset=at)
        hashes = _Hashes(block)
        grams = np.arange(len(block) - GRAM + 1)
        value = hashes.of(grams, grams + GRAM)
        # Hash above, place below: the smallest of the leftmost.
        low = (value & np.uint64(0xFFFFFFFFFF000000)) | grams.astype(np.uint64)
        width = 1
        while width * 2 <= REACH:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        rest = REACH - width
        low = np.minimum(low[: len(low) - rest], low[rest:]) if rest else low
        anchor = (low & np.uint64(0xFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        last = np.concatenate((first[1:], [len(anchor)])) - 1
        place = anchor[first]
        parts.append((first + at, last + at, place + at, value[place], hashes.sure(first, last + LENGTH)))
    if not parts:
        return tuple(np.empty(0, dtype=t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(c) for c in zip(*parts))


def _encoded(docs: DataFrame) -> DataFrame:
    """(doc_id, copy, text): ``copy`` is a hash of the text, so that rows which share an id stay apart."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("copy"), text.alias("text"))


def anchors(docs: DataFrame) -> DataFrame:
    """One row per anchor of every text: key of the row, lowest window, offsets, hashes."""
    names = ["doc_id", "copy", "low", "back", "ahead", "h", "c"]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [anchors_of(t.as_py().encode("utf-8", "surrogatepass")) for t in part.column("text")]
                row = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]))
                low, high, place, h, c = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(row), part.column("copy").take(row), pa.array(low),
                        pa.array((place - low).astype(np.int16)), pa.array((high - place).astype(np.int16)),
                        pa.array(h.view(np.int64)), pa.array(c.view(np.int64)),
                    ],
                    names,
                )

    schema = "doc_id long, copy long, low long, back short, ahead short, h long, c long"
    return _encoded(docs).mapInArrow(run, schema)


def shared_windows(rows: list[dict]) -> list[list[tuple[int, int]]]:
    """For each context (h, back, context), ranges of its windows that occur in another context of the same h.

    Windows are first looked at in stretches of STRETCH neighbours at equal offsets from the anchor.  All windows
    of a stretch hold its middle; where that occurs once, none of them can be repeated.  What is left of each
    context is suffix sorted, equal pieces once.
    """
    lengths = np.array([len(r["context"]) for r in rows])
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    hashes = _Hashes(np.frombuffer(b"".join(r["context"] for r in rows), dtype=np.uint8))
    back = np.array([r["back"] for r in rows], dtype=np.int64)
    first, last = (REACH - back) // STRETCH, (REACH - back + lengths - LENGTH) // STRETCH
    count = last - first + 1
    row = np.repeat(np.arange(len(rows)), count)
    stretch = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[row]
    at = starts[row] + stretch * STRETCH - REACH + back[row]
    middle = hashes.of(at + STRETCH - 1, at + LENGTH)
    anchor = np.array([r["h"] for r in rows], dtype=np.int64).view(np.uint64)[row]
    key = (middle * np.uint64(_BASE)) ^ anchor ^ (stretch.astype(np.uint64) << np.uint64(40))
    _, which, times = np.unique(key, return_inverse=True, return_counts=True)
    keep = np.flatnonzero(times[which] > 1)
    if not len(keep):
        return [[] for _ in rows]
    cut = np.flatnonzero((np.diff(row[keep]) != 0) | (np.diff(stretch[keep]) != 1)) + 1
    found: list[list[tuple[int, int]]] = [[] for _ in rows]
    pieces: dict[bytes, list[tuple[int, int]]] = {}
    for group in np.split(keep, cut):
        r = int(row[group[0]])
        low = max(0, int(stretch[group[0]]) * STRETCH - REACH + int(back[r]))
        high = min(int(lengths[r]) - LENGTH, (int(stretch[group[-1]]) + 1) * STRETCH - 1 - REACH + int(back[r]))
        pieces.setdefault(rows[r]["context"][low : high + LENGTH], []).append((r, low))
    texts = list(pieces)
    for text, mask in zip(texts, repeated_windows(texts)):
        if len(pieces[text]) > 1:
            mask[:] = True
        for r, low in pieces[text]:
            found[r] += [(low + int(s), low + int(e)) for s, e in zip(*runs(mask))]
    return found


# ---------------------------------------------------------------- contexts


def _sieved(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose ``copy`` may be among ``keys``: a filter of fixed size, sent to all tasks.

    Exactness does not rest on it; it keeps most other texts out of the shuffle that follows.
    """
    bit = F.pmod(F.col("copy"), F.lit(SIEVE_BITS))
    words = keys.select(F.floor(bit / 64).cast("int").alias("_word"), F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int")).alias("_bit"))
    words = words.groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    own = F.call_function("shiftrightunsigned", F.col("_bits"), (bit % 64).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1
    return texts.join(F.broadcast(words), F.floor(bit / 64).cast("int") == F.col("_word")).filter(own).drop("_word", "_bits")


def _fetch(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h, c, back, ahead, n, hot, context) for one place of each wanted context."""
    per_text = wanted.groupBy(F.col("doc_id").alias("w_id"), F.col("copy").alias("w_copy")).agg(
        F.collect_list(F.struct("low", "h", "c", "back", "ahead", "n", "hot")).alias("places")
    )
    # A repeated row is fetched as often as it occurs; all its windows are repeated, so that changes nothing.
    texts = _sieved(_encoded(docs), wanted.select("copy"))
    joined = texts.join(per_text, same(texts.doc_id, per_text.w_id) & (texts["copy"] == per_text.w_copy)).select("text", "places")
    kinds = [pa.int64(), pa.int64(), pa.int16(), pa.int16(), pa.int64(), pa.bool_()]
    names = ["h", "c", "back", "ahead", "n", "hot"]

    def run(batches):
        for batch in batches:
            for text, places in zip(batch.column("text"), batch.column("places")):
                data = text.as_py().encode("utf-8", "surrogatepass")
                rows = places.as_py()
                cut = [data[p["low"] : p["low"] + p["back"] + p["ahead"] + LENGTH] for p in rows]
                columns = [pa.array([p[k] for p in rows], t) for k, t in zip(names, kinds)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(cut, pa.binary())], [*names, "context"])

    return joined.mapInArrow(run, "h long, c long, back short, ahead short, n long, hot boolean, context binary")


def _sorted_out(contexts: DataFrame) -> DataFrame:
    """(h, c, back, ahead, spans): window ranges, from the context's start, that occur in another context of the anchor."""
    names = ["h", "c", "back", "ahead"]
    span = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))

    def solve(rows):
        spans = [[{"s": s, "e": e} for s, e in found] for found in shared_windows(rows)]
        keep = [i for i, s in enumerate(spans) if s]
        columns = [pa.array([rows[i][k] for i in keep], pa.int64()) for k in names[:2]]
        columns += [pa.array([rows[i][k] for i in keep], pa.int16()) for k in names[2:]]
        return pa.RecordBatch.from_arrays([*columns, pa.array([spans[i] for i in keep], span)], [*names, "spans"])

    def run(batches):
        block, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                # An anchor's contexts stay in one block.
                if size >= SORT_BLOCK and row["h"] != block[-1]["h"]:
                    yield solve(block)
                    block, size = [], 0
                block.append(row)
                size += len(row["context"])
        if block:
            yield solve(block)

    ordered = contexts.select(*names, "context").repartition("h").sortWithinPartitions("h")
    return ordered.mapInArrow(run, "h long, c long, back short, ahead short, spans array<struct<s:long,e:long>>")


def _counted_out(contexts: DataFrame) -> DataFrame:
    """The same for anchors with very many contexts: windows are counted by offset and hash."""
    names = ["h", "c", "back", "ahead", "n"]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = np.frombuffer(row["context"], dtype=np.uint8)
                at = np.arange(len(block) - LENGTH + 1)
                hashes = _Hashes(block).sure(at, at + LENGTH).view(np.int64)
                full = [pa.array([row[k]] * len(at), t) for k, t in zip(names, (pa.int64(), pa.int64(), pa.int16(), pa.int16(), pa.int64()))]
                yield pa.RecordBatch.from_arrays([*full, pa.array(at), pa.array(hashes)], [*names, "at", "w"])

    windows = contexts.select(*names, "context").mapInArrow(
        run, "h long, c long, back short, ahead short, n long, at long, w long"
    )
    windows = settled(windows.withColumn("offset", F.col("at") - F.col("back")), "suffix-windows")
    twice = windows.groupBy("h", "offset", "w").agg(F.sum("n").alias("times")).filter("times > 1").drop("times")
    return (
        windows.join(twice, ["h", "offset", "w"], "left_semi").groupBy("h", "c", "back", "ahead")
        .agg(F.sort_array(F.collect_list(F.struct(F.col("at").alias("s"), (F.col("at") + 1).alias("e")))).alias("spans"))
    )


def repeats(docs: DataFrame, hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """(doc_id, copy, spans): byte ranges of every text that repeated windows cover; they may overlap."""
    key = ["h", "c", "back", "ahead"]
    found = settled(anchors(docs), "suffix-anchors")
    # Written, so that the join below deals out both sides itself and can split an anchor that fills many texts.
    often = settled(found.groupBy("h").agg(F.count("*").alias("times")).filter("times > 1").select("h"), "suffix-often")
    places = settled(found.join(often, "h", "left_semi"), "suffix-places")
    contexts = places.groupBy(*key).agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "copy", "low")).alias("at"))
    contexts = settled(contexts.select(*key, "n", "at.doc_id", "at.copy", "at.low"), "suffix-contexts")
    several = contexts.groupBy("h").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    wanted = contexts.join(several, "h").withColumn("hot", F.col("kinds") > hot_contexts).drop("kinds")
    fetched = settled(_fetch(docs, settled(wanted, "suffix-wanted")), "suffix-fetched")
    whole = contexts.filter("n > 1").select(
        *key, F.array(F.struct(F.lit(0).cast("long").alias("s"), (F.col("back") + F.col("ahead") + 1).cast("long").alias("e"))).alias("spans")
    )
    partly = _sorted_out(fetched.filter("not hot")).unionByName(_counted_out(fetched.filter("hot")))
    partly = partly.join(contexts.filter("n > 1").select(*key), key, "left_anti")
    marked = settled(whole.unionByName(partly), "suffix-marked")
    cover = places.join(marked, key).select(
        "doc_id", "copy",
        F.explode(F.transform("spans", lambda s: F.struct((F.col("low") + s.s).alias("s"), (F.col("low") + s.e + LENGTH - 1).alias("e")))).alias("span"),
    )
    return cover.groupBy("doc_id", "copy").agg(F.sort_array(F.collect_set("span")).alias("spans"))


def _kept(data: bytes, spans: list) -> tuple[bytes, int, int]:
    """What stays of ``data``, and how many bytes and maximal runs go."""
    kept, upto, start, removed, count = [], 0, None, 0, 0
    for s, e in spans:
        if start is None or s > upto:
            if start is not None:
                removed += upto - start
                count += 1
            kept.append(data[upto:s])
            start, upto = s, e
        else:
            upto = max(upto, e)
    if start is not None:
        removed += upto - start
        count += 1
    kept.append(data[upto:])
    return b"".join(kept), removed, count


def removed(docs: DataFrame) -> DataFrame:
    """(doc_id, kept binary or null, kept_sha256, n_bytes, n_removed, n_spans) of every row of ``docs``.

    ``kept`` is null where nothing goes: the text stays as it is.  Null and empty texts have no bytes, and
    texts under LENGTH bytes have no windows.  Rows with equal texts repeat each other whole, whether their ids
    are equal, different or null.  Repeated rows stay repeated; an empty table gives an empty result; further
    columns are ignored.
    """
    spans = settled(repeats(docs), "suffix-spans").withColumnsRenamed({"doc_id": "s_id", "copy": "s_copy"})
    texts = _encoded(docs)
    touched = _sieved(texts, spans.select(F.col("s_copy").alias("copy")))
    joined = touched.join(spans, same(touched["doc_id"], spans["s_id"]) & (touched["copy"] == spans["s_copy"]))
    names = ["doc_id", "kept", "kept_sha256", "n_bytes", "n_removed", "n_spans"]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                rows = []
                for text, spans in zip(part.column("text"), part.column("spans").to_pylist()):
                    data = text.as_py().encode("utf-8", "surrogatepass")
                    kept, gone, count = _kept(data, [(x["s"], x["e"]) for x in spans])
                    rows.append((kept, hashlib.sha256(kept).hexdigest(), len(data), gone, count))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), pa.string(), *[pa.int64()] * 3))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names)

    cut = joined.select("doc_id", "text", "spans").mapInArrow(
        run, "doc_id long, kept binary, kept_sha256 string, n_bytes long, n_removed long, n_spans long"
    )
    digests = texts.select(
        "doc_id", "copy", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
        F.octet_length("text").cast("long").alias("n_bytes"),
    )
    known = spans.select("s_id", "s_copy")
    rest = digests.join(known, same(digests["doc_id"], known["s_id"]) & (digests["copy"] == known["s_copy"]), "left_anti")
    nothing = F.lit(0).cast("long")
    return cut.unionByName(
        rest.select("doc_id", F.lit(None).cast("binary").alias("kept"), "kept_sha256", "n_bytes", nothing.alias("n_removed"), nothing.alias("n_spans"))
    )


def report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: n_bytes, n_removed, n_spans, kept_sha256 (cases as in ``removed``)."""
    return removed(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


#: The contract of the report in DuckDB: every window of 200 bytes, counted as it is.
ORACLE = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
windows AS (SELECT r, s, array_slice(b, s, s + 199) AS w FROM (SELECT r, b, unnest(range(1, octet_length(b) - 198)) AS s FROM docs) x),
often AS (SELECT md5(w) AS m FROM windows GROUP BY 1 HAVING count(*) > 1),
hits AS (SELECT r, s, lag(s) OVER (PARTITION BY r ORDER BY s) AS p FROM windows WHERE md5(w) IN (SELECT m FROM often)),
marked AS (SELECT r, s, sum(CASE WHEN p IS NULL OR s > p + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY s) AS span FROM hits),
spans AS (SELECT r, span, min(s) AS lo, max(s) + 199 AS hi FROM marked GROUP BY 1, 2),
pieces AS (SELECT r, coalesce(lag(hi) OVER (PARTITION BY r ORDER BY span), 0) + 1 AS a, lo - 1 AS z FROM spans
           UNION ALL SELECT docs.r, coalesce(max(hi), 0) + 1, octet_length(any_value(b)) FROM docs LEFT JOIN spans ON spans.r = docs.r GROUP BY docs.r),
kept AS (SELECT r, string_agg(hex(array_slice(b, a, z)), '' ORDER BY a) AS h FROM pieces JOIN docs USING (r) WHERE z >= a GROUP BY r),
gone AS (SELECT r, sum(hi - lo + 1) AS n_removed, count(*) AS n_spans FROM spans GROUP BY r)
SELECT doc_id, octet_length(b) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(h, ''))) AS kept_sha256
FROM docs LEFT JOIN kept USING (r) LEFT JOIN gone USING (r)"""
