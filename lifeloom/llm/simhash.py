"""SimHash near-duplicates through a byte-position inverted index with count filtering.

A fingerprint has eight bytes.  Two fingerprints that differ in at most ``RADIUS`` = 2 bits differ in
at most two bytes, so they share at least six bytes at the same positions: that is the guaranteed
minimum of the count filter.  Cut into four pairs of byte positions, at least two pairs are whole, so
the pair meets in one of the six posting lists whose key is two whole position pairs (32 bits; a list of
a single byte would hold 1/256 of the corpus).  Pairs that meet are tallied over all eight positions,
those under six are dropped, and the rest is verified bit by bit.

A list with more than ``LONG`` members is never expanded into pairs.  Its members post the 65
fingerprints within one bit of their own instead.  Two fingerprints at distance two or less have such a
midpoint in common, and any two that post the same midpoint are within distance two; so each
midpoint's members link to its smallest one.  That finds every link, and its work is linear.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, heavy_join, same, settled

RADIUS = 2
MIN_SHARED_BYTES = 8 - RADIUS
LONG = 16
SEED = 42
#: Positional bytes of near copies: posting lists, positions of a list, and the fewest positions that a pair must share.
#: A pair of similarity 0.8 is expected to share 96 of the 120 with a standard deviation of 4.4.
LISTS, LIST_BYTES, MIN_POSITIONS = 24, 5, 76
ROUNDS = 3
#: Bounds of exact filters are loosened by this much against rounding.
SLACK = 1e-6
#: Longs that hold the parities of a text's shingles, 64 slots each.
PARITY = 4
#: Shingles whose bits are unpacked at once.
BLOCK = 1 << 17
#: Texts whose shingle sets a task holds at once.
SETS = 256


def shingles(text: str | None, width: int) -> list[bytes]:
    """Runs of ``width`` words, repeats included; the whole sequence if there are fewer; none for no words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) <= width:
        return [b" ".join(words)] if words else []
    return [b" ".join(w) for w in zip(*(words[i:] for i in range(width)))]


def fingerprint_of(hashes: np.ndarray) -> int:
    """Bit i is 1 if it is set in over half of the hashes; 0 for none."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), BLOCK):
        bits = np.unpackbits(hashes[at : at + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    ones = (counts * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(ones, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp long) of every row; null and empty texts have fingerprint 0."""


    def run(batches):
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            texts = batch.column("text")
            found = np.fromiter(
                (
                    fingerprint_of(np.fromiter((digest(s, SEED) for s in shingles(t.as_py(), width)), dtype=np.uint64))
                    for t in texts
                ),
                dtype=np.int64,
                count=len(texts),
            )
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def links(prints: DataFrame) -> DataFrame:
    """Distinct (u, v) edges that connect all fingerprints of ``prints`` (distinct ``fp``) within RADIUS bits."""
    pair = [F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]
    lists = [(a, b) for a in range(4) for b in range(a + 1, 4)]
    keys = [F.struct(F.lit(k).alias("part"), (pair[a] * 65536 + pair[b]).alias("bytes")) for k, (a, b) in enumerate(lists)]
    postings = prints.select("fp", F.explode(F.array(*keys)).alias("key")).select("fp", "key.part", "key.bytes")
    sizes = postings.groupBy("part", "bytes").agg(F.count("*").alias("n")).filter("n > 1")
    sized = settled(postings.join(sizes, ["part", "bytes"]), "simhash-lists")

    short = sized.filter(F.col("n") <= LONG)
    left = short.select("part", "bytes", F.col("fp").alias("u"))
    right = short.select("part", "bytes", F.col("fp").alias("v"))
    differing = F.col("u").bitwiseXOR(F.col("v"))
    tally = sum(
        (F.shiftrightunsigned(differing, 8 * i).bitwiseAND(F.lit(0xFF)) == 0).cast("int") for i in range(8)
    )
    verified = (
        left.join(right, ["part", "bytes"])
        .filter("u > v")
        .filter(tally >= MIN_SHARED_BYTES)
        .filter(F.bit_count(differing) <= RADIUS)
        .select("u", "v")
    )

    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
    around = (
        sized.filter(F.col("n") > LONG).select("fp").distinct()
        .select("fp", F.explode(F.transform(flips, lambda bit: F.col("fp").bitwiseXOR(bit))).alias("middle"))
    )
    centres = around.groupBy("middle").agg(F.min("fp").alias("v"), F.count("*").alias("n")).filter("n > 1").drop("n")
    stars = around.join(centres, "middle").filter("fp > v").select(F.col("fp").alias("u"), "v")
    return verified.unionByName(stars).distinct()


def groups(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links, the row's own included.  Exact copies
    share a fingerprint and are never paired: links are sought between distinct fingerprints.  Rows
    with a null doc_id keep a row; a group of only such rows has a null component.  Repeated rows
    stay repeated; an empty table gives an empty result; further columns are ignored.
    """
    prints = settled(fingerprints(docs, width), "simhash-prints")
    smallest = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    roots = settled(components(links(prints.select("fp").distinct()), "simhash-edges"), "simhash-roots")
    linked = roots.join(smallest, F.col("u") == F.col("fp")).groupBy("root").agg(F.min("low").alias("group_low"))
    lows = (
        smallest.join(roots, F.col("fp") == F.col("u"), "left").join(linked, "root", "left")
        .select("fp", F.least("low", "group_low").alias("component_id"))
    )
    lows = settled(lows, "simhash-lows")
    return prints.join(lows, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


#: Odd factors, one per position.
_ODD = np.random.default_rng(SEED).integers(0, 1 << 63, LISTS * LIST_BYTES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def positional_bytes(hashes: np.ndarray) -> np.ndarray:
    """One byte for each of LISTS x LIST_BYTES positions: of the smallest of the hashes under the position's factor."""
    lowest = np.full(LISTS * LIST_BYTES, np.iinfo(np.uint64).max, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(hashes), BLOCK // 128):
            part = hashes[at : at + BLOCK // 128, None]
            lowest = np.minimum(lowest, (part * _ODD).min(axis=0))
        # Multiplied once more, so that the byte depends on all bits of the minimum.
        return (((lowest ^ (lowest >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.uint8)


def near_prints(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, copy, node, fp, bytes): ``copy`` is a 64-bit hash of the text, ``node`` one of its words, ``bytes`` its positional bytes, eight to a long."""
    names = ["doc_id", "copy", "node", "fp", "bytes"]

    def run(batches):
        for batch in batches:
            nodes, prints, signs = [], [], []
            for t in batch.column("text"):
                each = shingles(t.as_py(), width)
                hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in each), dtype=np.uint64, count=len(each))
                nodes.append(_node(t.as_py()))
                prints.append(fingerprint_of(hashes))
                signs.append(positional_bytes(hashes).view(np.int64))
            columns = [batch.column("doc_id"), batch.column("copy"), pa.array(nodes, pa.int64()), pa.array(prints, pa.int64()), pa.array(signs, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names)

    source = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("copy"), "text")
    return source.mapInArrow(run, "doc_id long, copy long, node long, fp long, bytes array<long>")


def _node(text: str | None) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return xxhash.xxh3_64_intdigest(b" ".join(words)) - (1 << 63)


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, node, shingles): the distinct hashes of a text's shingles."""

    def run(batches):
        for batch in (whole.slice(k, SETS) for whole in batches for k in range(0, whole.num_rows, SETS)):
            texts = [t.as_py() for t in batch.column("text")]
            sets = [[h - (1 << 63) for h in {xxhash.xxh64_intdigest(s, SEED) for s in shingles(t, width)}] for t in texts]
            columns = [batch.column("doc_id"), pa.array(map(_node, texts), pa.int64()), pa.array(sets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "node", "shingles"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, node long, shingles array<long>")


def _shared_bytes(a, b):
    """How many of the bytes of two lists of longs are equal at the same place."""
    def equal(x, y):
        z = x.bitwiseXOR(y)
        for step, kept in ((4, 0x0F0F0F0F0F0F0F0F), (2, 0x0303030303030303), (1, 0x0101010101010101)):
            z = z.bitwiseOR(F.shiftrightunsigned(z, step)).bitwiseAND(F.lit(kept))
        return 8 - F.bit_count(z)

    return F.aggregate(F.zip_with(a, b, equal), F.lit(0), lambda total, x: total + x)


def _sets(asked: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, label: str) -> DataFrame:
    """``asked`` (one row per node) with the shingles of each node's text."""
    rows = asked.join(nodes.select("node", F.col("low").alias("doc_id")), "node")
    return settled(shingle_sets(docs, width).join(rows, ["doc_id", "node"]).drop("doc_id").dropDuplicates(["node"]), f"{label}-sets")


def _verified(pairs: DataFrame, nodes: DataFrame, sets_of, similarity: float, label: str) -> DataFrame:
    """Those of the pairs (u, v) of nodes whose shingle sets have the similarity: tallied first, then compared whole.

    ``sets_of`` gives the shingle sets of at least the nodes that it is asked for.
    """
    of = lambda side: nodes.select(F.col("node").alias(side), F.col("bytes").alias(f"{side}_bytes"))
    tallied = pairs.distinct().join(of("u"), "u").join(of("v"), "v").filter(_shared_bytes(F.col("u_bytes"), F.col("v_bytes")) >= MIN_POSITIONS)
    tallied = settled(tallied.select("u", "v"), f"{label}-tallied")
    sets = sets_of(tallied.select(F.col("u").alias("node")).unionByName(tallied.select(F.col("v").alias("node"))).distinct())
    of = lambda side: sets.select(F.col("node").alias(side), F.col("shingles").alias(f"{side}_set"))
    both = tallied.join(of("u"), "u").join(of("v"), "v")
    common = F.size(F.array_intersect("u_set", "v_set"))
    return settled(both.filter(common >= (F.size("u_set") + F.size("v_set") - common) * similarity).select("u", "v"), f"{label}-links")


def _between(sets: DataFrame, similarity: float) -> DataFrame:
    """(u, v): all pairs of nodes of different roots that can have the similarity, of ``sets`` (node, root, shingles).

    A text's shingles are put in one order for all texts, those that only its own root holds first, then by the number of texts
    that hold them.  A pair at the similarity shares one of the first ``size - similarity * size + 1`` of both, and from the first that
    they share on, both have room for all that they share (the prefix and position filters of exact set joins).  So what very
    many texts have in common makes no pairs.  What a pair does not share is bounded, too: the shingles of one root alone count, and
    every odd slot of one text that is even in the other (PARITY x 64 slots of the other shingles).  No filter drops a pair at the similarity.

    Texts of one root are not paired: under a shingle roots meet first, then the texts of the smaller one, then those of the larger.
    """
    rows = sets.select("node", "root", F.size("shingles").alias("size"), F.explode("shingles").alias("shingle"))
    held = rows.groupBy("shingle").agg(F.count("*").alias("n"), F.min("root").alias("a"), F.max("root").alias("b"))
    held = settled(held.filter("a <> b").select("shingle", "n"), "near-shared")
    slot = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("shingle").bitwiseAND(F.lit(63)).cast("int"))
    word = F.shiftrightunsigned("shingle", 6) % PARITY
    odd = [f"odd{k}" for k in range(PARITY)]
    shared = heavy_join(rows, held, ["shingle"], "n").groupBy("node", "root", "size").agg(
        F.array_sort(F.collect_list(F.struct("n", "shingle"))).alias("shared"),
        *[F.coalesce(F.bit_xor(F.when(word == k, slot)), F.lit(0).cast("long")).alias(c) for k, c in enumerate(odd)],
    )
    alone = F.col("size") - F.size("shared")
    first = F.greatest(F.floor(F.col("size") * (1 - similarity) + SLACK).cast("int") + 1 - alone, F.lit(0))
    spare = F.col("size") * ((1 - similarity) / (1 + similarity)) - alone
    prefix = shared.select("node", "root", "size", alone.alias("alone"), spare.alias("spare"), *odd, F.posexplode(F.slice("shared", F.lit(1), first)).alias("at", "key"))
    prefix = prefix.select("key.shingle", "root", "node", "size", "spare", (F.col("size") - F.col("alone") - F.col("at")).alias("room"), *odd)
    prefix = settled(prefix, "near-prefixes")

    # Of a root's texts under a shingle the largest room and spare and the smallest size; the slots only of a single text.
    single = [F.when(F.count("*") == 1, F.any_value(c)).alias(c) for c in odd]
    ends = prefix.groupBy("shingle", "root").agg(F.count("*").alias("n"), F.min("size").alias("size"), F.max("spare").alias("spare"), F.max("room").alias("room"), *single)
    room = F.least("u_room", "v_room") >= (F.col("u_size") + F.col("v_size")) * (similarity / (1 + similarity)) - SLACK
    differing = sum(F.bit_count(F.col(f"u_{c}").bitwiseXOR(F.col(f"v_{c}"))) for c in odd)
    fits = room & (F.col("u_spare") + F.col("v_spare") + SLACK >= F.coalesce(differing, F.lit(0)))
    of = lambda df, side: df.select("shingle", *[F.col(c).alias(f"{side}_{c}") for c in df.columns if c != "shingle"])
    smaller = F.struct("u_n", "u_root") < F.struct("v_n", "v_root")
    roots = of(ends, "u").join(of(ends, "v"), "shingle").filter(smaller & fits).select("shingle", "u_root", "v_root")
    pairs = roots.join(of(prefix, "u"), ["shingle", "u_root"]).join(of(prefix, "v"), ["shingle", "v_root"]).filter(fits)
    return pairs.select(F.greatest("u_node", "v_node").alias("u"), F.least("u_node", "v_node").alias("v"))


def near_groups(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """(doc_id, component_id) of every row: groups of exact copies, of fingerprints within RADIUS bits, and of texts whose
    sets of ``width``-word shingles have at least ``similarity`` (intersection over union).

    At a similarity of 0.8 SimHash bytes share no guaranteed minimum of positions.  So for this the same index is kept over
    LISTS x LIST_BYTES bytes of minimal shingle hashes, which agree at a position as often as the sets are similar.
    Pairs meet in one of LISTS posting lists of LIST_BYTES positions each (a pair at 0.8 misses all of them with probability below
    0.0001), are tallied over all positions (under MIN_POSITIONS they go) and verified on whole shingle sets.
    Lists of more than LONG texts are not paired: their texts meet the list's centre, in ROUNDS rounds with another centre.  Texts
    of lists that are then still of different groups meet under their rarest shingles instead (``_between``), which loses no pair.

    Nulls, ties and repeated rows as in ``groups``.
    """
    return _near_members(docs, width, similarity).select("doc_id", "component_id")


def _near_members(docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """(doc_id, copy, node, component_id, kept) of every row: ``kept`` is the node of the group's smallest (doc_id, node)."""
    prints = settled(near_prints(docs, width), "near-prints")
    nodes = settled(prints.groupBy("node").agg(F.min("doc_id").alias("low"), F.any_value("fp").alias("fp"), F.any_value("bytes").alias("bytes")), "near-nodes")
    heads = nodes.groupBy("fp").agg(F.min("node").alias("head"))
    near = links(nodes.select("fp").distinct())
    edges = nodes.join(heads, "fp").select(F.col("node").alias("u"), F.col("head").alias("v")).filter("u <> v")
    of = lambda side: heads.select(F.col("fp").alias(side), F.col("head").alias(f"{side}_head"))
    edges = edges.unionByName(near.join(of("u"), "u").join(of("v"), "v").select(F.col("u_head").alias("u"), F.col("v_head").alias("v")))

    named = nodes.filter("low is not null")
    digits = F.flatten(F.transform("bytes", lambda x: F.transform(F.sequence(F.lit(0), F.lit(56), F.lit(8)), lambda i: F.call_function("shiftrightunsigned", x, i).bitwiseAND(F.lit(255)))))
    keys = F.transform(F.sequence(F.lit(0), F.lit(LISTS - 1)), lambda k: F.xxhash64(k, F.slice(digits, k * LIST_BYTES + 1, F.lit(LIST_BYTES))))
    postings = settled(named.select("node", F.explode(keys).alias("list")), "near-postings")
    sizes = postings.groupBy("list").agg(F.count("*").alias("size")).filter("size > 1")
    met = settled(postings.join(sizes, "list"), "near-lists")
    short, long = met.filter(F.col("size") <= LONG), settled(met.filter(F.col("size") > LONG).select("list", "node"), "near-long")
    pairs = short.select("list", F.col("node").alias("u")).join(short.select("list", F.col("node").alias("v")), "list").filter("u > v").select("u", "v")
    found, sets_of = edges, lambda asked: _sets(asked, nodes, docs, width, "near")
    if not long.isEmpty():
        for turn in range(ROUNDS):
            centres = long.groupBy("list").agg(F.min_by("node", F.xxhash64("node", F.lit(turn))).alias("v"))
            pairs = pairs.unionByName(long.join(centres, "list").select(F.col("node").alias("u"), "v").filter("u <> v"))
        found = settled(edges.unionByName(_verified(pairs, nodes, sets_of, similarity, "near-first")), "near-found")
        roots = components(found, "near-edges")
        placed = long.join(roots, F.col("node") == F.col("u"), "left").select("list", "node", F.coalesce("root", "node").alias("root"))
        open_ = placed.groupBy("list").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b").select("list")
        sets = sets_of(settled(placed.join(open_, "list").select("node", "root").distinct(), "near-open"))
        pairs, sets_of = _between(sets, similarity), lambda asked: sets
    found = found.unionByName(_verified(pairs, nodes, sets_of, similarity, "near-last"))
    roots = settled(components(found, "near-edges"), "near-roots")
    member = nodes.join(roots, F.col("node") == F.col("u"), "left").select("node", "low", F.coalesce("root", "node").alias("root"))
    first = member.groupBy("root").agg(F.min(F.when(F.col("low").isNotNull(), F.struct("low", "node"))).alias("first"))
    lows = member.join(first, "root").select("node", F.col("first.low").alias("component_id"), F.col("first.node").alias("kept"))
    return prints.select("doc_id", "copy", "node").join(settled(lows, "near-lows"), "node")


def keep_one(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that stay: of each group of ``near_groups`` the text with the smallest (doc_id, node).

    All columns of ``docs`` are kept.  Rows of one doc_id are told apart by their texts: a row goes only if its own text is
    in a group of which another row stays.  Rows with a null doc_id stay, and so do repeated rows of the text that stays.
    """
    member = _near_members(docs, width, similarity)
    stays = (F.col("doc_id") == F.col("component_id")) & (F.col("node") == F.col("kept"))
    gone = member.filter(F.col("doc_id").isNotNull() & ~stays).select(F.col("doc_id").alias("_gone"), F.col("copy").alias("_copy")).distinct()
    return docs.join(gone, same(docs["doc_id"], gone["_gone"]) & same(F.xxhash64(docs["text"]), gone["_copy"]), "left_anti")
