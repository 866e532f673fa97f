"""Prefix trie of conversations: who shares which first turns, and what sharing them saves.

1. A turn is known by two 64-bit hashes of role and text and carries its number of words; texts are not moved.  A
   conversation becomes the list of its turns (24 bytes each, in one row, as a document's text is).
2. The lists are dealt by range of (list, id) into shards of bounded size, so copies of one conversation spread too.
   Within a shard, turns are numbered by a dictionary in sorted order and the distinct lists go into a ternary search tree,
   medians first, so that the comparisons at each turn form a balanced tree.
3. A traversal with a stack of its own sums members, leaves and savings up to the shard's root.  Every sum is a sum over
   shards: a node is counted as new by the first shard that has it and as childless by the last one.  For that a shard gets
   the list before its first and the list after its last.
4. Nodes on those two lists are all that shards can share.  Their parts are merged by node; all other nodes are complete
   in their shard.  Digests of members are continued from part to part in order, never gathered.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import same, settled

#: Turns and conversations per shard.
SHARD = 200_000
#: Conversations per family, and one more than the most turns taken from its first.
FAMILY, HEADS = 20, 4
WORD = r"[^\x20\x09-\x0D]+"

_CRC = """list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split({0}, ''), lambda c: ascii(c)::UBIGINT)),
    lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
        lambda x, i: xor(x >> 1, 3988292384::UBIGINT * (x & 1))))"""
ORACLE = f"""
WITH own AS (SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns
             FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (SELECT conv_id, turns, xor({_CRC.format("CAST(conv_id AS VARCHAR)")}, 4294967295::UBIGINT) % 4 AS h FROM own),
rebuilt AS (SELECT c.conv_id, list_concat(list_slice(coalesce(b.turns, []), 1, c.h), list_slice(c.turns, c.h + 1, len(c.turns))) AS path
            FROM heads c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20),
prefixes AS (SELECT conv_id, len(path) AS n, d AS depth, list_slice(path, 1, d) AS node, list_slice(path, 1, d - 1) AS parent, path[d].text AS last
             FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM rebuilt) r),
nodes AS (SELECT node, any_value(parent) AS parent, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(n) = depth AS childless,
                 (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(any_value(last), '[^\\x20\\x09-\\x0D]+')) END AS saved,
                 sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
          FROM prefixes GROUP BY node, depth),
below AS (SELECT list_slice(node, 1, d) AS top, d AS depth, count(*) FILTER (childless) AS n_leaves, sum(saved) AS saved
          FROM (SELECT *, unnest(range(depth + 1)) AS d FROM nodes) x GROUP BY 1, 2),
kids AS (SELECT parent, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, CAST(coalesce(k.n_children, 0) AS BIGINT) AS n_children, b.n_leaves,
       CAST(b.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.top = n.node AND b.depth = n.depth
LEFT JOIN kids k ON k.parent = n.node AND k.depth = n.depth LEFT JOIN nodes p ON n.depth > 0 AND p.node = n.parent AND p.depth = n.depth - 1"""


# ---------------------------------------------------------------- conversations


def rebuilt(conversations: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """(conv_id, path): the first h turns of the family's first conversation, then the own turns after the first h.

    One exchange, by family: turns are listed and the family's head is looked up in the partition that has them all.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    conv = F.col("conv_id").cast("long")
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        (conv - conv % family).alias("family"),
        conv.alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.xxhash64(role, text).alias("k1"),
        F.xxhash64(F.lit(2), text, role).alias("k2"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    own = turns.repartition("family").groupBy("family", "conv_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("turn", "role", "k1", "k2", "words"))), lambda t: F.struct(t["k1"].alias("k1"), t["k2"].alias("k2"), t["words"].alias("words"))).alias("own")
    )
    head = F.when(F.col("conv_id") == F.col("family"), F.slice("own", 1, heads - 1))
    own = own.withColumn("head", F.max(head).over(W.partitionBy("family")))
    taken = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    none = F.slice("own", 1, 0)
    path = F.concat(F.coalesce(F.slice("head", F.lit(1), taken), none), F.slice("own", taken + 1, F.size("own")))
    return own.select("conv_id", path.alias("path"))


# ---------------------------------------------------------------- one shard


class TernaryTree:
    """Ternary search tree of code lists: at each node lower and higher siblings, and below it the next turn.

    Node 0 is the root of the trie.  Every node knows its trie parent and sums the weights of the lists through it.
    """

    def __init__(self) -> None:
        self.code, self.low, self.high, self.below = [-1], [-1], [-1], [-1]
        self.parent, self.depth, self.members, self.smallest, self.ends = [-1], [0], [0], [None], [-1]

    def _new(self, code: int, parent: int) -> int:
        for column, value in (
            (self.code, code), (self.low, -1), (self.high, -1), (self.below, -1), (self.parent, parent),
            (self.depth, self.depth[parent] + 1), (self.members, 0), (self.smallest, None), (self.ends, -1),
        ):
            column.append(value)
        return len(self.code) - 1

    def child(self, node: int, code: int) -> int:
        """The node below ``node`` with this code, or -1."""
        at = self.below[node]
        while at >= 0 and self.code[at] != code:
            at = self.low[at] if code < self.code[at] else self.high[at]
        return at

    def _child_or_new(self, node: int, code: int) -> int:
        at = self.below[node]
        if at < 0:
            self.below[node] = at = self._new(code, node)
            return at
        while self.code[at] != code:
            side = self.low if code < self.code[at] else self.high
            if side[at] < 0:
                side[at] = self._new(code, node)
            at = side[at]
        return at

    def insert(self, codes: list[int], members: int, smallest: int, mark: int) -> None:
        node = 0
        for step in range(len(codes) + 1):
            if step:
                node = self._child_or_new(node, codes[step - 1])
            self.members[node] += members
            known = self.smallest[node]
            self.smallest[node] = smallest if known is None else min(known, smallest)
        self.ends[node] = mark

    def top_down(self) -> list[int]:
        """All nodes, each after its trie parent."""
        order, stack = [], [0]
        while stack:
            node = stack.pop()
            order.append(node)
            stack += [n for n in (self.low[node], self.high[node], self.below[node]) if n >= 0]
        return order


def medians(n: int):
    """0 .. n-1, the middle of every range before its halves."""
    stack = [(0, n)]
    while stack:
        lo, hi = stack.pop()
        if lo < hi:
            mid = (lo + hi) // 2
            yield mid
            stack += [(lo, mid), (mid + 1, hi)]


OUT = {
    "shard": pa.int64(), "depth": pa.int64(), "conv_id": pa.int64(), "parent_conv_id": pa.int64(), "node": pa.binary(),
    "parent_node": pa.binary(), "n_convs": pa.int64(), "n_children": pa.int64(), "n_leaves": pa.int64(),
    "saved_tokens": pa.int64(), "ends": pa.string(), "ends_sha256": pa.string(),
}
OUT_SCHEMA = (
    "shard long, depth long, conv_id long, parent_conv_id long, node binary, parent_node binary, n_convs long,"
    " n_children long, n_leaves long, saved_tokens long, ends string, ends_sha256 string"
)


def shard_nodes(shard: int, kinds, convs, sizes, k1, k2, words) -> dict[str, list]:
    """The nodes of one shard; rows come in order: the list before (kind 0), the conversations (1), the list after (2)."""
    ends = np.cumsum(sizes)
    begin = ends - sizes
    # Codes by sorted turn, so that lists compare by code as they do by turn.
    keys = np.empty(len(k1), dtype=[("a", np.int64), ("b", np.int64)])
    keys["a"], keys["b"] = k1, k2
    known, at, codes = np.unique(keys, return_index=True, return_inverse=True)
    cost = words[at].tolist()
    codes = codes.tolist()
    lists: list[tuple[list[int], int, int]] = []  # codes, first and last row
    outside: dict[int, list[int]] = {}
    for i, (kind, s, e) in enumerate(zip(kinds.tolist(), begin.tolist(), ends.tolist())):
        own = codes[s:e]
        if kind != 1:
            outside[kind] = own
        elif lists and lists[-1][0] == own:
            lists[-1] = (own, lists[-1][1], i + 1)
        else:
            lists.append((own, i, i + 1))
    tree = TernaryTree()
    for i in medians(len(lists)):
        own, first, last = lists[i]
        tree.insert(own, last - first, int(convs[first:last].min()), i)

    def along(kind: int) -> set[int]:
        """Nodes that the list outside the shard goes through as well."""
        found, node = set(), 0
        if kind in outside:
            found.add(0)
            for code in outside[kind]:
                node = tree.child(node, code)
                if node < 0:
                    break
                found.add(node)
        return found

    before, after = along(0), along(2)
    n = len(tree.code)
    children, leaves, saved = [0] * n, [0] * n, [0] * n
    order = tree.top_down()
    for node in reversed(order):
        price = cost[tree.code[node]] if node else 0
        fresh = node not in before
        saved[node] += tree.members[node] * price - (price if fresh else 0)
        if tree.below[node] < 0 and node not in after:
            leaves[node] += 1
        up = tree.parent[node]
        if up >= 0:
            children[up] += fresh
            leaves[up] += leaves[node]
            saved[up] += saved[node]
    shared = before | after
    names: dict[int, bytes] = {}
    rows: dict[str, list] = {name: [] for name in OUT}
    for node in order:
        up = tree.parent[node]
        if node in shared:
            turn = known[tree.code[node]].tobytes() if node else b""
            names[node] = hashlib.blake2b(names.get(up, b"") + turn, digest_size=16).digest()
        listed = ""
        if tree.ends[node] >= 0:
            _, first, last = lists[tree.ends[node]]
            listed = ",".join(map(str, convs[first:last].tolist()))
        closed = node not in shared
        values = (
            shard, tree.depth[node], tree.smallest[node], tree.smallest[up] if up >= 0 and up not in shared else None,
            names.get(node), names.get(up), tree.members[node], children[node], leaves[node], saved[node],
            None if closed else listed, hashlib.sha256(listed.encode()).hexdigest() if closed else None,
        )
        for name, value in zip(rows, values):
            rows[name].append(value)
    return rows


def _shards(batches):
    """The pieces of each shard from batches sorted by shard."""
    pending, now = [], None
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        cuts = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1]))).tolist() if len(shard) else []
        for s, e in zip(cuts, [*cuts[1:], len(shard)]):
            if pending and shard[s] != now:
                yield now, pending
                pending = []
            now = int(shard[s])
            pending.append(batch.slice(s, e - s))
    if pending:
        yield now, pending


def _solve(batches):
    for shard, pieces in _shards(batches):
        part = pa.Table.from_batches(pieces).combine_chunks()
        path = part.column("path").combine_chunks()
        flat = path.flatten()
        turn = [pc.struct_field(flat, i).to_numpy(zero_copy_only=False) for i in range(3)]
        rows = shard_nodes(
            shard, part.column("kind").to_numpy(), part.column("conv_id").to_numpy(),
            pc.list_value_length(path).to_numpy(zero_copy_only=False).astype(np.int64), *turn,
        )
        for at in range(0, len(rows["depth"]), 20_000):
            yield pa.RecordBatch.from_arrays([pa.array(rows[c][at : at + 20_000], t) for c, t in OUT.items()], list(OUT))


def _continued(batches):
    """(node, ends_sha256): one digest per node over its parts, which come in order."""
    now, state, started = None, None, False
    done: list[tuple[bytes, str]] = []

    def packed():
        return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], ["node", "ends_sha256"])

    for batch in batches:
        for node, ends in zip(batch.column("node"), batch.column("ends")):
            node, ends = node.as_py(), ends.as_py()
            if node != now:
                if now is not None:
                    done.append((now, state.hexdigest()))
                now, state, started = node, hashlib.sha256(), False
            if ends:
                state.update((("," if started else "") + ends).encode())
                started = True
        if len(done) >= 10_000:
            yield packed()
            done = []
    if now is not None:
        done.append((now, state.hexdigest()))
    yield packed()


# ---------------------------------------------------------------- the trie


def trie(paths: DataFrame, shard_size: int = SHARD) -> DataFrame:
    """One row per distinct prefix of ``paths`` (conv_id, path: array of (k1, k2, words)); ids are distinct and not null."""
    spark = paths.sparkSession
    paths = settled(paths, "trie-paths")
    load = paths.agg(F.sum(F.size("path") + 1)).first()[0] or 0
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(tasks, -(-load // shard_size))
    dealt = paths.repartitionByRange(shards, "path", "conv_id").withColumn("shard", F.spark_partition_id().cast("long"))
    # Written, because a range is drawn anew by every run.
    dealt = settled(dealt, "trie-dealt")
    ends = dealt.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    # Two lists per shard that has rows.
    order = W.orderBy("shard")
    ends = ends.select("shard", F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("after"))
    outside = [
        ends.filter(F.col(side).isNotNull()).select(F.lit(kind).alias("kind"), F.lit(0).cast("long").alias("conv_id"), F.col(side).alias("path"), "shard")
        for kind, side in ((0, "before"), (2, "after"))
    ]
    rows = dealt.select(F.lit(1).alias("kind"), "conv_id", "path", "shard").unionByName(outside[0]).unionByName(outside[1])
    rows = rows.repartition(tasks, "shard").sortWithinPartitions("shard", "kind", "path", "conv_id")
    found = settled(rows.mapInArrow(_solve, OUT_SCHEMA), "trie-nodes")

    open_parts = found.filter(F.col("node").isNotNull())
    merged = open_parts.groupBy("node").agg(
        F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.min("parent_node").alias("parent_node"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    merged = settled(merged, "trie-merged")
    digests = (
        open_parts.select("node", "shard", "ends").repartition(tasks, "node").sortWithinPartitions("node", "shard")
        .mapInArrow(_continued, "node binary, ends_sha256 string")
    )
    names = merged.select(F.col("node").alias("p_node"), F.col("conv_id").alias("p_conv"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    shared = (
        merged.join(digests, "node").join(names, F.col("parent_node") == F.col("p_node"), "left")
        .withColumn("parent_conv_id", F.col("p_conv")).select(*columns)
    )
    # A shard gets the merged ids of its own shared nodes, so that children of one node are looked up shard by shard.
    here = open_parts.select("node", F.col("shard").alias("p_shard")).join(names, F.col("node") == F.col("p_node")).select("p_shard", "p_node", "p_conv")
    closed = found.filter(F.col("node").isNull())
    closed = closed.join(here, same(closed["shard"], here["p_shard"]) & (closed["parent_node"] == here["p_node"]), "left")
    return closed.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "p_conv")).select(*columns).unionByName(shared)


def report(conversations: DataFrame) -> DataFrame:
    """The contract's columns, one row per node of the rebuilt conversations' trie.

    Rows without conv_id belong to no conversation.  Null roles and texts are empty.  Turns of one number
    order by role, then by a hash of the text; repeated rows are turns like any other.  An empty table has no members and so no root: no rows.
    Further columns are ignored.  Turns are told apart by 128 bits of hash of role and text.
    """
    return trie(rebuilt(conversations))
