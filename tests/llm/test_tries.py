"""Conversation trie against a plain dictionary of prefixes."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lifeloom.llm import tries

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns, key=lambda t: t[:3])] for c, turns in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(abs(c) % 20) * (1 if c >= 0 else -1)
        paths[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    out, children, leaves, saved = [], defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, who in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(who) - 1) * words
            leaves[node[:d]] += children[node] == 0
    for node, who in members.items():
        ends = ",".join(map(str, sorted(c for c in who if len(paths[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(who), len(node), parent, len(who), children[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def made(seed, conversations):
    rng = random.Random(seed)
    texts = ["", "hello", "hello there,\tyou", "yes", "no\x0bno", "a b c d", None, "ö ö"]
    rows = []
    for c in rng.sample(range(-60, 4000), conversations):
        kind = rng.random()
        if kind < 0.4:  # one conversation, many copies
            rows += [(c, t, "user", x) for t, x in enumerate(["the same", "long talk", "of five", "turns in", "all"])]
        elif kind < 0.6:  # a beginning of it
            rows += [(c, t, "user", x) for t, x in enumerate(["the same", "long talk", "of five"][: rng.randrange(1, 4)])]
        else:
            rows += [(c, rng.choice([t, t, None]) if not t else t, rng.choice(["user", "assistant", None]), rng.choice(texts)) for t in range(rng.randrange(1, 7))]
    rows += [(None, 0, "user", "nobody"), rows[3], rows[3], (9000, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,conversations,shard", [(1, 300, 40), (2, 900, 100_000), (3, 40, 1)])
def test_nodes(spark, seed, conversations, shard):
    rows = made(seed, conversations)
    got = tries.trie(tries.rebuilt(spark.createDataFrame(rows, SCHEMA)), shard).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows)


def test_hot_copies_over_many_shards_and_a_long_conversation(spark):
    rows = [(i, t, "user", x) for i in range(0, 20_000, 20) for t, x in enumerate(["same words here", "again the same"])]
    rows += [(1_000_000, t, "assistant", f"turn {t}") for t in range(3000)]
    rows += [(1_000_020, t, "assistant", f"turn {t}") for t in range(2500)]
    got = tries.trie(tries.rebuilt(spark.createDataFrame(rows, SCHEMA)), 700).collect()
    # Plain prefixes of thousands of turns would be too dear: check the counts that follow from the shape.
    by = {(r.conv_id, r.depth): r for r in got}
    assert len(got) == 1 + 2 + 3000
    assert (by[0, 0].n_convs, by[0, 0].n_children, by[0, 0].n_leaves) == (1002, 2, 2)
    assert by[0, 2].ends_sha256 == hashlib.sha256(",".join(str(i) for i in range(0, 20_000, 20)).encode()).hexdigest()
    assert (by[1_000_000, 2500].n_convs, by[1_000_000, 2501].n_convs, by[1_000_000, 3000].parent_conv_id) == (2, 1, 1_000_000)
    assert by[0, 0].saved_tokens == 999 * 6 + 2500 * 2 and by[1_000_000, 1].saved_tokens == 2500 * 2


def test_tree_is_searched_by_halves():
    tree = tries.TernaryTree()
    for i in tries.medians(1000):
        tree.insert([i], 1, i, i)
    longest, stack = 0, [(tree.below[0], 1)]
    while stack:
        node, steps = stack.pop()
        longest = max(longest, steps)
        stack += [(n, steps + 1) for n in (tree.low[node], tree.high[node]) if n >= 0]
    assert longest <= 10 and sorted(tree.code[1:]) == list(range(1000))


def test_empty_table_and_further_columns(spark):
    assert tries.report(spark.createDataFrame([], SCHEMA)).collect() == []
    assert tries.report(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).collect() == []
    rows = [(5, 1, "user", "a b"), (25, 1, "user", "a b"), (7, 2, None, None)]
    docs = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    more = docs.select("*", *[F.lit(1).alias(c) for c in ("family", "path", "shard", "kind", "node", "k1", "words", "own")])
    assert sorted((tuple(r) for r in tries.report(more).collect()), key=str) == plain(rows)
