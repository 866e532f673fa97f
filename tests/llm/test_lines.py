"""Line dedup against a plain loop."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from lifeloom.llm import lines

BLANKS = " \t\n\x0b\x0c\r"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, min_docs=2, min_chars=10):
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders[line.strip(BLANKS).translate(FOLD)].add(doc)
    out = []
    for doc, text in rows:
        parts = (text or "").split("\n")
        kept = []
        for line in parts:
            key = line.strip(BLANKS).translate(FOLD)
            who = holders[key]
            keeper = min((d for d in who if d is not None), default=None)
            if len(key) < min_chars or len(who) < min_docs or doc == keeper:
                kept.append(line)
        out.append((doc, "\n".join(kept), len(parts), len(parts) - len(kept)))
    return out


def run(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return [tuple(r) for r in lines.without_repeats(docs, **options).collect()]


@pytest.mark.parametrize("seed,min_docs", [(1, 2), (2, 2), (3, 3)])
def test_random_texts(spark, seed, min_docs):
    rng = random.Random(seed)
    pool = ["A common line here", "  a COMMON line here\t", "short", "", "ÄÖÜ äöü ßßß 1", "ÄÖÜ äöü ßßß 1\r", "äöü äöü ßßß 1", "one more line, rare"]
    pool += [f"line number {i} of the pool" for i in range(30)]
    rows = [(rng.choice([i, None, 3, -7]), "\n".join(rng.choices(pool, k=rng.randrange(9)))) for i in range(120)]
    rows += [rows[5], rows[5], (500, None), (501, ""), (None, None), (502, "\n\n"), (503, "\n" + pool[0] + "\n")]
    assert Counter(run(spark, rows, min_docs=min_docs)) == Counter(plain(rows, min_docs=min_docs))


def test_hot_line_and_long_text(spark):
    rows = [(i, f"everywhere the same line\nown line number {i}") for i in range(3000)]
    rows.append((5000, "\n".join(f"long text, line {i}" for i in range(200_000)) + "\neverywhere the same line"))
    rows.append((5001, "\n".join(f"long text, line {i}" for i in range(0, 200_000, 2))))
    assert Counter(run(spark, rows)) == Counter(plain(rows))


def test_empty_table_and_further_columns(spark):
    assert run(spark, []) == []
    schema = "doc_id int, text string, pos string, k1 int, gone string, n_docs int, copy int, keeper int"
    docs = spark.createDataFrame([(1, "a line to drop", "x", 1, "y", 2, 3, 4), (2, "A LINE TO DROP", "x", 1, "y", 2, 3, 4)], schema)
    digest = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in lines.report(docs).collect()}
    assert digest == {1: (1, 0, hashlib.sha256(b"a line to drop").hexdigest()), 2: (1, 1, hashlib.sha256(b"").hexdigest())}
