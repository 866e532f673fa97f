"""Periodic runs against a direct search over all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from lifeloom.llm import periods


def plain_runs(words):
    """Every maximal stretch of every period, smallest period kept."""
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                best.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted((s, e, q) for (s, e), q in best.items())


def plain_words(doc_id, text):
    words = [w for w in (text or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def plain_report(doc_id, text):
    words = plain_words(doc_id, text)
    runs = plain_runs(words)
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    top = min(runs, key=lambda r: (r[0] - r[1], r[0], r[2]), default=None)
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in sorted(runs, key=lambda r: (r[0], r[2])))
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    four = (top[0], top[1] - top[0], top[2], 1000 * (top[1] - top[0]) // top[2]) if top else (None,) * 4
    return (doc_id, len(runs), *four, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def made(rng):
    """Words with planted repetitions, nested ones and near misses."""
    words = []
    for _ in range(rng.randrange(1, 6)):
        root = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(1, rng.choice([4, 30, 60])))]
        piece = root * rng.randrange(1, 5) + root[: rng.randrange(len(root) + 1)]
        if rng.random() < 0.3:
            piece = piece * 2
        if rng.random() < 0.3 and piece:
            piece[rng.randrange(len(piece))] = 99
        words += piece
    return words


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_many_texts_at_once(seed):
    rng = random.Random(seed)
    texts = [made(rng) for _ in range(60)]
    texts += [[rng.randrange(2) for _ in range(rng.randrange(200))] for _ in range(20)]
    texts += [texts[0], [], [7] * 500, [1, 2] * 100 + [1], [1] * 40 + [2] + [1] * 40 + [3] + [1] * 40]
    fibonacci = [[0], [0, 1]]
    while len(fibonacci[-1]) < 300:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    texts.append(fibonacci[-1])
    rng.shuffle(texts)
    starts = np.cumsum([0, *[len(t) for t in texts]])
    found = periods.runs_of(np.array([w for t in texts for w in t], dtype=np.int64), np.array([s for s, t in zip(starts, texts) if t]))
    wanted = [(s + o, e + o, q) for o, t in zip(starts.tolist(), texts) for s, e, q in plain_runs(t)]
    assert [tuple(r) for r in found.tolist()] == sorted(wanted, key=lambda r: (r[0], r[2]))


def test_every_rule_holds_the_text_of_its_halves():
    rng = random.Random(3)
    ids = np.array([rng.randrange(3) for _ in range(400)] * 2, dtype=np.int64)
    covered = set()
    for places, half, length in periods.grammar(ids, np.arange(len(ids))):
        assert 0 < half < length and len({tuple(ids[p : p + length]) for p in places}) == 1
        covered |= {int(p) + half for p in places}
    assert covered == set(range(1, len(ids)))  # every boundary belongs to some symbol


def test_report_against_plain(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        words = [f"wörd{w}" for w in made(rng)] if i % 2 else [f"w{rng.randrange(500)}" for _ in range(rng.randrange(300))]
        rows.append((i, rng.choice([" ", "\n", " \t", "\x0b\r\n"]).join(words)))
    rows += [(None, "x " * 40), (None, None), (700, ""), (701, None), rows[3], rows[3], (702, "  a b " * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in periods.report(docs).collect()), key=str)
    assert got == sorted((plain_report(*r) for r in rows), key=str)


def test_very_long_texts(spark):
    rng = random.Random(9)
    root = [f"r{rng.randrange(40)}" for _ in range(20_000)]
    texts = {1: ["a"] * 150_000, 2: root * 7 + root[:777], 3: [f"n{rng.randrange(3)}" for _ in range(120_000)]}
    docs = spark.createDataFrame([(k, " ".join(v)) for k, v in texts.items()], "doc_id long, text string")
    got = {r.doc_id: r for r in periods.report(docs).collect()}
    assert (got[1].n_runs, got[1].start, got[1].length, got[1].period, got[1].exponent_milli) == (1, 0, 150_000, 1, 150_000_000)
    assert (got[2].start, got[2].length, got[2].period) == (0, 140_777, 20_000)
    assert got[3].n_runs > 0


def test_empty_table_and_further_columns(spark):
    assert periods.report(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    docs = spark.createDataFrame([(2, "b " * 20, 1, "k", 3)], "doc_id int, text string, n_words int, kept string, runs int")
    assert [tuple(r) for r in periods.report(docs).collect()] == [plain_report(2, "b " * 20)]
