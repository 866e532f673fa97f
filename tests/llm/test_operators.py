"""Every operator against a brute-force version on small tables with nulls, empty and repeated texts and clashing columns."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
import xxhash

from lifeloom.llm import decontaminate, imatch, lattice, licences, pii, quality, secrets, simhash, suffixes, urls

EXTRA = "copy STRING, word STRING, n INT, row INT, fp INT"
WORDS = "amber basin cedar delta ember fjord grove haven inlet jetty knoll ledge meadow north ocean".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(30)) for _ in range(n))


def texts():
    base = prose(1, 120)
    return [
        (1, base), (2, base), (3, base.replace("amber", "umber", 1)), (4, None), (5, ""), (6, "  \n\t "), (7, "Ünïcode ▁ 日本語 text"),
        (8, prose(2, 90) + " All Rights Reserved. cc-by " + prose(3, 20)), (9, "x" * 700), (None, base), (11, "one two"), (11, "one two"),
        (12, prose(4, 3000)), (13, "This work is licensed under the GNU General Public License, version 3."), (14, "token = \"9f86d081884c7d659a2feaa0c55ad015\" end"),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    """documents with further columns whose names the operators use themselves."""
    rows = [(i, t, "en", "src0", len(t or ""), "c", "w", 1, 2, 3) for i, t in texts()]
    return spark.createDataFrame(rows, f"doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, {EXTRA}").repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def words_of(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def test_licences(docs, none):
    phrases = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}

    def brute(i, t):
        w = words_of(t)
        at = [(k, label) for label, p in phrases.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        places = [k for k, _ in at]
        return (i, len(w), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at})))

    got = licences.report(docs).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=key) == sorted((brute(*x) for x in texts()), key=key)
    by = {r.doc_id: r for r in got}
    assert by[13].labels == "gpl,gpl-3.0" and by[8].labels == "cc-by,reserved" and all(0 <= r.score <= 1 for r in got)
    assert licences.report(none).count() == 0


def test_decontamination(spark, docs, none):
    w = texts()[7][1].split()
    items = [(1, " ".join(w[5:30])), (2, "one, TWO"), (3, None), (4, ""), (None, prose(9, 12)), (5, " ".join(w[5:30])), (6, " ".join(w[40:49] + ["odd"]))]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id LONG, text STRING, word STRING")

    def brute(i, t):
        d, hit, ids = words_of(t), set(), set()
        for item, text in items:
            q = words_of(text)
            k = min(10, len(q))
            for a in range(len(q) - k + 1 if k else 0):
                for b in range(len(d) - k + 1):
                    if d[b : b + k] == q[a : a + k]:
                        hit.update(range(b, b + k))
                        ids.add(str(item if item is not None else ""))
        return (i, len(d), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit))

    got = [tuple(r)[:6] for r in decontaminate.report(docs, bench).collect()]
    assert sorted(map(str, got)) == sorted(str(brute(*x)) for x in texts())
    assert decontaminate.report(none, bench).count() == 0
    assert not decontaminate.report(docs, bench.limit(0)).filter("contaminated").count()
    assert sorted(map(str, got)) == sorted(str(tuple(r)[:6]) for r in _blocked(docs, bench))
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(g[0]) for g in got if not g[5])


def _blocked(docs, bench):
    """The report with the vocabulary in blocks of about seven words."""
    sizes, blocks = [], decontaminate._blocks

    def watched(words, limit):
        for block in blocks(words, limit):
            sizes.append(len(block))
            yield block

    decontaminate._blocks = watched
    try:
        return decontaminate.report(docs, bench, block_terms=7).collect()
    finally:
        decontaminate._blocks = blocks
        assert len(sizes) > 4 and max(sizes) < 40


def test_imatch(docs, none):
    got = imatch.report(docs).collect()
    assert len(got) == len(texts()) and imatch.report(none).count() == 0
    distinct = {(i, t or "") for i, t in texts() if i is not None}
    order = sorted(distinct, key=lambda x: -x[0]) + [(None, texts()[9][1])]
    want = {}
    for k, (i, t) in enumerate(order):
        follow, n = order[(k + 1) % len(order)][1], len(t) // 3
        want[i] = (len(t), hashlib.sha256((t[: len(t) - n] + follow[:n]).encode()).hexdigest())
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == want
    by = {r.doc_id: r for r in got}
    assert by[1].fingerprint == by[2].fingerprint == by[None].fingerprint and by[2].near_next == 1.0
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_pii(docs, none):
    cases = {
        "a joe@x.org b": ["joe@x.org"], "ip 1.2.3.4 and 999.1.1.1": ["1.2.3.4"], "4111 1111 1111 1111": ["4111 1111 1111 1111"],
        "+1 (528) 555-3435 x": ["+1 (528) 555-3435"], "joe (at) mail [dot] org": ["joe (at) mail [dot] org"],
        "bob@exаmple.com": ["bob@exаmple.com"], "call five five five one two three four five six seven now": ["five five five one two three four five six seven"],
        "meet at noon": [], "": [],
    }
    for text, found in cases.items():
        plain, extra = pii.spans_of(text)
        assert [text[a:b] for _, a, b in plain + extra] == found, text
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    r = random.Random(5)
    for _ in range(3000):
        text = "".join(r.choice("ab1.@%- ") for _ in range(20))
        assert [(a, b) for _, a, b in pii.emails(text)] == [m.span() for m in email.finditer(text)], text
    assert pii.report(docs).count() == len(texts()) and pii.report(none).count() == 0
    assert pii.find(docs).filter("size(found) > 0").count() == 0


def test_secrets(docs, none):
    found = secrets.report(docs).collect()
    assert {r.doc_id for r in found if r.secret} == {14}
    out = {r.doc_id: r for r in secrets.redacted(docs).collect()}
    assert out[14].text == 'token = "<SECRET>" end' and out[14].n_chars == len(out[14].text) and out[4].text is None
    assert secrets.redacted(docs).columns == docs.columns and secrets.redacted(docs).count() == len(texts())
    assert secrets.report(none).count() == 0


def test_quality(spark, none):
    good = [(i, "\n".join(f"The {prose(i * 9 + k, 8)} ends well." for k in range(5)), 1) for i in range(60)]
    bad = [(100 + i, "\n".join("### $$$ " + prose(i, 3).upper() + "!! ***" for _ in range(5)), 0) for i in range(60)]
    docs = spark.createDataFrame([(i, t, 7) for i, t, _ in good + bad] + [(500, None, 1), (None, "", 1)], "doc_id LONG, text STRING, quality INT")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in good + bad], "doc_id LONG, quality INT, toxic INT")
    got = quality.report(docs, labels).collect()
    held = [r for r in got if r.held_out and r.doc_id < 200]
    assert held and all((r.predicted == 1) == (r.doc_id < 100) for r in held) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in quality.report(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.keep_good(docs, labels.limit(0)).count() == docs.count() and quality.report(docs.limit(0), labels).count() == 0
    lengths, score, link = np.array([3, 1]), np.array([0.3, -1.0, 0.5, 0.2]), np.array([[0.4, -0.1], [0.2, 0.7]])
    marginal, _, _ = quality.forward_backward(score, lengths, link)
    ways = [(a, b, c) for a in (0, 1) for b in (0, 1) for c in (0, 1)]
    weight = [np.exp(sum(s * y for s, y in zip(score, w)) + link[w[0], w[1]] + link[w[1], w[2]]) for w in ways]
    assert np.allclose(marginal[:3], [sum(x for x, w in zip(weight, ways) if w[k]) / sum(weight) for k in range(3)])


def test_urls(spark):
    rows = {
        None: ("", "", None), "nothing": ("", "", None), "http://WWW.Example.com/en/1?q": ("www.example.com", "/en/1", "www.example.com/en/"),
        "https://de.example.com/en/2": ("de.example.com", "/en/2", "example.com/en/"), "x://a.net/es/": ("a.net", "/es/", "net/es/"),
        "x://anet/es/": ("anet", "/es/", None), "x://b.com": ("b.com", "", None), "x://b.com/#f": ("b.com", "/", "com/"), "x://o.org/es/5": ("o.org", "/es/5", None),
    }
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate([*rows, "x://a.net/es/"])], "page_id LONG, url STRING, host STRING")
    got = {r.page_id: r for r in urls.verdicts(pages).collect()}
    assert len(got) == len(rows) + 1
    for i, (host, path, rule) in enumerate(rows.values()):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        if rule:
            assert got[i].verdict == dict((r, v) for v, r in urls.RULES)[rule]
        assert got[i].verdict in ("allow", "block")
    assert urls.verdicts(pages.limit(0)).count() == 0
    many = spark.createDataFrame([(i, f"x://s.org/{prose(i, 1)}{i}/a") for i in range(40)], "page_id LONG, url STRING")
    assert {r.template for r in urls.verdicts(many).collect()} == {"*/a"} or {r.template for r in urls.verdicts(many).collect()} <= {"*/a"} | {f"{w}{{n}}/a" for w in WORDS}


def brute_prints(rows, width):
    out = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        s = [b" ".join(w[k : k + width]) for k in range(max(1, len(w) - width + 1))] if w else []
        h = [xxhash.xxh64_intdigest(x, 42) for x in s]
        out.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    return out


def test_simhash(docs, none):
    prints = brute_prints(texts(), 3)
    low = {}
    for i, (d, _) in enumerate(texts()):
        seen, todo = {i}, [i]
        while todo:
            a = todo.pop()
            for b in range(len(prints)):
                if b not in seen and (prints[a] ^ prints[b]).bit_count() <= 2:
                    seen.add(b)
                    todo.append(b)
        ids = [texts()[k][0] for k in seen if texts()[k][0] is not None]
        low[i] = (d, f"{prints[i]:016x}", min(ids, default=None))
    assert sorted(map(str, (tuple(r) for r in simhash.groups(docs).collect()))) == sorted(map(str, low.values()))
    assert simhash.groups(none).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()).count("2") == 0


@pytest.mark.parametrize("long", [1, 16])
def test_simhash_links_with_long_and_short_lists(spark, long, monkeypatch):
    monkeypatch.setattr(simhash, "LONG", long)
    r = random.Random(7)
    some = {r.getrandbits(64) for _ in range(60)}
    for x in list(some):
        for _ in range(6):
            some.add(x ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)))
    signed = [x - (1 << 64) if x >> 63 else x for x in some]
    edges = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp LONG")).collect()
    assert all(((e.u ^ e.v) & (1 << 64) - 1).bit_count() <= 2 for e in edges)

    def roots(pairs):
        up = {x: x for x in signed}

        def find(x):
            while up[x] != x:
                x = up[x]
            return x

        for a, b in pairs:
            up[find(a)] = find(b)
        groups = defaultdict(set)
        for x in signed:
            groups[find(x)].add(x)
        return sorted(map(sorted, groups.values()))

    want = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2]
    assert roots([(e.u, e.v) for e in edges]) == roots(want)


def test_suffix_order():
    r = random.Random(3)
    for k in range(200):
        t = bytes(r.choice(b"ab" if k % 2 else b"abc\0") for _ in range(r.randint(0, 50))) * (1 + k % 3)
        assert suffixes.suffix_order(t) == sorted(range(len(t)), key=lambda i: t[i:])


@pytest.mark.parametrize("hot", [1, 4000])
def test_suffix_dedup(docs, none, hot, monkeypatch):
    monkeypatch.setattr(suffixes.repeats, "__defaults__", (hot,))
    n, rows = suffixes.LENGTH, [(i, (t or "").encode()) for i, t in texts()]
    seen = Counter(b[p : p + n] for _, b in rows for p in range(len(b) - n + 1))
    want = []
    for i, b in rows:
        mask = np.zeros(len(b), dtype=bool)
        for p in range(len(b) - n + 1):
            if seen[b[p : p + n]] > 1:
                mask[p : p + n] = True
        kept = bytes(np.frombuffer(b, dtype=np.uint8)[~mask])
        want.append((i, len(b), int(mask.sum()), len(suffixes.runs(mask)[0]), hashlib.sha256(kept).hexdigest()))
    assert sorted(map(str, (tuple(r) for r in suffixes.report(docs).collect()))) == sorted(map(str, want))
    assert suffixes.report(none).count() == 0


def test_near_groups(spark, docs, none):
    """Every pair of shingle similarity of at least 0.8 ends in one group, others do not; long lists as well as short ones."""
    r = random.Random(8)
    rows = []
    for g in range(6):
        base = prose(100 + g, 150).split()
        for k in range(40 if g == 0 else 4):
            words = list(base)
            for at in r.sample(range(150), r.choice([0, 1, 2, 3, 4, 30])):
                words[at] = f"edit{r.random()}"
            rows.append((g * 100 + k, " ".join(words)))
    sets = {i: set(simhash.shingles(t, 5)) for i, t in rows}
    root = {i: i for i in sets}

    def top(i):
        return i if root[i] == i else top(root[i])

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    got = {r.doc_id: r.component_id for r in simhash.near_groups(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect()}
    assert got == {i: top(i) for i in sets}
    assert simhash.near_groups(none).count() == 0 and simhash.keep_one(none).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i in (1, 4, 7, 8, 9, None, 11, 11, 12, 13, 14))


def test_texts_like_but_below_the_threshold_make_few_pairs(spark, monkeypatch):
    """Copies with five edits each are at about 0.7: few of the 19,900 pairs are made, and no link is lost."""
    r, base = random.Random(9), [f"w{k}" for k in range(280)]
    rows = []
    for i in range(200):
        words = rows[i - 190][1].split() if i >= 190 else list(base)
        for at in r.sample(range(280), 1 if i >= 190 else 5):
            words[at] = f"edit{i}x{at}"
        rows.append((i, " ".join(words)))
    made, verified = [], simhash._verified
    monkeypatch.setattr(simhash, "_verified", lambda pairs, *rest: made.append(pairs.distinct().count()) or verified(pairs, *rest))
    got = {x.doc_id: x.component_id for x in simhash.near_groups(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect()}

    sets, prints = [set(simhash.shingles(t, 5)) for _, t in rows], brute_prints(rows, 5)
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) or (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((root[a], root[b]))
                root = [x if k == y else k for k in root]
    assert got == dict(enumerate(root))
    assert len(set(root)) > 100 and len(made) == 2 and made[1] < 5 * len(rows), made


@pytest.mark.parametrize("similarity", [0.5, 0.8, 0.9])
def test_texts_of_open_lists_meet(spark, similarity):
    """Every pair of different roots at the similarity is found, none of one root, also where all texts share most shingles."""
    r, sets = random.Random(10), []
    for g in range(12):
        some = [r.getrandbits(64) - (1 << 63) for _ in range(r.choice([1, 2, 9, 10, 60, 700]))]
        for _ in range(12):
            own = {r.getrandbits(64) - (1 << 63) for _ in range(r.randint(0, 1 + len(some) // 4))}
            sets.append(sorted(set(r.sample(some, r.randint(max(1, len(some) * 4 // 5), len(some)))) | own))
    rows = [(i, r.choice([i, i // 3 * 3]), s) for i, s in enumerate(sets)]
    pairs = simhash._between(spark.createDataFrame(rows, "node LONG, root LONG, shingles ARRAY<LONG>"), similarity)
    got = {(p.u, p.v) for p in pairs.collect()}
    near = {(a, b) for a, _, x in rows for b, _, y in rows if a > b and len(set(x) & set(y)) >= similarity * len(set(x) | set(y))}
    across = {(a, b) for a, b in near if rows[a][1] != rows[b][1]}
    assert across and across <= got and all(a > b and rows[a][1] != rows[b][1] for a, b in got)


def test_lattice(docs, none):
    coded = lattice.encode(docs)
    back = {(r.doc_id, r.text or "") for r in lattice.decode(coded).collect()}
    assert back == {(i, t or "") for i, t in texts()}
    reader = sentencepiece.SentencePieceProcessor(model_file=lattice.MODEL)
    ids = {r.doc_id: list(r.ids or []) for r in coded.collect()}
    assert reader.decode(ids[12]) == texts()[12][1] and ids[11] == reader.encode("one two")
    got = lattice.report(docs).collect()
    assert len(got) == len(texts()) and all(r.round_trip for r in got)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_bytes) for r in got) == sorted((str(i), len(ids[i]), len((t or "").encode())) for i, t in texts())
    rare = lattice.report(docs, frequent=0).collect()
    assert sorted(map(str, got)) == sorted(map(str, rare)) and lattice.report(none).count() == 0
