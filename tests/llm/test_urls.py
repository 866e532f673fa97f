"""Verdicts of urls that no rule decides: planted hosts, and purity against a plain walk down the tree."""

import math
import random
from collections import defaultdict

from lifeloom.llm import urls


def share(bad, n, above):
    return (bad + urls.SMOOTHING * above) / (n + urls.SMOOTHING)


def plain_purity(rows):
    """rows: host, template, parent, pooled, label."""
    counts = defaultdict(lambda: [0, 0])

    def add(key, label):
        counts[key][0] += label is not None
        counts[key][1] += label == "block"

    branches = set()
    for host, template, parent, pooled, label in rows:
        branches.add((host, template, parent, pooled))
        for key in (("all",), ("host", host), ("node", host, parent), ("pool", host, pooled), ("own", host, template)):
            add(key, label)
    together = defaultdict(lambda: [0, 0])
    merged = set()
    for host, template, _, pooled in branches:
        (n, bad), (pn, pbad) = counts["own", host, template], counts["pool", host, pooled]
        if n and pn - n:
            p = pbad / pn
            gap, spread = abs(bad / n - (pbad - bad) / (pn - n)), math.sqrt(p * (1 - p) * (1 / n + 1 / (pn - n)))
            if not gap > urls.Z * spread:
                merged.add((host, template))
                together[host, pooled][0] += n
                together[host, pooled][1] += bad
    out = {}
    for host, template, parent, pooled in branches:
        n, bad = counts["all",]
        at = bad / n if n else 0.0
        for key in (("host", host), ("node", host, parent)):
            at = share(counts[key][1], counts[key][0], at)
        if (host, template) in merged:
            at = share(together[host, pooled][1], together[host, pooled][0], at)
        out[host, template] = (share(counts["own", host, template][1], counts["own", host, template][0], at), counts["host", host][0])
    return out


def test_purity_against_a_plain_walk(spark):
    rng = random.Random(8)
    rows = []
    for _ in range(1500):
        host = rng.choice("abcdef")
        top, leaf = rng.choice(["en", "de", "fr", "es"]), rng.choice(["{n}", "{n}.html", "about"])
        odds = {"a": 0.9, "b": 0.1, "c": 0.5, "d": 0.9 if top == "es" else 0.05}.get(host)
        label = None if odds is None or rng.random() < 0.4 or (host == "a" and top == "de") else "block" if rng.random() < odds else "allow"
        rows.append((host, f"{top}/{leaf}", top, f"~/{leaf}" if leaf != "about" else f"{top}/~", label))
    frame = spark.createDataFrame(rows, "host string, template string, parent string, pooled string, label string")
    got = {(r.host, r.template): (r.purity, r.host_n) for r in urls.purities(frame).collect()}
    want = plain_purity(rows)
    assert set(got) == set(want)
    assert all(abs(got[k][0] - want[k][0]) < 1e-9 and got[k][1] == want[k][1] for k in want)
    none = urls.purities(frame.withColumn("label", frame["label"].substr(1, 0)).replace("", None, "label")).collect()
    assert {r.purity for r in none} == {0.0}


RULES = (("block", "bad.net/es/"), ("block", "bad.net/fr/"), ("allow", "clean.net/en/"), ("block", "mixed.net/es/"), ("allow", "mixed.net/en/"))


def test_planted_hosts_are_blocked_and_allowed(spark):
    made = [f"x://{host}.net/{lang}/{k}.html" for host in ("bad", "clean", "mixed", "unknown") for lang in ("en", "de", "es", "fr") for k in range(30)]
    pages = spark.createDataFrame(list(enumerate(made)), "page_id long, url string")
    got = defaultdict(set)
    for r in urls.verdicts(pages, RULES).collect():
        if r.rule is None:
            got[r.host, r.path.split("/")[1]].add(r.verdict)
    assert got["bad.net", "en"] == got["bad.net", "de"] == {"block"}
    assert got["clean.net", "de"] == got["clean.net", "es"] == {"allow"}
    assert got["mixed.net", "de"] == {"allow"}
    # Without a label of its own a host is not rejected for the others.
    assert all(got["unknown.net", lang] == {"allow"} for lang in ("en", "de", "es", "fr"))
    assert urls.verdicts(pages.limit(0), RULES).count() == 0


def test_long_and_odd_urls(spark):
    rows = [(1, "x://h.org/" + "a/" * 30_000), (2, "x://h.org/" + "z" * 200_000), (None, None), (3, "x://"), (3, "x://"), (4, "x://h.org//a//b/")]
    frame = spark.createDataFrame([(*r, 1, "s") for r in rows], "page_id long, url string, n int, template string")
    got = urls.verdicts(frame).collect()
    assert len(got) == len(rows) and {r.verdict for r in got} == {"allow"}
