"""Results that are whole: cases in which a shortcut would lose something."""

import hashlib
import random

import pyarrow as pa
import sentencepiece

from lifeloom.llm import decontaminate, lattice, licences, simhash, urls


def test_licences_of_a_file_with_many(spark):
    """Every template of a file is found, however many licence words the file holds."""
    notice = (
        "Licensed under the Apache License, Version 2.0. Released under the MIT license. Subject to the terms of the Mozilla Public License. "
        "Redistribution and use in source and binary forms, with or without modification, are permitted."
    )
    docs = spark.createDataFrame([(1, notice), (2, "released under the mit license"), (3, "license"), (None, None)], "doc_id LONG, text STRING")
    got = {r.doc_id: r.labels for r in licences.report(docs).collect()}
    assert got == {1: "apache-2.0,bsd,mit,mpl-2.0", 2: "mit", 3: "", None: ""}


def brute_ids(text):
    """The best way through the whole text, without any cut: fewest characters as bytes, then pieces, then ranks."""
    reader = sentencepiece.SentencePieceProcessor(model_file=lattice.MODEL)
    pieces, first_byte = {}, None
    for i in range(reader.get_piece_size()):
        if reader.is_byte(i):
            first_byte = i if first_byte is None else first_byte
        elif not (reader.is_control(i) or reader.is_unknown(i) or reader.is_unused(i)):
            pieces[reader.id_to_piece(i).replace("\u2581", " ")] = i
    longest, text = max(map(len, pieces)), f" {text}"
    best = [((0, 0, 0), [])]
    for end in range(1, len(text) + 1):
        (u, p, r), way = best[end - 1]
        found = ((u + 1, p, r), way + [first_byte + b for b in text[end - 1].encode()])
        for start in range(max(0, end - longest), end):
            i = pieces.get(text[start:end])
            if i is not None:
                (u, p, r), way = best[start]
                if (u, p + 1, r + i) < found[0]:
                    found = ((u, p + 1, r + i), way + [i])
        best.append(found)
    return best[-1][1]


def awkward_texts():
    r = random.Random(11)
    code = "def f(x):\n    return {'a': x};\r\n        foo();  // ---- ****\n\t|  1 |  2024 |...\n"
    signs = "".join(r.choice(" -=*_#();.,{}'\"\r\n\u2581\u00b2ab1") for _ in range(400))
    return [code, "-" * 333 + "*" * 77, " " * 150 + "x", "\u0e01\u0e32\u0e23\u0e17\u0e14" * 40, "\u4f60\u597d\u65e5\u672c" * 50, "abcd" * 100 + "the" * 90, signs, "caf\u00e9 na\u00efve  \U0001f600\U0001f600 e\u0301", "a", " "]


def test_lattice_against_the_uncut_text(spark):
    """No word border keeps a piece out: punctuation, indentation and letter runs over any block length."""
    rows = list(enumerate(awkward_texts()))
    got = {r.doc_id: list(r.ids) for r in lattice.encode(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect()}
    assert {i: lens for i, t in rows if got[i] != (lens := brute_ids(t))} == {}


def digest_of(text):
    return hashlib.sha256(",".join(map(str, brute_ids(text) if text else [])).encode()).hexdigest()


def test_lattice_report_of_whole_texts(spark, monkeypatch):
    """The digest is that of the ids in order, and the round trip compares the decoded whole text."""
    texts = ["one two three", "three two one", "one two three", "", *awkward_texts()]
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id LONG, text STRING")
    got = lattice.report(docs).collect()
    want = sorted((len(brute_ids(t)) if t else 0, len(t.encode()), digest_of(t), True) for t in texts)
    assert sorted((r.n_tokens, r.n_bytes, r.digest, r.round_trip) for r in got) == want
    vocabulary = lattice.vocabulary

    def broken(rows, pieces):
        return vocabulary(rows, pieces).selectExpr("word", "n", "if(word = ' two', slice(ids, 1, 0), ids) ids")

    monkeypatch.setattr(lattice, "vocabulary", broken)
    assert sorted(r.round_trip for r in lattice.report(docs.limit(4)).collect()) == [False] * 3 + [True]


def test_lattice_of_rare_words_where_they_stand(spark, monkeypatch):
    """Words that are not sent to all tasks get the same ids, and no occurrence leaves its row."""
    texts = [*awkward_texts(), "caf\u00e9 \U0001f600" * 9, "\x00\ue000a\ufffd", "x" * 64, "y\u0e01" * 33]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    monkeypatch.setattr(lattice, "PORTION", 500)
    got = {r.doc_id: list(r.ids) for r in lattice.encode(docs.coalesce(1), frequent=0).collect()}
    assert {i for i, t in enumerate(texts) if got[i] != brute_ids(t)} == set()
    plan = lattice.report(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_words_part_where_no_piece_joins_two_classes(spark):
    pieces = lattice.piece_table(spark)
    for kept in (pieces, pieces.filter("byte or piece in ('a', ' ', '1')"), pieces.filter("byte or piece in ('a1', '1 ', ' !', 'a')")):
        crossed = {(lattice._class_of(a), lattice._class_of(b)) for r in kept.filter("not byte").collect() for a, b in zip(r.piece, r.piece[1:])}
        texts = [*awkward_texts(), "a1 !a1 11  22", "1" * 5000]
        words, sizes = lattice.words_of(pa.array([None, *texts, ""])[1:], *lattice.cuts(kept))
        words = iter(words.to_pylist())
        assert sizes[-1] == 0
        for text, size in zip(texts, sizes):
            want, whole = [], f" {text}"
            for k, c in enumerate(whole):
                if k and (lattice._class_of(whole[k - 1]), lattice._class_of(c)) in crossed:
                    want[-1] += c
                else:
                    want.append(c)
            assert [next(words) for _ in range(size)] == want
        assert next(words, None) is None


def test_lattice_rows_whose_short_hashes_collide(spark):
    """Different texts without an id stay apart, also if a 32-bit hash does not tell them apart."""
    many = spark.range(300_000).selectExpr("concat('a', repeat('b ', int(id % 7)), id) text")
    pair = next(iter(many.groupBy("text").count().selectExpr("text", "hash(text) h").groupBy("h").agg({"text": "collect_list"}).toDF("h", "t").filter("size(t) > 1").limit(1).collect())).t
    got = lattice.report(spark.createDataFrame([(None, t) for t in pair], "doc_id LONG, text STRING")).collect()
    assert sorted((r.n_bytes, r.digest) for r in got) == sorted((len(t), digest_of(t)) for t in pair)


def test_shingle_sets_in_parts_of_a_batch(spark, monkeypatch):
    """A task holds the sets of a few texts, not of a whole Arrow batch."""
    monkeypatch.setattr(simhash, "SETS", 2)
    texts = [None, "", "a b c d e f", "a b", "a b c d e f", "g h i j k l m"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING").coalesce(1)
    got = sorted((r.doc_id, len(r.shingles)) for r in simhash.shingle_sets(docs, 5).collect())
    assert got == [(0, 0), (1, 0), (2, 2), (3, 1), (4, 2), (5, 3)]


def test_keep_one_tells_rows_of_one_id_apart(spark):
    """A row goes only if its own text has a copy that stays."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    near = c.replace("c59", "edit")
    rows = [(3, a), (7, a), (7, b), (9, c), (9, near), (None, "some other text"), (12, None)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    kept = [tuple(r) for r in simhash.keep_one(docs).collect()]
    assert sorted(map(str, kept)) in [sorted(map(str, [(3, a), (7, b), (9, x), (None, "some other text"), (12, None)])) for x in (c, near)]


def test_proximity_against_brute_force(spark):
    """Near copies count though their rarest word was replaced or the words were reordered."""
    r = random.Random(4)
    common = [f"w{k}" for k in range(14)]
    docs, items = [], []
    for i in range(12):
        words = [r.choice(common) for _ in range(9)] + [f"rare{i}"] + r.sample(common, 8)
        items.append((i, " ".join(words)))
        edited = ["gone" if w.startswith("rare") else w for w in words]
        part = r.sample(words[4:14], 10)
        docs += [(i * 10, " ".join(["x"] * 5 + edited + ["y"] * 3)), (i * 10 + 1, " ".join(["x"] * 4 + part)), (i * 10 + 2, " ".join(r.sample(common, 9)))]
        docs.append((i * 10 + 3, " ".join(r.choice(common) for _ in range(30))))
    items.append((90, "alpha beta gamma delta epsilon zeta eta theta iota kappa"))
    docs += [(900, "q q q theta eta zeta epsilon q delta gamma beta alpha q"), (901, "alpha q beta q gamma q delta q epsilon q zeta q eta q theta"), (902, "kappa iota theta eta zeta epsilon delta")]

    def windows(text):
        w = text.split()
        return [w[k : k + 10] for k in range(max(1, len(w) - 9))]

    def holds(text, item):
        return any(len(set(x) & set(y)) >= 8 for x in windows(text) for y in windows(item))

    frame = spark.createDataFrame(docs, "doc_id LONG, text STRING")
    bench = spark.createDataFrame(items, "item_id LONG, text STRING")
    found = decontaminate.matches(frame, bench).collect()
    near = {(x.doc_id, x.item_id) for x in found if not x.exact}
    whole = {(x.doc_id, x.item_id) for x in found if x.exact}
    want = {(d, i) for d, t in docs for i, item in items if holds(t, item)}
    assert want - whole == near - whole and near <= want and (900, 90) in near and (901, 90) not in near and (902, 90) not in near
    told = {x.doc_id for x in decontaminate.report(frame, bench).collect() if x.n_near}
    assert told == {d for d, _ in near}
    assert {x.doc_id for x in decontaminate.clean(frame, bench).collect()} == {d for d, _ in docs} - {d for d, _ in near | whole}


def test_urls_need_labels_of_their_own(spark):
    """A branch without labelled urls is not rejected for its siblings or its shape; one with bad urls of its own is."""
    rules = (("block", "bad.net/es/1"), ("allow", "bad.net/it/1"), ("block", "bad.net/es/x"))
    made = [f"x://bad.net/{lang}/{k}" for lang in ("es", "it", "en") for k in (*range(10, 20), *range(20, 30))]
    made += [f"x://good.org/en/{k}" for k in range(20)]
    # Under the variable second segment all pages are children of one node.
    made += [f"x://deep.org/{a}/{b}" for a, b in zip("abcdefghij", "qrstuvwxyz")]
    pages = spark.createDataFrame(list(enumerate(made)), "page_id LONG, url STRING")
    got = {(r.host, r.path.split("/")[1]): (r.verdict, r.template) for r in urls.verdicts(pages, rules).collect() if r.rule is None}
    assert got["bad.net", "es"][0] == "block" and got["bad.net", "it"][0] == got["bad.net", "en"][0] == got["good.org", "en"][0] == "allow"
    assert {got["deep.org", a][1] for a in "abcdefghij"} == {"*/*"}
