"""Very long texts, and columns whose names the operators use themselves."""

import time

from pyspark.sql import functions as F

from lifeloom.llm import licences, secrets


def test_a_file_of_licence_words_ends(spark):
    n = 250_000
    texts = ["all rights reserved " * n, "general public license " * 1000 + "redistribution and use", "no licence here"]
    start = time.monotonic()
    got = {r.doc_id: r for r in licences.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert time.monotonic() - start < 120
    assert (got[0].n_words, got[0].n_base, got[0].first_word, got[0].last_word, got[0].base_labels) == (3 * n, n, 0, 3 * n - 3, "reserved")
    assert (got[1].n_base, got[1].base_labels) == (1000, "gpl") and (got[2].n_base, got[2].labels) == (0, "")


def test_masking_keeps_columns_of_any_name(spark):
    rows = [(1, 'token = "9f8Kd72LmQx01ZbV4tYw88Rr"', "a"), (2, None, "b"), (None, "", "c"), (2, None, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    more = docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(("_id", "_copy", "_spans", "__id", "copy", "x" * 40))])
    got = secrets.redacted(more)
    assert got.columns == more.columns
    kept = sorted(((r.doc_id, r.source, r["_id"], r["_spans"]) for r in got.collect()), key=str)
    assert kept == sorted([(1, "a", 0, 2), (2, "b", 0, 2), (2, "b", 0, 2), (None, "c", 0, 2)], key=str)
    assert [r.text for r in got.filter("doc_id = 2").collect()] == [None, None]


def test_texts_built_to_collide_modulo_a_power_of_two_are_told_apart():
    import numpy as np

    from lifeloom.llm.suffixes import _Hashes

    # A Thue-Morse word and its complement have equal polynomial hashes modulo 2**64 whatever the base.
    word = [bin(i).count("1") % 2 for i in range(1 << 11)]
    pair = [np.array([97 + b for b in word], dtype=np.uint8), np.array([98 - b for b in word], dtype=np.uint8)]
    ends = (np.array([0]), np.array([1 << 11]))
    plain = [int(_Hashes(x).of(*ends)[0]) for x in pair]
    sure = [int(_Hashes(x).sure(*ends)[0]) for x in pair]
    assert plain[0] == plain[1] and sure[0] != sure[1]
    # The same bytes at another place have the same hash.
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    moved = np.concatenate((rng.integers(0, 256, 777).astype(np.uint8), data))
    a, b = np.arange(0, 4000), np.arange(0, 4000) + 300
    assert (_Hashes(data).sure(a, b) == _Hashes(moved).sure(a + 777, b + 777)).all()
