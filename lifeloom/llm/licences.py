"""Licence scan with a positional rare-token index.

The licence templates below are short texts; their words, with positions, are the index.  One pass over the
corpus keeps, of every text, the places of licence words (a common word only beside a distinctive one).
Document frequencies over all documents rate the words.  Each file looks up all its distinctive licence words, of which
the index has under a hundred; every posting of such a word in a template proposes where the template would start, and
proposals that agree are one alignment.  Every key phrase holds ``AGREE`` distinctive words, so no template whose key
phrase stands in a file goes without a candidate, whatever else the file holds.  An alignment with ``AGREE`` of them is scored by the rated share of the template's words in
their places, and is kept if the template's key phrase stands where it must.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled, word_array

# Base labels and their phrases.
BASE = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}
#: Label, template and key phrase (part of the template).
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", "public domain"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "general public license version 2"),
    ("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify and or distribute"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby granted free of charge"),
    ("mpl-2.0", "subject to the terms of the mozilla public license", "mozilla public license"),
    ("reserved", "copyright all rights reserved", "all rights reserved"),
)
#: Template words that are common in any text.
COMMON = frozenset("the and in with or are to of is a for any this under by all 0 1 2 3 4".split())
AGREE = 2
ACCEPT = 0.5

_WORDS = frozenset(w for t in (*(t for _, t, _ in TEMPLATES), *BASE.values()) for w in t.split())
_RARE = sorted(_WORDS - COMMON)


def hits_of(words) -> F.Column:
    """(p, w) of licence words; of common ones only those beside a distinctive one."""
    placed = F.transform(words, lambda w, i: F.struct(i.cast("long").alias("p"), w.alias("w")))
    # The cheap test comes first: most words are none of the licence words.
    known = F.filter(placed, lambda x: x.w.isin(sorted(_WORDS)))
    rare = lambda at: F.coalesce(F.get(words, at.cast("int")).isin(_RARE), F.lit(False))
    return F.filter(known, lambda x: ~x.w.isin(sorted(COMMON)) | rare(x.p + 1) | rare(x.p - 1))


def _places(hits, phrase: list[str]):
    """Positions where the words of ``phrase`` stand consecutively: the starts that each of its words proposes, intersected."""
    found = None
    for k, word in enumerate(phrase):
        starts = F.transform(F.filter(hits, lambda h: h.w == word), lambda h: h.p - k)
        found = starts if found is None else F.array_intersect(found, starts)
    return found


def scan(docs: DataFrame) -> DataFrame:
    """(row, doc_id, n_words, hits) of every row of ``docs``, written once, so that ``row`` is fixed."""
    words = docs.select(F.col("doc_id").cast("long"), word_array(F.col("text")).alias("words"))
    hits = F.when(F.size("words") > 0, hits_of(F.col("words")))
    none = F.array().cast("array<struct<p:bigint,w:string>>")
    return settled(
        words.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", F.size("words").cast("long").alias("n_words"), F.coalesce(hits, none).alias("hits")
        ),
        "licence-hits",
    )


def ratings(found: DataFrame) -> DataFrame:
    """(w, idf) of the licence words that occur; at most as many rows as the templates have words."""
    n = found.count()
    each = found.select(F.explode(F.array_distinct("hits.w")).alias("w")).groupBy("w").agg(F.count("*").alias("df"))
    return each.select("w", F.log((F.lit(n) + 1) / (F.col("df") + 1)).alias("idf") + F.lit(0.0)).toDF("w", "idf")


def aligned(found: DataFrame) -> DataFrame:
    """(row, label, start, score) of accepted templates."""
    spark = found.sparkSession
    idf = settled(ratings(found), "licence-idf")
    postings = [(w, t, p) for t, (_, text, _) in enumerate(TEMPLATES) for p, w in enumerate(text.split()) if w not in COMMON]
    index = spark.createDataFrame(postings, "w string, t int, q long")
    rows = []
    for t, (label, text, key) in enumerate(TEMPLATES):
        parts, words = key.split(), text.split()
        at = next(i for i in range(len(words)) if words[i : i + len(parts)] == parts)
        rows.append((t, label, words, list(range(at, at + len(parts)))))
    texts = spark.createDataFrame(rows, "t int, label string, words array<string>, mandatory array<int>")

    each = found.filter(F.size("hits") > 0).select("row", F.explode("hits").alias("h")).select("row", "h.*").filter(~F.col("w").isin(sorted(COMMON)))
    proposals = each.join(F.broadcast(index), "w").groupBy("row", "t", (F.col("p") - F.col("q")).alias("start")).agg(F.count("*").alias("agree"))
    # A template with one distinctive word cannot get two votes: then all its distinctive words must agree.
    most = index.groupBy("t").agg(F.least(F.lit(AGREE), F.count("*")).alias("need"))
    candidates = proposals.join(F.broadcast(most), "t").filter("agree >= need").join(F.broadcast(texts), "t")
    weights = idf.select("w", F.col("idf").alias("weight"))  # one row per licence word
    # Every word that a candidate expects is looked up at its place, one row each: no file's hits are copied to its candidates.
    expected = candidates.select("row", "t", "label", "start", "mandatory", F.posexplode("words").alias("i", "w"))
    expected = expected.withColumn("p", F.col("start") + F.col("i")).withColumn("key", F.array_contains("mandatory", F.col("i"))).drop("mandatory")
    hits = found.select("row", F.explode("hits").alias("h")).select("row", "h.p", "h.w", F.lit(True).alias("hit"))
    met = expected.join(hits, ["row", "p", "w"], "left").join(F.broadcast(weights), "w", "left")
    weight, hit = F.coalesce("weight", F.lit(0.0)), F.coalesce("hit", F.lit(False))
    checked = met.groupBy("row", "t", "label", "start").agg(
        F.sum(F.when(hit, weight).otherwise(0.0)).alias("got"), F.sum(weight).alias("whole"), F.min(~F.col("key") | hit).alias("verified")
    )
    # Rounded, because sums of doubles depend on their order.
    score = F.round(F.when(F.col("whole") > 0, F.col("got") / F.col("whole")).otherwise(1.0), 9)
    return checked.filter("verified").select("row", "label", "start", score.alias("score")).filter(F.col("score") >= ACCEPT)


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row of ``docs``.

    ``score`` is 1 with a base phrase, else that of the best template.  Null and empty texts have no words; null ids
    and repeated rows keep their rows; an empty table gives an empty result; further columns are ignored.
    """
    found = scan(docs)
    more = aligned(found).groupBy("row").agg(F.collect_set("label").alias("more"), F.max("score").alias("best"))
    phrases = {label: _places(F.col("hits"), text.split()) for label, text in BASE.items()}
    based = found.select(
        "row", "doc_id", "n_words", F.concat(*phrases.values()).alias("at"),
        F.filter(F.array(*(F.when(F.size(p) > 0, F.lit(label)) for label, p in phrases.items())), lambda x: x.isNotNull()).alias("base"),
    )
    none = F.array().cast("array<string>")
    return based.join(more, "row", "left").select(
        "doc_id", "n_words", F.size("at").cast("long").alias("n_base"),
        F.array_min("at").alias("first_word"), F.array_max("at").alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", none))), ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.least(F.coalesce("best", F.lit(0.0)), F.lit(1.0))).alias("score"),
    )
