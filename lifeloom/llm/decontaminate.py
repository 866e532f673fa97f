"""Benchmark decontamination with a distributed positional inverted index.

1. Every window of ``WINDOW`` words of a benchmark item names its ``WINDOW - NEAR + 1`` rarest different words, by
   counts over the whole corpus; these words are the test terms.  Any ``NEAR`` different words of a window therefore
   include a test term, also if its rarest word was replaced.
2. The corpus is read once more and the postings of the test terms are stored: term, document, position,
   and the ``WINDOW - 1`` words on either side, which is as far as a window around the position can reach.  A word of the
   benchmark is told by its 64-bit hash, any other word is a zero: it equals nothing.
3. Postings meet the benchmark positions of their term.  The difference of the two positions is the
   alignment; lists are intersected on it by comparing the neighbours outwards from the term.  A run
   of equal words as long as a window is an exact phrase; ``WINDOW`` words of the document that hold at
   least ``NEAR`` different words of a window, in any order, are a proximity match.
4. Exact runs are joined per document into the words they hit.

What is sent to the tasks is the vocabulary of the benchmark, in blocks of at most ``BLOCK_TERMS`` words,
so memory is bounded for a benchmark of any size.  A term that fills a third of the corpus spreads over tasks:
its postings lie where they were read until adaptive execution splits the join.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import UPPER, LOWER, byte_words, same, settled, word_array

WINDOW = 10
NEAR = 8
#: Most distinct benchmark words that are sent to the tasks at once.
BLOCK_TERMS = 1_000_000


def _blocks(words: DataFrame, limit: int):
    """The distinct ``word`` values in frozensets of about ``limit``, split by hash if they are more."""
    n = words.select("word").distinct().count()
    parts = -(-n // limit) if n else 0
    for part in range(parts):
        rows = words.select("word").distinct().filter(F.pmod(F.xxhash64("word"), F.lit(parts)) == part)
        yield frozenset(r.word.encode("utf-8", "surrogatepass") for r in rows.toLocalIterator())


def _texts(df: DataFrame, *ids) -> DataFrame:
    return df.select(*ids, F.coalesce("text", F.lit("")).alias("text"))


def _union(frames: list[DataFrame], empty: DataFrame) -> DataFrame:
    out = empty
    for f in frames:
        out = out.unionByName(f)
    return out


def item_words(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, text hash, ipos, word, n): the words of every item; items of no word vanish.

    Repeated items count once.  ``item`` identifies a row: two items of one id stay apart.
    """
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    keyed = items.select("item_id", F.xxhash64("item_id", "text").alias("item"), word_array(F.col("text")).alias("words"))
    return keyed.select("item", "item_id", F.size("words").alias("n"), F.posexplode("words").alias("ipos", "word"))


def term_counts(docs: DataFrame, words: DataFrame, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(word, count) over all documents for the benchmark words that occur."""
    frames = []
    for terms in _blocks(words, block_terms):
        sent = docs.sparkSession.sparkContext.broadcast(terms)

        def run(batches, sent=sent):
            known, counts = sent.value, Counter()
            for batch in batches:
                for text in batch.column("text"):
                    counts.update(filter(known.__contains__, byte_words(text.as_py())))
            names = [w.decode("utf-8", "surrogatepass") for w in counts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
            )

        frames.append(_texts(docs).mapInArrow(run, "word string, n long"))
    empty = docs.sparkSession.createDataFrame([], "word string, n long")
    return _union(frames, empty).groupBy("word").agg(F.sum("n").alias("count"))


def anchors(items: DataFrame, counts: DataFrame, window: int, seeds: int) -> DataFrame:
    """(item, item_id, ipos, word, n) of the positions whose word is one of the ``seeds`` rarest different words of some
    window around them.  Words that the corpus does not hold count as the rarest, but have no postings and are left out."""
    rated = items.join(counts, "word", "left").withColumn(
        "rank", F.struct(F.coalesce("count", F.lit(0)).alias("count"), "word", "ipos")
    )
    ahead = W.partitionBy("item").orderBy("ipos").rowsBetween(0, window - 1)
    ranked = rated.withColumn("ranks", F.array_sort(F.collect_list("rank").over(ahead)))
    # Sorted, so that equal words are neighbours: the first place of each word stays.
    first = F.filter("ranks", lambda r, i: (i == 0) | (F.get("ranks", i - 1)["word"] != r["word"]))
    lowest = ranked.filter((F.col("ipos") + window <= F.col("n")) | (F.col("ipos") == 0))
    named = lowest.select("item", "item_id", "n", F.explode(F.slice(first, 1, seeds)).alias("low")).filter("low.count > 0")
    return named.select("item", "item_id", "n", F.col("low.ipos").alias("ipos"), F.col("low.word").alias("word")).distinct()


def crowded(places: np.ndarray, window: int, least: int) -> np.ndarray:
    """Which of the ascending ``places`` lie in some ``window`` consecutive words that hold at least ``least`` of them."""
    count = np.searchsorted(places, places + window) - np.arange(len(places))
    heads = np.flatnonzero(count >= least)
    edge = np.zeros(len(places) + 1, dtype=np.int64)
    np.add.at(edge, heads, 1)
    np.add.at(edge, heads + count[heads], -1)
    return np.cumsum(edge[:-1]) > 0


def _code(word: bytes) -> int:
    """The hash that Spark's ``xxhash64`` gives the word."""
    value = xxhash.xxh64_intdigest(word, 42)
    return value - (1 << 64) if value >> 63 else value


def postings(docs: DataFrame, terms: DataFrame, vocabulary: DataFrame, window: int, least: int, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The stored index: (word, doc_id, copy, pos, around) of the occurrences of test terms that can matter.

    ``around``: the codes of the ``window - 1`` words before the place, of its own, and of as many behind.  A match of either kind lies
    in ``window`` words that hold at least ``least`` words of the benchmark's ``vocabulary``; other occurrences are not stored.  A
    vocabulary beyond ``block_terms`` is not sent: then all occurrences stay and every word has its code.
    ``copy`` is a hash of the text, so that rows which share an id stay apart.
    """
    side = window - 1
    schema = "word string, doc_id long, copy long, pos long, around array<long>"
    frames = []
    sieves = list(_blocks(vocabulary, block_terms)) if vocabulary.select("word").distinct().count() <= block_terms else []
    sieve = docs.sparkSession.sparkContext.broadcast({w: _code(w) for w in sieves[0]}) if sieves else None
    for known in _blocks(terms, block_terms):
        sent = docs.sparkSession.sparkContext.broadcast(known)

        def run(batches, sent=sent):
            known = sent.value
            for batch in batches:
                rows, size = [], 0
                for doc, copy, text in zip(*(batch.column(c) for c in ("doc_id", "copy", "text"))):
                    words = byte_words(text.as_py())
                    found = _places(words, known, sieve.value if sieve else None, window, least)
                    if found is None:
                        continue
                    at, codes = found
                    names = [words[i].decode("utf-8", "surrogatepass") for i in at.tolist()]
                    # The codes have ``side`` zeros before them, so the slice that starts at a place is centred on it.
                    rows.append((names, doc.as_py(), copy.as_py(), at, codes[at[:, None] + np.arange(2 * side + 1)]))
                    size += len(names)
                    if size > 20_000:
                        yield _rows(rows, side)
                        rows, size = [], 0
                if rows:
                    yield _rows(rows, side)

        source = _texts(docs, F.col("doc_id").cast("long"), F.xxhash64("text").alias("copy"))
        frames.append(source.mapInArrow(run, schema))
    return _union(frames, docs.sparkSession.createDataFrame([], schema))


def _places(words, known, sieve, window: int, least: int):
    """Places of test terms that can matter, and the codes of all words with ``window - 1`` zeros on either side; None for no place."""
    if sieve is None:
        at = np.array([i for i, w in enumerate(words) if w in known], dtype=np.int64)
        if not len(at):
            return None
        own = np.fromiter((_code(w) for w in words), dtype=np.int64, count=len(words))
    else:
        seen = np.array([i for i, w in enumerate(words) if w in sieve], dtype=np.int64)
        if len(seen) < least:
            return None
        dense = seen[crowded(seen, window, least)].tolist()
        at = np.array([i for i in dense if words[i] in known], dtype=np.int64)
        if not len(at):
            return None
        own = np.zeros(len(words), dtype=np.int64)
        # Words that are not crowded lie in no window that matters.
        own[dense] = [sieve[words[i]] for i in dense]
    return at, np.pad(own, window - 1)


def _rows(rows, side):
    counts = [len(r[0]) for r in rows]
    around = np.concatenate([r[4] for r in rows]).ravel()
    offsets = np.arange(0, len(around) + 1, 2 * side + 1, dtype=np.int32)
    columns = [
        pa.array([w for r in rows for w in r[0]], pa.string()),
        pa.array([r[1] for r in rows], pa.int64()).take(pa.array(np.repeat(np.arange(len(rows)), counts))),
        pa.array(np.repeat(np.array([r[2] for r in rows], dtype=np.int64), counts)),
        pa.array(np.concatenate([r[3] for r in rows])),
        pa.ListArray.from_arrays(pa.array(offsets), pa.array(around)),
    ]
    return pa.RecordBatch.from_arrays(columns, ["word", "doc_id", "copy", "pos", "around"])


def _equal_run(a, b):
    """How many leading elements of two arrays agree."""
    pairs = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first_miss = F.array_position(pairs, False)
    return F.when(first_miss > 0, first_miss - 1).otherwise(F.size(pairs)).cast("long")


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, near: int = NEAR, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(doc_id, copy, item, item_id, start, end, exact): spans of document words.

    ``exact``: the words [start, end) of the document are words of the item in sequence, at least a window
    of them (or the whole of a shorter item).  Otherwise a proximity match: around a test term, ``window`` words of the
    document hold at least ``near`` different words of a window of the item, in any order.
    """
    items = settled(item_words(benchmark), "decon-items")
    counts = settled(term_counts(docs, items, block_terms), "decon-counts")
    picked = settled(anchors(items, counts, window, window - near + 1), "decon-anchors")
    shortest = items.agg(F.min("n")).first()[0] or 1
    index = settled(postings(docs, picked, items, window, min(near, window, shortest), block_terms), "decon-index")
    side = window - 1
    whole = items.groupBy("item").agg(F.sort_array(F.collect_list(F.struct("ipos", "word"))).alias("ws"))
    whole = whole.select("item", F.col("ws.word").alias("words"))
    # Of an item's words only the surroundings of a test term go along; beyond its ends stands -1, which equals nothing.
    edge = F.array_repeat(F.lit(-1).cast("long"), side)
    need = F.least(F.lit(window), F.col("n"))
    around = (
        picked.join(whole, "item")
        .withColumn("codes", F.concat(edge, F.transform("words", lambda w: F.xxhash64(w)), edge))
        .select("item", "item_id", "n", "ipos", "word", F.slice("codes", F.col("ipos") + 1, F.lit(2 * side + 1)).alias("i_around"))
    )
    spans = F.transform(F.sequence(F.lit(side + 1) - need, F.lit(side)), lambda k: F.slice("i_around", k + 1, need))
    whole_spans = F.filter(spans, lambda w: ~F.array_contains(w, F.lit(-1).cast("long")))
    # An exact window shares all its different words, a near one ``near``: no match shares fewer than this.
    around = around.withColumn("floor", F.least(F.lit(near), F.array_min(F.transform(whole_spans, lambda w: F.size(F.array_distinct(w))))))
    met = (
        index.join(around, "word")
        .withColumn("shared", F.size(F.array_intersect("around", "i_around"))).filter("shared >= floor")
        .withColumn("back", _equal_run(F.reverse(F.slice("around", 1, side)), F.reverse(F.slice("i_around", 1, side))))
        .withColumn("ahead", _equal_run(F.slice("around", side + 2, side), F.slice("i_around", side + 2, side)))
    )
    exact = F.col("back") + 1 + F.col("ahead") >= need
    cut = lambda words: F.transform(F.sequence(F.lit(0), F.lit(side)), lambda k: F.slice(words, k + 1, F.lit(window)))
    within = F.exists(cut(F.col("i_around")), lambda i: F.exists(cut(F.col("around")), lambda d: F.size(F.array_intersect(i, d)) >= near))
    close = (F.col("n") >= window) & (F.col("shared") >= near) & within
    found = met.filter(exact | close)
    return found.select(
        "doc_id", "copy", "item", "item_id",
        (F.col("pos") - F.when(exact, F.col("back")).otherwise(0)).alias("start"),
        (F.col("pos") + 1 + F.when(exact, F.col("ahead")).otherwise(0)).alias("end"),
        exact.alias("exact"),
    )


def _covered(spans):
    """Words covered by sorted (start, end) spans, overlaps once."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    return F.aggregate(
        spans,
        zero,
        lambda acc, s: F.struct(
            (acc.n + F.greatest(s.end - F.greatest(s.start, acc.upto), F.lit(0))).alias("n"),
            F.greatest(acc.upto, s.end).alias("upto"),
        ),
        lambda acc: acc.n,
    )


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """One row per row of ``docs``: n_words, n_hit, n_items, items_sha256, contaminated, n_near.

    ``n_near`` counts the items that the row holds nearly and not exactly anywhere.
    Null texts have no words; null ids and repeated rows keep their rows; equal rows get equal
    results.  An item with a null id counts as an item, its id written as an empty string.  An empty
    benchmark hits nothing.  Further columns are ignored.
    """
    found = matches(docs, benchmark, window, block_terms=block_terms)
    hits = found.groupBy(F.col("doc_id").alias("h_id"), F.col("copy").alias("h_copy")).agg(
        F.sort_array(F.collect_set(F.when(F.col("exact"), F.struct("start", "end")))).alias("spans"),
        F.collect_set(F.when(F.col("exact"), F.coalesce(F.col("item_id").cast("string"), F.lit("")))).alias("ids"),
        F.collect_set(F.when(F.col("exact"), F.col("item"))).alias("held"),
        F.collect_set(F.when(~F.col("exact"), F.col("item"))).alias("close"),
    )
    hits = settled(hits, "decon-hits")
    base = _word_counts(docs)
    joined = base.join(hits, same(base.doc_id, hits.h_id) & (base["copy"] == hits.h_copy), "left")
    none = F.array().cast("array<string>")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce(_covered(F.col("spans")), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.coalesce("ids", none)), ","), 256).alias("items_sha256"),
        (F.coalesce(F.size("spans"), F.lit(0)) > 0).alias("contaminated"),
        F.coalesce(F.size(F.array_except("close", "held")), F.lit(0)).cast("long").alias("n_near"),
    )


def _word_counts(docs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            n = np.fromiter((len(byte_words(t.as_py())) for t in batch.column("text")), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("copy"), pa.array(n)], ["doc_id", "copy", "n_words"])

    source = _texts(docs, F.col("doc_id").cast("long"), F.xxhash64("text").alias("copy"))
    return source.mapInArrow(run, "doc_id long, copy long, n_words long")


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that hold no window of the benchmark, neither exactly nor nearly, all columns kept."""
    found = matches(docs, benchmark, window)
    hit = found.select(F.col("doc_id").alias("_hit"), F.col("copy").alias("_copy")).distinct()
    return docs.join(hit, same(docs["doc_id"], hit["_hit"]) & same(F.xxhash64(docs["text"]), hit["_copy"]), "left_anti")


#: The contract of the report in DuckDB.
ORACLE = f"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS k,
         array_to_string(w[i:i + least(len(w), {WINDOW}) - 1], ' ') AS phrase
  FROM (SELECT *, unnest(generate_series(1, greatest(1, len(w) - {WINDOW - 1}))) AS i FROM items WHERE len(w) > 0)),
places AS (
  SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
  FROM docs, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k),
hits AS (
  SELECT doc_id, i, p.k, item_id FROM places p JOIN windows v
  ON p.k = v.k AND array_to_string(w[i:i + p.k - 1], ' ') = phrase),
covered AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS j FROM hits) GROUP BY 1),
named AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM hits GROUP BY 1),
numbered AS (SELECT row_number() OVER () AS item, * FROM (SELECT DISTINCT item_id, w FROM items WHERE len(w) >= {WINDOW})),
i_sets AS (SELECT DISTINCT item, item_id, t, unnest(w[t:t + {WINDOW - 1}]) AS word
           FROM (SELECT *, unnest(generate_series(1, len(w) - {WINDOW - 1})) AS t FROM numbered)),
d_sets AS (SELECT DISTINCT doc_id, s, word FROM (
             SELECT doc_id, s, unnest(w[s:s + {WINDOW - 1}]) AS word
             FROM (SELECT *, unnest(generate_series(1, greatest(len(w) - {WINDOW - 1}, 1))) AS s FROM docs)) WHERE word IN (SELECT word FROM i_sets)),
close AS (SELECT DISTINCT doc_id, item, item_id FROM (
            SELECT doc_id, s, item, t, any_value(item_id) AS item_id FROM d_sets JOIN i_sets USING (word) GROUP BY 1, 2, 3, 4 HAVING count(*) >= {NEAR})),
nearly AS (SELECT doc_id, count(*) AS n_near FROM close WHERE NOT EXISTS (
             SELECT 1 FROM hits WHERE hits.doc_id = close.doc_id AND hits.item_id = close.item_id) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN nearly USING (doc_id)
"""
