"""I-Match fingerprints over several randomised lexicon subsets.

The lexicon holds the terms whose inverse document frequency, over all documents, lies in a band.  A term occurs in at least
``1 / exp(HIGH_IDF)`` of the documents, so there are at most (mean number of distinct words of a text) x exp(HIGH_IDF)
of them, however large the corpus is: that is why the lexicon may be sent to all tasks.  A text keeps its
distinct terms of the lexicon, sorted.  A hash of the term deals the lexicon into random subsets of three densities,
``SUBSETS`` each; the fingerprint is the list of the hashes of the kept terms in each subset.  The thin ones stay equal when
much of a long text changes, the full ones tell short texts apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import settled, word_array

LOW_IDF, HIGH_IDF = 1.2, 5.3
SUBSETS = 16
#: Of each density, one term in so many takes part (times SUBSETS).
DENSITIES = (1, 8, 64)
#: Hashes are kept as remainders by this, plus one; 0 stands for a subset without terms.
HASHES = (1 << 16) - 1


def document_frequencies(docs: DataFrame, least: int = 1, most: int = 1 << 30) -> DataFrame:
    """(word, df) over all rows of ``docs`` for words of ``least`` to ``most`` characters; sums combine before the shuffle."""
    distinct = F.array_distinct(word_array(F.col("text")))
    words = docs.select(F.explode(distinct).alias("word"))
    if least > 1 or most < 1 << 30:
        words = words.filter(F.length("word").between(least, most))
    return words.groupBy("word").agg(F.count("*").alias("df"))


def lexicon(docs: DataFrame, low: float = LOW_IDF, high: float = HIGH_IDF) -> list[str]:
    """The terms of the band, sorted."""
    n = docs.count()
    idf = F.log(F.lit(float(n)) / F.col("df"))
    return sorted(r.word for r in document_frequencies(docs).filter(idf.between(low, high)).select("word").toLocalIterator())


def term_hashes(text, terms: list[str]):
    """Hashes of a text's distinct lexicon terms, in the order of the terms."""
    if not terms:
        return F.array().cast("array<bigint>")
    kept = F.filter(F.array_distinct(word_array(text)), lambda w: w.isin(terms))
    return F.transform(F.array_sort(kept), lambda w: F.xxhash64(w))


def subset_hashes(hashes):
    """The fingerprint as an array of ints from the column of term hashes."""

    def of(dense, i):
        kept = F.filter(dense, lambda h: F.pmod(h, F.lit(SUBSETS)) == i)
        return F.when(F.size(kept) > 0, F.pmod(F.xxhash64(kept), F.lit(HASHES)) + 1).otherwise(0).cast("int")

    tiers = []
    for density in DENSITIES:
        dense = hashes if density == 1 else F.filter(hashes, lambda h: F.pmod(F.shiftright(h, 8), F.lit(density)) == 0)
        tiers.append(F.transform(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), lambda i: of(dense, i)))
    return F.concat(*tiers)


def likeness(a, b):
    """Share of equal hashes among the subsets that either text has terms in; two texts without terms are alike."""
    pairs = F.zip_with(a, b, lambda x, y: F.when((x == 0) & (y == 0), F.lit(None)).otherwise(F.when(x == y, 1.0).otherwise(0.0)))
    seen = F.filter(pairs, lambda x: x.isNotNull())
    return F.when(F.size(seen) == 0, 1.0).otherwise(F.aggregate(seen, F.lit(0.0), lambda s, x: s + x) / F.size(seen))


def shown(prints):
    return F.array_join(F.transform(prints, lambda x: F.lower(F.lpad(F.hex(x), 4, "0"))), "")


def _source(docs: DataFrame) -> DataFrame:
    """(doc_id, key, copy, text): ``key`` and ``copy``, a hash of the text, are never null and tell rows apart."""
    text = F.coalesce("text", F.lit(""))
    own = F.col("doc_id").cast("long")
    return docs.select(
        own.alias("doc_id"), F.coalesce(own, F.lit(0)).alias("key"), F.xxhash64(text, own.isNull()).alias("copy"), text.alias("text")
    )


def fingerprints(docs: DataFrame, terms: list[str]) -> DataFrame:
    """(doc_id, key, copy, n_chars, prints) of every row."""
    hashed = _source(docs).select(
        "doc_id", "key", "copy", F.length("text").alias("n_chars"), term_hashes(F.col("text"), terms).alias("hashes")
    )
    return hashed.select("doc_id", "key", "copy", "n_chars", subset_hashes(F.col("hashes")).alias("prints"))


def successors(rows: DataFrame) -> DataFrame:
    """(key, copy, next_key, next_copy) of distinct rows, in descending order of doc_id and round; nulls come last.

    The order is cut into ranges; inside a range a window looks one row ahead, and the last row of a range gets the first of
    the next one from a table of one row per range.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("copy").desc()]
    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = rows.select("doc_id", "key", "copy").distinct().repartitionByRange(n, *order)
    ranged = settled(ranged.withColumn("part", F.spark_partition_id()), "imatch-order")
    inside = W.partitionBy("part").orderBy(*order)
    here = ranged.select(
        "key", "copy", "part", F.row_number().over(inside).alias("place"), F.lead(F.struct("key", "copy")).over(inside).alias("next")
    )
    heads = here.filter("place = 1").select("part", F.struct("key", "copy").alias("head"))
    every = heads.agg(F.sort_array(F.collect_list(F.struct("part", "head"))).alias("all"))  # one row
    after = F.filter("all", lambda h: h.part > F.col("part"))
    found = here.join(F.broadcast(every)).withColumn("next", F.coalesce("next", F.get(after, F.lit(0))["head"], F.col("all")[0]["head"]))
    return found.select("key", "copy", F.col("next.key").alias("next_key"), F.col("next.copy").alias("next_copy"))


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The next document is the one of the next smaller doc_id; among rows that share an id, hashes of their texts decide, and
    rows equal in both count as one document (each gets its row).  Null ids come last; null texts are empty; the
    only document is its own next.  Further columns are ignored.
    """
    terms = lexicon(docs)
    prints = settled(fingerprints(docs, terms), "imatch-prints")
    order = settled(successors(prints), "imatch-next")
    one = prints.dropDuplicates(["key", "copy"])
    following = one.select(F.col("key").alias("next_key"), F.col("copy").alias("next_copy"), F.col("prints").alias("f_prints"))
    plan = order.join(one, ["key", "copy"]).join(following, ["next_key", "next_copy"])
    plan = settled(plan, "imatch-plan")

    # Both joins deal the same columns of the texts out by the same key: one exchange serves both.
    texts = _source(docs).select("key", "copy", "text")
    take = F.floor(F.col("n_chars") / 3).cast("int")
    asked = plan.select(F.col("key").alias("t_key"), F.col("copy").alias("t_copy"), F.col("next_key").alias("key"), F.col("next_copy").alias("copy"), take.alias("take"))
    heads = (
        texts.join(asked, ["key", "copy"])
        .select(F.col("t_key").alias("key"), F.col("t_copy").alias("copy"), F.substring("text", F.lit(1), F.col("take")).alias("head"))
        .dropDuplicates(["key", "copy"])
    )
    known = plan.select("doc_id", "key", "copy", "n_chars", "prints", "f_prints")
    edited = texts.join(heads, ["key", "copy"]).join(known, ["key", "copy"]).select(
        "doc_id", "n_chars", "prints", "f_prints", F.concat(F.substring("text", F.lit(1), F.col("n_chars") - take), "head").alias("edited")
    )
    hashed = edited.select(
        "doc_id", "n_chars", "prints", "f_prints", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        term_hashes(F.col("edited"), terms).alias("hashes"),
    )
    final = hashed.select("doc_id", "n_chars", "prints", "f_prints", "edited_sha256", subset_hashes(F.col("hashes")).alias("e_prints"))
    return final.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256",
        shown(F.col("prints")).alias("fingerprint"), shown(F.col("e_prints")).alias("edited_fingerprint"),
        likeness(F.col("prints"), F.col("e_prints")).alias("near_edited"), likeness(F.col("prints"), F.col("f_prints")).alias("near_next"),
    )
