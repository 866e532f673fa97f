"""Lines that repeat across documents, and texts without them.

1. Every text is cut at line feeds; a line's key is the line without outer blanks, A-Z folded.  Keys travel as two 64-bit
   hashes with different seeds, never as text.
2. (key, document) pairs are made distinct, so that a line a document repeats counts once, and documents are counted per
   key.  Both steps combine before they shuffle; the pairs of a hot key spread by document.
3. Keys found in enough documents go back to their lines.  Keys that hold more than a thousandth of all pairs, of which
   there are fewer than a thousand, are broadcast; the rest meet in a shuffle.  So no task gets all lines of a hot key.
4. What is dropped returns to its text as positions, and the text is put together from the positions that are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, heavy_join, same, settled

#: What is stripped around a line, and the shortest key in code points.
BLANKS = " \t\n\x0b\x0c\r"
MIN_CHARS = 10
MIN_DOCS = 2

ORACLE = """
WITH cut AS (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, r, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM cut),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
often AS (SELECT k, min(doc_id) AS keeper FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT keyed.*, often.k IS NOT NULL AND keyed.doc_id <> keeper AS gone FROM keyed LEFT JOIN often ON keyed.k = often.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id"""


def _texts(docs: DataFrame) -> DataFrame:
    """(doc_id, copy, text): ``copy`` is a hash of the text, so that rows which share an id stay apart."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("copy"), text.alias("text"))


def _parts() -> F.Column:
    return F.split("text", "\n", -1)


def keyed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, copy, pos, k1, k2): every line whose key has at least ``min_chars`` code points."""
    lines = _texts(docs).select("doc_id", "copy", F.posexplode(_parts()).alias("pos", "line"))
    key = F.translate(F.btrim("line", F.lit(BLANKS)), UPPER, LOWER)
    return (
        lines.withColumn("key", key).filter(F.char_length("key") >= min_chars)
        .select("doc_id", "copy", "pos", F.xxhash64(F.lit(1), "key").alias("k1"), F.xxhash64(F.lit(2), "key").alias("k2"))
    )


def repeated_keys(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(k1, k2, n_docs, unknown, keeper): keys in at least ``min_docs`` documents; ``keeper`` is the smallest id.

    Rows without an id are together one document, behind all others; ``unknown`` says that it is the keeper.
    """
    pairs = lines.select("k1", "k2", "doc_id").distinct()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("keeper"))).alias("first")
    return pairs.groupBy("k1", "k2").agg(F.count("*").alias("n_docs"), first).filter(F.col("n_docs") >= min_docs).select("k1", "k2", "n_docs", "first.*")


def without_repeats(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, kept, n_lines, n_dropped) of every row of ``docs``: its text without lines that other documents hold too.

    A line stays in the smallest id that holds it, as often as it stands there.  Null and empty texts are one
    empty line.  Rows of one id are one document: they keep lines that only they share.  Rows without an id are one
    document behind all others.  Repeated rows stay repeated.  An empty table gives an empty result; further columns are ignored.
    Keys are compared by 128 bits of hash.
    """
    lines = settled(keyed_lines(docs, min_chars), "line-keys")
    often = settled(repeated_keys(lines, min_docs), "line-often")
    gone = heavy_join(lines, often, ["k1", "k2"], "n_docs").filter(~same(F.col("doc_id"), F.col("keeper")))
    # A row that occurs several times names its positions several times.
    gone = gone.groupBy("doc_id", "copy").agg(F.collect_set("pos").alias("gone")).withColumnsRenamed({"doc_id": "g_id", "copy": "g_copy"})
    # Cut before the join: a lambda below it would cut the text once per line.
    texts = _texts(docs).select("doc_id", "copy", _parts().alias("parts"))
    joined = texts.join(gone, same(texts["doc_id"], gone["g_id"]) & (texts["copy"] == gone["g_copy"]), "left")
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    left = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), gone)
    return joined.select(
        "doc_id",
        F.array_join(F.transform(left, lambda i: F.get("parts", i)), "\n").alias("kept"),
        F.size("parts").cast("long").alias("n_lines"),
        F.size(gone).cast("long").alias("n_dropped"),
    )


def report(docs: DataFrame) -> DataFrame:
    """The contract's columns: what stays as a digest."""
    return without_repeats(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
