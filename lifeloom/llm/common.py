"""Helpers shared by the operators: words, settled tables, connected components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch, shared_dir

#: Maps UTF-8 bytes to themselves, A-Z to a-z, and every ASCII byte that is neither digit nor letter to a blank.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
#: The same words for Spark's regular expressions: what lies between them.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def byte_words(text: str | None) -> list[bytes]:
    """Lower-cased words of a text (A-Z only are folded), as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def word_array(text) -> F.Column:
    """The same words as an array column: null and empty texts give an empty array."""
    folded = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(folded, SEPARATORS), lambda w: w != "")


def settled(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the cluster's shared folder and read it back.

    Cuts the lineage so that a lost executor costs no recomputation, keeps columns prunable,
    and fixes generated ids.  The folder is removed when the application ends.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def same(a, b):
    """Equality in which nulls match each other."""
    return a.eqNullSafe(b)


#: Share of all weight, as one in so many, above which a key counts as heavy; fewer than this many keys can.
HEAVY = 1000


def heavy_join(rows: DataFrame, keyed: DataFrame, on: list[str], weight: str) -> DataFrame:
    """``rows`` joined to ``keyed`` (one row per key, ``weight`` its number of rows or less); no task gets a heavy key whole.

    Keys above 1/HEAVY of the summed weight are fewer than HEAVY, so they are broadcast, and their rows stay where
    they are.  The others meet in a shuffle.  Both inputs are read twice: pass settled ones.
    """
    total = keyed.agg(F.sum(weight)).first()[0] or 0
    heavy = keyed.filter(F.col(weight) * HEAVY > total)
    light = keyed.filter(F.col(weight) * HEAVY <= total)
    here = rows.join(F.broadcast(heavy), on)
    rest = rows.join(F.broadcast(heavy.select(*on)), on, "left_anti")
    return here.unionByName(rest.join(light, on))


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of true values."""
    edge = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def components(edges: DataFrame, label: str, max_rounds: int = 40) -> DataFrame:
    """(u, root): for every end of an edge (u, v) of longs, the smallest id that it reaches.

    Alternating large-star and small-star steps: a grouped minimum and a join per step, no
    growth in the number of edges, rounds logarithmic in the longest chain.  Every round is a
    written table; count and hash sum of the edges tell when a round changes nothing.
    """
    shared_dir(edges.sparkSession)
    now = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    now, before = settled(now, label), None
    for _ in range(max_rounds):
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            return now.groupBy("u").agg(F.min("v").alias("root")).unionByName(
                now.select(F.col("v").alias("u"), F.col("v").alias("root")).join(now.select("u"), "u", "left_anti").distinct()
            )
        before = mark
        now = settled(_small_star(_large_star(now)), label)
    raise RuntimeError(f"components did not settle within {max_rounds} rounds")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    near = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
