"""Parquet tables dealt by key, for frequent small changes.

A table is a fixed number of buckets by hash of the key.  A batch writes new versions of the buckets it touches, each
into a folder ``_bucket=…/_batch=…`` of its own, and then an empty marker.  Readers take of every bucket the newest
version that has a marker.  So a batch costs what its buckets hold, a batch that broke off leaves nothing that is read,
one that is run again is known by its tag, and no file is ever changed in place.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lifeloom.session import settle
from lifeloom.sources.tables import upserted

#: A bucket is one task's work in a merge: choose so many that a bucket stays below some hundred megabytes.
BUCKETS = 16


class KeyedTable:
    """One row per ``key``.  One writer at a time; readers at any time."""

    def __init__(self, spark: SparkSession, path: str, key: list[str], buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets

    # -- folders ---------------------------------------------------------
    def _fs(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), place

    def _names(self, pattern: str) -> list[str]:
        fs, place = self._fs(f"{self.path}/{pattern}")
        return [s.getPath().toString() for s in (fs.globStatus(place) or [])]

    def committed(self) -> dict[str, int]:
        """Number of the batch of each tag that has a marker."""
        names = (n.rsplit("/", 1)[1].split("-", 1) for n in self._names("_committed/*"))
        return {tag: int(number) for number, tag in names}

    def versions(self) -> dict[int, list[int]]:
        """Batches of each bucket, newest first, finished or not: buckets x versions kept, whatever the number of rows."""
        found: dict[int, list[int]] = {}
        for name in self._names("_bucket=*/_batch=*"):
            bucket, batch = (int(part.split("=")[1]) for part in name.rsplit("/", 2)[1:])
            found.setdefault(bucket, []).append(batch)
        return {bucket: sorted(batches, reverse=True) for bucket, batches in found.items()}

    def schema(self) -> StructType:
        """The table's columns, as the newest marker states them."""
        newest = max(self._names("_committed/*"), key=lambda n: int(n.rsplit("/", 1)[1].split("-", 1)[0]))
        fs, place = self._fs(newest)
        stream = fs.open(place)
        try:
            return StructType.fromJson(json.loads(stream.readUTF()))
        finally:
            stream.close()

    # -- rows ------------------------------------------------------------
    def exists(self) -> bool:
        return bool(self.committed())

    def read(self) -> DataFrame:
        if not self.exists():
            raise FileNotFoundError(f"no finished batch below {self.path}")
        return self._read(self.schema())

    def _read(self, schema: StructType, only: set[int] | None = None) -> DataFrame:
        """The newest finished versions; columns that a file lacks are NULL."""
        finished = set(self.committed().values())
        newest = {b: next((v for v in versions if v in finished), None) for b, versions in self.versions().items()}
        paths = [f"{self.path}/_bucket={b}/_batch={v}" for b, v in newest.items() if v is not None and (only is None or b in only)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def merge(self, tag: str, rows: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> int:
        """Fold ``rows`` into the table and return the number of buckets written; a tag that is finished does nothing.

        ``combine(before, rows)`` gets the touched buckets as they were and the new rows, and returns what the buckets hold
        from now on; without it, fields of ``rows`` override by key.  It must not lose keys.  ``before`` has the columns of
        both sides, missing ones as NULL.
        """
        finished = self.committed()
        if tag in finished:
            return 0
        bucket = F.pmod(F.xxhash64(*[F.col(k) for k in self.key]), F.lit(self.buckets)).cast("int")
        placed = settle(rows.withColumn("_bucket", bucket))
        touched = {r[0] for r in placed.select("_bucket").distinct().collect()}  # at most ``buckets`` numbers
        number = 1 + max([*finished.values(), *(v[0] for v in self.versions().values())], default=0)
        rows = placed.drop("_bucket")
        schema = self.schema() if finished else StructType(rows.schema.fields)
        schema = StructType([*schema.fields, *[f for f in rows.schema.fields if f.name not in schema.names]])
        if touched:
            # The table's types stay.
            rows = rows.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in rows.columns])
            before = self._read(schema, touched)
            after = combine(before, rows) if combine else upserted(before, rows, self.key)
            schema = StructType([*schema.fields, *[f for f in after.schema.fields if f.name not in schema.names]])
            after = after.withColumn("_bucket", bucket).withColumn("_batch", F.lit(number)).repartition("_bucket")
            writer = after.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("_bucket", "_batch").parquet(self.path)
        # Written aside and renamed: a marker is whole or not there.
        fs, aside = self._fs(f"{self.path}/_next-{number}")
        stream = fs.create(aside, True)
        try:
            stream.writeUTF(json.dumps(StructType([StructField(f.name, f.dataType) for f in schema.fields]).jsonValue()))
        finally:
            stream.close()
        _, place = self._fs(f"{self.path}/_committed/{number}-{tag}")
        fs.mkdirs(place.getParent())
        if not fs.rename(aside, place):
            raise RuntimeError(f"could not finish batch {tag} below {self.path}")
        return len(touched)

    def prune(self, keep: int = 1) -> int:
        """Delete all but the ``keep`` newest finished versions of each bucket, and what broken batches left; no reader may be at work."""
        finished, gone = set(self.committed().values()), 0
        for bucket, batches in self.versions().items():
            kept = [v for v in batches if v in finished][: max(keep, 1)]
            for batch in set(batches) - set(kept):
                fs, place = self._fs(f"{self.path}/_bucket={bucket}/_batch={batch}")
                gone += bool(fs.delete(place, True))
        return gone


def batch_tag(spark: SparkSession, batch_id: int | str) -> str:
    """Name of a micro-batch that a restarted query gives it again, and no other query."""
    return f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId') or 'direct'}-{batch_id}"
