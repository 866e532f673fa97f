"""Versioned parquet tables.

Parquet has no UPDATE, DELETE or MERGE, so a job computes the new version of a table,
writes it beside the current one and then moves a one-line pointer.  Readers see the
old or the new version, never a mix, and a plan never overwrites a path it reads.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lifeloom.functions.times import Moment, as_ts


class TableStore:
    """Tables below one root folder on any Hadoop-compatible file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- pointer ---------------------------------------------------------
    def _fs(self, path: str):
        jvm = self.spark._jvm
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path

    def _pointer(self, name: str) -> str:
        return f"{self.root}/{name}/_current"

    def version(self, name: str) -> int:
        fs, path = self._fs(self._pointer(name))
        if not fs.exists(path):
            return 0
        stream = fs.open(path)
        try:
            return int(stream.readUTF())
        finally:
            stream.close()

    def _move_pointer(self, name: str, version: int) -> None:
        """The pointer is written aside and renamed, so that a reader never meets half of it."""
        fs, path = self._fs(self._pointer(name))
        _, aside = self._fs(f"{self.root}/{name}/_next-{uuid.uuid4().hex}")
        stream = fs.create(aside, True)
        try:
            stream.writeUTF(str(version))
        finally:
            stream.close()
        fs.delete(path, False)
        if not fs.rename(aside, path):
            raise RuntimeError(f"{name}: another writer moved the pointer at the same time")

    def path(self, name: str, version: int | None = None) -> str:
        return f"{self.root}/{name}/v={version or self.version(name):06d}"

    def _folders(self, name: str) -> list[str]:
        """The current version, and the folders that were appended to it."""
        path = self.path(name)
        fs, pattern = self._fs(f"{path}+*/_SUCCESS")
        return [path, *sorted(s.getPath().getParent().toString() for s in (fs.globStatus(pattern) or []))]

    # -- reads and writes ------------------------------------------------
    def keyed(self, name: str, key: list[str]):
        """The table of this name that is dealt by key; a table that is there already is loaded into it first."""
        from lifeloom.sources.keyed import KeyedTable

        table = KeyedTable(self.spark, f"{self.root}/{name}/keyed", key)
        if self.version(name) and not table.exists():
            table.merge("loaded", self.spark.read.parquet(*self._folders(name)))
        return table

    def _is_keyed(self, name: str) -> bool:
        fs, path = self._fs(f"{self.root}/{name}/keyed/_committed")
        return fs.exists(path)

    def exists(self, name: str) -> bool:
        return self.version(name) > 0 or self._is_keyed(name)

    def read(self, name: str) -> DataFrame:
        if self._is_keyed(name):
            return self.keyed(name, []).read()
        return self.spark.read.parquet(*self._folders(name))

    def replace(self, name: str, df: DataFrame, partition_by: list[str] = ()) -> DataFrame:
        """Truncate-and-load, or SELECT INTO for a new name."""
        if self._is_keyed(name):
            raise ValueError(f"{name} is dealt by key: merge into it instead")
        version = self.version(name) + 1
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(self.path(name, version))
        self._move_pointer(name, version)
        return self.read(name)

    def append(self, name: str, rows: DataFrame, key: list[str]) -> DataFrame:
        """Add rows whose key is not present yet, so that a re-run adds nothing.

        Of several new rows of one key the smallest is added, columns compared in their order.  The rows go into a folder
        of their own, which readers see once it is complete; nothing that is there is written again.
        """
        rest = [c for c in rows.columns if c not in key]
        if rest:
            rows = rows.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_row")).select(*key, "_row.*").select(*rows.columns)
        else:
            rows = rows.distinct()
        if not self.exists(name):
            return self.replace(name, rows)
        current = self.read(name)
        fresh = rows.join(current.select(*key), key, "left_anti").select(*current.columns)
        fresh.write.parquet(f"{self.path(name)}+{uuid.uuid4().hex}")
        return self.read(name)

    def upsert(self, name: str, rows: DataFrame, key: list[str], latest: str | None = None) -> DataFrame:
        if not self.exists(name):
            return self.replace(name, rows if latest is None else latest_rows(rows, key, latest))
        return self.replace(name, upserted(self.read(name), rows, key, latest))

    def publish(self, tables: dict[str, DataFrame]) -> None:
        """Write every new version first and move the pointers only when all are complete."""
        versions = {}
        for name, df in tables.items():
            versions[name] = self.version(name) + 1
            df.write.mode("overwrite").parquet(self.path(name, versions[name]))
        for name, version in versions.items():
            self._move_pointer(name, version)


def latest_rows(df: DataFrame, key: list[str], by: str) -> DataFrame:
    """One row per key, the latest by ``by`` (map-side combined, so a hot key is cheap)."""
    rest = [c for c in df.columns if c not in key]
    newest = F.max_by(F.struct(*rest), F.struct(by, *[c for c in rest if c != by])).alias("_row")
    return df.groupBy(*key).agg(newest).select(*key, "_row.*").select(*df.columns)


def upserted(target: DataFrame, rows: DataFrame, key: list[str], latest: str | None = None) -> DataFrame:
    """Upsert by key: fields present in ``rows`` override, absent fields keep their value.

    ``latest`` names a column that decides between several incoming rows of one key.
    """
    if latest is not None:
        rows = latest_rows(rows, key, latest)
    incoming = rows.select(
        *[F.col(k).alias(f"_n_{k}") for k in key],
        *[F.col(c).alias(f"_n_{c}") for c in rows.columns if c not in key],
        F.lit(True).alias("_new"),
    )
    on = [F.col(k) == F.col(f"_n_{k}") for k in key]
    columns = list(target.columns) + [c for c in rows.columns if c not in target.columns]
    picked = []
    for c in columns:
        if c in key:
            picked.append(F.coalesce(F.col(f"_n_{c}"), F.col(c)).alias(c))
        elif c not in rows.columns:
            picked.append(F.col(c))
        else:
            old = F.col(c) if c in target.columns else F.lit(None)
            picked.append(F.when(F.col("_new"), F.col(f"_n_{c}")).otherwise(old).alias(c))
    return target.join(incoming, on, "full_outer").select(*picked)


def updated_from(
    target: DataFrame, source: DataFrame, key: list[str], where: Column, set_: dict[str, Column]
) -> DataFrame:
    """``UPDATE target SET … FROM source WHERE …`` as a rewrite of the snapshot.

    ``source`` has at most one row per key, its other columns prefixed so that they do
    not clash with the target's; unmatched rows and rows failing ``where`` are unchanged.
    """
    joined = target.join(source.withColumn("_matched", F.lit(True)), key, "left")
    apply = F.coalesce(F.col("_matched") & where, F.lit(False))
    return joined.withColumn("_apply", apply).select(
        *[
            F.when(F.col("_apply"), set_[c]).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c)
            if c in set_
            else F.col(c)
            for c in target.columns
        ]
    )


def updated_where(target: DataFrame, where: Column, set_: dict[str, Column]) -> DataFrame:
    """``UPDATE target SET … WHERE …`` without a second table."""
    apply = F.coalesce(where, F.lit(False))
    return target.withColumn("_apply", apply).select(
        *[
            F.when(F.col("_apply"), set_[c]).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c)
            if c in set_
            else F.col(c)
            for c in target.columns
        ]
    )


def deleted_where(target: DataFrame, where: Column) -> DataFrame:
    """Rows for which ``where`` is false or unknown, as DELETE leaves them."""
    return target.filter(~F.coalesce(where, F.lit(False)))


def with_parent(child: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """The child rows that survive an orphan delete."""
    return child.join(parent.select(column), column, "left_semi")


def export_csv(df: DataFrame, folder: str, name: str, as_of: Moment) -> str:
    """Write ``name_YYYYMMDD.csv`` (a folder of part files with headers) and return its path."""
    day = df.sparkSession.range(1).select(F.date_format(as_ts(as_of), "yyyyMMdd")).first()[0]
    path = f"{folder.rstrip('/')}/{name}_{day}.csv"
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def export_and_clear(store: TableStore, name: str, folder: str, as_of: Moment) -> str:
    """Export a table, and remove what was exported only after the export has succeeded.

    ``current`` is fixed to the files it was read from; rows that came later stay for the next export.
    """
    current = store.read(name)
    path = export_csv(current, folder, name, as_of)
    store.replace(name, store.read(name).exceptAll(current))
    return path
