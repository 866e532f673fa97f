"""Registry of named queries with their independent SQL check."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lifeloom.workload.views import BASE_TABLES, VIEWS

QUERIES: dict[str, Callable[["Tables"], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def placeholders(sql: str) -> list[str]:
    return list(dict.fromkeys(name for _, name, _, _ in string.Formatter().parse(sql) if name))


class Tables:
    """Driver tables and the domain views over them, resolved on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._seen: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._seen:
            if name in VIEWS:
                text = VIEWS[name]
                needed = {n: getattr(self, n) for n in placeholders(text)}
                self._seen[name] = self.spark.sql(text, **needed)
            elif name in BASE_TABLES:
                self._seen[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            else:
                raise AttributeError(name)
        return self._seen[name]

    def sql(self, text: str) -> DataFrame:
        return self.spark.sql(text, **{n: getattr(self, n) for n in placeholders(text)})


def tidy(df: DataFrame) -> DataFrame:
    """Types both engines report alike: doubles for decimals, longs for integers, no time zone."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.FloatType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(f.name))
    return df.select(*out)


def composed(sql: str) -> str:
    """Check SQL with the views it needs in front, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in VIEWS and name not in order:
            for inner in placeholders(VIEWS[name]):
                visit(inner)
            order.append(name)

    for name in placeholders(sql):
        visit(name)

    def plain(text: str) -> str:
        return text.format(**{n: n for n in placeholders(text)})

    body = plain(sql).strip()
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({plain(VIEWS[n]).strip()})" for n in order)
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def query(key: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``key``, with the SQL that must agree."""

    def register(fn: Callable[[Tables], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"duplicate query {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = composed(sql)
        return fn

    return register


def runner(key: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return tidy(QUERIES[key](Tables(spark, folder)))

    run.__name__ = key
    return run
