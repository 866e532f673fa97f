"""Journeys advanced from a table of due rows, in place of the whole cohort at every run.

A row waits in the folder of the day on which its next decision is due.  A run reads the days since the run before, decides
these rows, and writes each of them either to the outcomes or into the folder of its next due day.  Every run writes
folders of its own, so a run that is repeated replaces what it wrote.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType

from lifeloom.functions.times import Moment, as_ts
from lifeloom.plans.journeys import LEFT, WAITING, exists_since
from lifeloom.session import settle

# The win-back series sends at these days after the entry and looks back at these.
WINBACK_STARTS = [0, 14, 28]
WINBACK_CHECKS = [14, 28, 58]
STATE = ["SubscriberKey", "EntryDate", "Step", "EmailsSent", "DueDate"]
OUTCOME = ["SubscriberKey", "EntryDate", "EmailsSent", "Outcome"]


class DueTable:
    """Waiting rows by due day and outcomes by run, below one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def schedule(self, run: int, rows: DataFrame) -> None:
        """Write rows into the folders of their due days."""
        placed = rows.select(*STATE, F.to_date("DueDate").alias("_due"), F.lit(run).alias("_run"))
        writer = placed.repartition("_due").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("_run", "_due").parquet(f"{self.path}/due")

    def close(self, run: int, rows: DataFrame) -> None:
        rows.select(*OUTCOME).write.mode("overwrite").parquet(f"{self.path}/outcomes/_run={run}")

    def _read(self, part: str, schema: StructType, run: int) -> DataFrame:
        """What runs before ``run`` wrote."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part}")
        fs = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(place):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{part}").filter(F.col("_run") < run)

    def take(self, run: int, since: Moment, until: Moment) -> DataFrame:
        """Rows due after ``since`` up to ``until``; only the folders of these days are read."""
        days = F.col("_due").between(F.to_date(as_ts(since)), F.to_date(as_ts(until)))
        rows = self._read("due", _DUE, run).filter(days)
        return rows.filter((F.col("DueDate") > as_ts(since)) & (F.col("DueDate") <= as_ts(until))).select(*STATE)

    def waiting(self, run: int, as_of: Moment) -> DataFrame:
        """Rows that are due after ``as_of``."""
        later = F.col("_due") >= F.to_date(as_ts(as_of))
        return self._read("due", _DUE, run).filter(later & (F.col("DueDate") > as_ts(as_of))).select(*STATE)

    def outcomes(self, run: int) -> DataFrame:
        return self._read("outcomes", _DONE, run).select(*OUTCOME)


def _columns(**kinds: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in kinds.items()])


_TIME = TimestampNTZType()
_DUE = _columns(
    SubscriberKey=StringType(), EntryDate=_TIME, Step=IntegerType(), EmailsSent=LongType(), DueDate=_TIME, _run=LongType(), _due=DateType()
)
_DONE = _columns(SubscriberKey=StringType(), EntryDate=_TIME, EmailsSent=LongType(), Outcome=StringType(), _run=LongType())


def _at(days: list[int], step="Step"):
    """EntryDate plus the days that belong to a step."""
    table = F.array(*[F.expr(f"INTERVAL '{d}' DAY") for d in days])
    return F.col("EntryDate") + F.get(table, F.col(step))


def advance_winback(
    due: DueTable, run: int, entries: DataFrame, opens: DataFrame, clicks: DataFrame, since: Moment, until: Moment, leaves: DataFrame | None = None
) -> None:
    """One run over (since, until]: new entries join, due decisions are made, everything else stays where it is.

    Of the events only those of the longest look-back before ``since`` are read.  A run over a long time makes all
    decisions that fell due in it, one after the other; there are as many as the series has checks.
    """
    back = max(b - a for a, b in zip(WINBACK_STARTS, WINBACK_CHECKS))
    recent = (F.col("EventDate") >= as_ts(since) - F.expr(f"INTERVAL '{back}' DAY")) & (F.col("EventDate") <= as_ts(until))
    events = opens.select("SubscriberKey", "EventDate").unionByName(clicks.select("SubscriberKey", "EventDate")).filter(recent)
    left = leaves.select("SubscriberKey", "LeftDate") if leaves is not None else None

    def with_leave(df: DataFrame) -> DataFrame:
        return df.join(left, "SubscriberKey", "left") if left is not None else df.withColumn("LeftDate", F.lit(None).cast("timestamp_ntz"))

    new = entries.filter((F.col("EntryDate") > as_ts(since)) & (F.col("EntryDate") <= as_ts(until)))
    new = with_leave(new.select("SubscriberKey", "EntryDate").withColumn("Step", F.lit(0)))
    here = F.col("LeftDate").isNull() | (F.col("LeftDate") > F.col("EntryDate"))
    new = new.select("SubscriberKey", "EntryDate", "Step", here.cast("bigint").alias("EmailsSent"), _at(WINBACK_CHECKS).alias("DueDate"))
    moving = settle(new.unionByName(due.take(run, since, until)))
    last = len(WINBACK_CHECKS) - 1
    ripe = F.col("DueDate") <= as_ts(until)
    # All decisions that fall due are looked up in the events at once; ``_seen`` has a bit for each step with an event.
    each = moving.filter(ripe).withColumn("_row", F.monotonically_increasing_id()).withColumn("_step", F.explode(F.sequence(F.col("Step"), F.lit(last))))
    each = each.withColumn("_due", F.when(F.col("_step") == F.col("Step"), F.col("DueDate")).otherwise(_at(WINBACK_CHECKS, "_step"))).filter(F.col("_due") <= as_ts(until))
    found = exists_since(each.withColumn("_from", _at(WINBACK_STARTS, "_step")), events, "_from", "_due", "EventDate", "_active")
    bit = F.when(F.col("_active"), F.pow(F.lit(2), F.col("_step")).cast("int")).otherwise(0)
    waiting, closed = [moving.filter(~ripe)], []
    moving = settle(found.groupBy("_row", *STATE).agg(F.bit_or(bit).alias("_seen")).drop("_row"))
    for step in range(last + 1):
        if step:
            waiting.append(moving.filter(~ripe).select(*STATE))
        judged = with_leave(moving.filter(ripe))
        judged = settle(judged) if left is not None else judged
        gone = F.coalesce(F.col("LeftDate") <= F.col("DueDate"), F.lit(False))
        active = F.get(F.array(*[F.col("_seen").bitwiseAND(1 << k) > 0 for k in range(last + 1)]), F.col("Step"))
        outcome = F.when(gone, LEFT).when(active, "EXIT-REENGAGED").when(F.col("Step") == last, "EXIT-SUNSET-PENDING")
        closed.append(judged.withColumn("Outcome", outcome).filter("Outcome IS NOT NULL").select(*OUTCOME))
        moving = judged.filter(outcome.isNull()).select(
            "SubscriberKey", "EntryDate", (F.col("Step") + 1).alias("Step"), (F.col("EmailsSent") + 1).alias("EmailsSent"), "_seen"
        ).withColumn("DueDate", _at(WINBACK_CHECKS))
    due.schedule(run, reduce(DataFrame.unionByName, waiting).select(*STATE))
    due.close(run, reduce(DataFrame.unionByName, closed))


def winback_rows(due: DueTable, run: int, as_of: Moment) -> DataFrame:
    """(SubscriberKey, EntryDate, EmailsSent, Outcome) of all entries up to ``as_of``, after the runs before ``run``."""
    open_ = due.waiting(run, as_of).withColumn("Outcome", F.lit(WAITING))
    return due.outcomes(run).unionByName(open_.select(*OUTCOME))
