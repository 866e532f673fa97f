"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings this library is tuned for.  All are runtime-settable hints; results never depend on them.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when that costs one more exchange above it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
}


#: Bytes of rows that a task hands to Python at once; Spark's own bound is 64 MB, and buffers are doubled on the way there.
BATCH_BYTES = 1 << 22


def small_batches(spark: SparkSession) -> SparkSession:
    """Bound the rows that a task and its Python worker hold at once, for jobs of many Arrow passes."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`RECOMMENDED` to a running session."""
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the session.

    Only when the session names none (unit tests) is a local folder chosen.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if named:
        if current is None:
            context.setCheckpointDir(named)
        return named
    if current is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="lifeloom-"))
        current = context.getCheckpointDir()
    return current


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path below :func:`shared_dir`."""
    return f"{shared_dir(spark).rstrip('/')}/lifeloom/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss and fixes non-repeatable columns."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def kept(df: DataFrame, label: str) -> DataFrame:
    """Like :func:`settle` for large tables: written once as compressed columns, which take a fraction of a checkpoint's disk; the folder is
    removed when the application ends."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)
