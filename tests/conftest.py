import sys
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("lifeloom-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def make(spark):
    """make('A STRING, B DATE', rows): a DataFrame from tuples; date-like text is converted by type."""

    def convert(kind, value):
        if value is None or not isinstance(value, str):
            return value
        if kind == "timestamp_ntz" or kind == "timestamp":
            return datetime.fromisoformat(value)
        if kind == "date":
            return date.fromisoformat(value)
        if kind.startswith("decimal"):
            from decimal import Decimal

            return Decimal(value)
        return value

    def build(schema, rows):
        empty = spark.createDataFrame([], schema)
        kinds = [f.dataType.simpleString() for f in empty.schema.fields]
        return spark.createDataFrame([tuple(convert(k, v) for k, v in zip(kinds, r)) for r in rows], empty.schema)

    return build
