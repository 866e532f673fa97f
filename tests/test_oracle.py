"""Every registered query against its SQL check on the smallest data set."""

import duckdb
import pytest

import __spark_entry__ as entry
from lifeloom import workload
from tests.conftest import DATA

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="driver tables not present")
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(f"{r[i]:.6g}" if isinstance(r[i], float) else repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_check_sql(spark, duck, key):
    df = entry.queries()[key](spark, str(DATA))
    result = duck.execute(ORACLES[key])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(result.fetchall(), names)


def test_every_query_has_a_check():
    """Queries of the training-data folder may have a brute-force test instead; ``tests/llm`` asks for one of the two."""
    assert set(workload.QUERIES) == set(workload.ORACLES)
    assert set(workload.QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
