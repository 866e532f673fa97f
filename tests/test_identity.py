"""Identity links and components: whole results, and what is moved for them."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lifeloom.functions import forests, meeting
from lifeloom.functions.similarity import jaro_winkler_text, pairs_within
from lifeloom.operators import identity

RECORD = "RecordId STRING, EmailAddress STRING, MobileNumber STRING, FirstName STRING, LastName STRING, PostalCode STRING"


def names(number, seed, letters="aeioulnrstm"):
    rng = random.Random(seed)
    some = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(number)}
    some |= {"mc" + n for n in sorted(some)[::3]} | {n + "s" for n in sorted(some)[::4]} | {n[1] + n[0] + n[2:] for n in sorted(some)[::5] if len(n) > 1}
    return sorted(some)


def test_all_records_of_a_name_are_paired(make):
    """records that share a name, and each of them with the records of a near name."""
    rows = [(f"R{i}", None, None, first, last, postal) for i, (first, last, postal) in enumerate([
        ("Jonathan", "Smithson", "1"), (" jonathan", "SMITHSON ", "1"), ("Jonathan", "Smithsons", "1"), ("Jonathann", "Smithson", "1"),
        ("Jonathan", "Smithson", "2"), ("Zoe", "Smithson", "1"), ("Jonathan", None, "1"), ("Jonathan", "", "1"), (None, "Smithson", "1"),
    ])]
    got = sorted((r.Left, r.Right) for r in identity.name_pairs(make(RECORD, rows + rows[:2]), 0.95).collect())
    assert got == [("R0", "R1"), ("R0", "R2"), ("R0", "R3"), ("R1", "R2"), ("R1", "R3"), ("R2", "R3")]


def test_the_query_of_name_pairs_agrees_with_its_sql(spark, tmp_path):
    """also where a customer's key comes twice, with different nations."""
    import duckdb

    from lifeloom.workload import ORACLES, runner

    rows = [(k, f"Customer#{k:09}", n, 5.0, "BUILDING") for k in (1001, 1002, 10011, 10012, 10021) for n in (1, 2)]
    spark.createDataFrame(rows, "c_custkey LONG, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING").coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    got = sorted(map(tuple, runner("join_fuzzy_blocked")(spark, str(tmp_path)).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet/*.parquet'")
    assert got and got == sorted(con.execute(ORACLES["join_fuzzy_blocked"]).fetchall())


@pytest.mark.parametrize("threshold", [0.8, 0.9, 0.95])
@pytest.mark.parametrize("whole", [0, 4])
def test_texts_of_many_units_meet(monkeypatch, threshold, whole):
    """near pairs of several units at once, in one of which only the two sides meet; with keys and without, each pair once."""
    monkeypatch.setattr(meeting, "WHOLE", whole)
    monkeypatch.setattr(meeting, "AT_ONCE", 300)
    rng = random.Random(7)
    items = sorted({(rng.randrange(3), rng.randrange(2), n) for n in names(120, 1) + ["é", "éa", "ab" * 40, "ab" * 39 + "ba"] for _ in range(2)})
    unit, side = (np.array([i[c] for i in items]) for c in (0, 1))
    side, cross = np.where(unit == 2, side, 0), unit == 2
    items, first = np.unique([f"{u} {s} {i[2]}" for u, s, i in zip(unit, side, items)], return_index=True)
    unit, side, cross = unit[first], side[first], cross[first]
    texts = [i.split(" ", 2)[2] for i in items]
    left, right = (np.array([rng.random() < 0.7 for _ in texts]) for _ in range(2))
    got = sorted(tuple(sorted(p)) for x, y in meeting.near_items(texts, unit, side, cross, left, right, threshold) for p in zip(x.tolist(), y.tolist()))
    want = [(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if unit[i] == unit[j] and (not cross[i] or side[i] != side[j])
            and ((left[i] and right[j]) or (left[j] and right[i])) and jaro_winkler_text(texts[i], texts[j]) >= threshold]
    assert want and got == want


def test_a_row_is_moved_once_for_each_tile(spark, monkeypatch):
    """names of one cell are moved as they are, not once for each key; before, some 60 keys of a name were."""
    moved = []
    plain = meeting.near_rows

    def counted(by, *rest):
        moved.append(by)
        return plain(by, *rest)

    monkeypatch.setattr(meeting, "near_rows", counted)
    some = names(700, 3)
    df = spark.createDataFrame([(n, i, "x") for i, n in enumerate(some)], "n STRING, i INT, g STRING").withColumns({"_left": F.lit(True), "_right": F.lit(True)})
    got = pairs_within(df, ["g"], "n", "i", 0.9, once=True)
    plan = got._jdf.queryExecution().analyzed().toString()
    assert moved == [["g", "_lo", "_hi"]] and "_key" not in plan and plan.count("Repartition") == 1
    assert got.count() == sum(jaro_winkler_text(a, b) >= 0.9 for i, a in enumerate(some) for b in some[:i])


def test_contracted_edges_connect_the_same(spark, monkeypatch):
    """a partition's edges become one for each of its nodes, whatever their number."""
    rng = random.Random(5)
    edges = [(f"n{rng.randrange(90)}", f"n{rng.randrange(90)}") for _ in range(70)] * 30 + [("self", "self"), (None, "x")]
    df = spark.createDataFrame(edges, "u STRING, v STRING").repartition(2)
    got = [tuple(r) for r in forests.contracted(df).collect()]
    nodes = {n for e in edges for n in e if n}
    assert len(got) <= 2 * len(nodes) + 1 and ("self", "self") in got and (None, "x") in got

    def parts(pairs):
        code = {n: i for i, n in enumerate(sorted(nodes))}
        u, v = (np.array([code[p[i]] for p in pairs if p[0]]) for i in range(2))
        return forests.roots(u, v, len(code)).tolist()

    assert parts(got) == parts(edges)
    u, v = (pa.array([e[i] for e in edges if e[0]]) for i in range(2))
    assert all(r <= n for n, r in zip(*(x.to_pylist() for x in forests.starred(u, v))))
    # Chunk by chunk, and when nodes are let go.
    monkeypatch.setattr(forests, "EDGES", 50), monkeypatch.setattr(forests, "NODES", 20)
    batches = pa.Table.from_arrays([u, v], names=["u", "v"]).to_batches(max_chunksize=25)
    out = [tuple(r) for b in forests._contract(iter(batches)) for r in zip(*(c.to_pylist() for c in b.columns))]
    assert parts(out) == parts(edges)


def test_components_of_many_links_of_few_records(spark):
    """F1 F2 F3: what the rounds begin with grows with the records, not with the links."""
    ids = [f"r{i:03}" for i in range(60)]
    links = spark.createDataFrame([(a, b) for a in ids[:40] for b in ids[:40] if a < b] + [(ids[i], ids[i + 1]) for i in range(45, 58)], "Left STRING, Right STRING").repartition(4)
    found = {r.RecordId: r.UnifiedIndividualId for r in identity.components(spark.createDataFrame([(i,) for i in ids], "RecordId STRING"), links).collect()}
    assert found == {n: "r000" if i < 40 else "r045" if 45 <= i < 59 else n for i, n in enumerate(ids)}
    assert forests.contracted(links).count() <= 4 * 54


def test_advance_draws_contracted_links(spark, monkeypatch):
    """the joins to the individuals see contracted links."""
    seen, plain = [], identity.contracted
    monkeypatch.setattr(identity, "contracted", lambda df: seen.append(df.columns) or plain(df))
    known = spark.createDataFrame([(f"r{i:02}", "r00" if i < 9 else f"r{i:02}") for i in range(20)], "RecordId STRING, UnifiedIndividualId STRING")
    links = spark.createDataFrame([(a, b) for a in ("r05", "r12") for b in ("r13", "r14", "z")] + [("alone", "alone")], "Left STRING, Right STRING")
    got = {tuple(r) for r in identity.advance(known, spark.createDataFrame([("late",)], "RecordId STRING"), links).collect()}
    assert got == {("r12", "r00"), ("r13", "r00"), ("r14", "r00"), ("z", "r00"), ("alone", "alone"), ("late", "late")}
    assert ["Left", "Right"] in seen
