"""The whole pipeline on a small table with odd rows, on workers that cannot import this repository."""

import json
import os
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry
import tests.llm as here

SCRIPT = '''
import json, sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", sys.argv[2] + "/shared").config("spark.log.level", "ERROR").getOrCreate())
def reach(_):
    try:
        import lifeloom
        return True
    except ModuleNotFoundError:
        return False
assert not any(spark.sparkContext.parallelize(range(4), 4).map(reach).collect()), "workers see the repository"
import corpus_pipeline
data, folder = "/root/testdata/sf0.001", sys.argv[2]
docs = spark.read.parquet(data + "/documents.parquet").limit(60)
bench, labels = (spark.read.parquet(f"{data}/{n}.parquet") for n in ("benchmark", "labels"))
good = docs.join(labels.filter("quality = 1"), "doc_id", "left_semi").select(*docs.columns).orderBy("doc_id")
one = good.first()
rows = [(None, one.text, one.lang, one.source, 1), (900001, None, None, None, None), (900002, "", "en", None, 0),
        (900003, one.text, "en", "s", 1), (900003, one.text, "en", "s", 1), (900004, (one.text + " ") * 300, "en", "s", 1)]
odd = spark.createDataFrame(rows, docs.schema)
for name, table in (("full", docs.unionByName(odd)), ("empty", docs.limit(0))):
    # Extra columns whose names the stages use themselves.
    more = table.select("*", *[F.lit(1).alias(c) for c in ("copy", "node", "pos", "_gone", "h", "word", "spans")])
    more.write.parquet(f"{folder}/{name}/documents.parquet")
    bench.write.parquet(f"{folder}/{name}/benchmark.parquet")
    labels.write.parquet(f"{folder}/{name}/labels.parquet")
    kept = corpus_pipeline.run(spark, f"{folder}/{name}").collect()
    print("RESULT", json.dumps({"name": name, "ids": [r.doc_id for r in kept], "best": one.doc_id}))
'''


def test_runs_where_workers_lack_the_package(tmp_path):
    repo = Path(entry.__file__).resolve().parent
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    (tmp_path / "job.py").write_text(SCRIPT)
    run = subprocess.run([sys.executable, "job.py", str(repo), str(tmp_path)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    results = {r["name"]: r for r in (json.loads(line[7:]) for line in run.stdout.splitlines() if line.startswith("RESULT"))}
    assert set(results) == {"full", "empty"}, run.stderr[-3000:]
    assert results["empty"]["ids"] == []
    ids = results["full"]["ids"]
    # Of the copies the smallest id stays; a row without an id is never removed as a copy.
    assert results["full"]["best"] in ids and 900003 not in ids


#: Queries without SQL, and the test that holds each against a plain version, held-out labels or a round trip.
PLAIN = {
    "op1_license_scan": "test_operators.test_licences",
    "op3_i_match": "test_operators.test_imatch",
    "op4_pii": "test_operators.test_pii",
    "op5_secret_scan": "test_operators.test_secrets",
    "op6_quality_classifier": "test_operators.test_quality",
    "op7_url_filter": "test_operators.test_urls",
    "op8_simhash_near_dedup": "test_operators.test_simhash",
    "op10_sentencepiece": "test_operators.test_lattice",
    "op13_periodic_runs": "test_periods.test_report_against_plain",
    "pipeline": "test_pipeline.test_runs_where_workers_lack_the_package",
}


def test_every_query_has_sql_or_a_plain_version():
    from lifeloom import workload

    own = set(entry.queries()) - set(workload.QUERIES)
    assert own == set(PLAIN) | (set(entry.oracle_sql()) - set(workload.ORACLES))
    folder = Path(here.__file__).parent
    for name in PLAIN.values():
        module, test = name.split(".")
        assert f"def {test}(" in (folder / f"{module}.py").read_text(), name
