"""The registered queries and the pipeline on the smallest tables."""

import os

import duckdb
import pytest

import corpus_pipeline
from tidegate.llm.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    got = QUERIES[name](spark, DATA)
    rows = sorted(map(tuple, got.select(sorted(got.columns)).collect()), key=repr)
    assert rows
    if name in ORACLE_SQL:
        con = duckdb.connect()
        for file in os.listdir(DATA):
            con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{file}'")
        want = con.execute(ORACLE_SQL[name])
        names = [c[0] for c in want.description]
        assert sorted(names) == sorted(got.columns)
        order = sorted(range(len(names)), key=names.__getitem__)
        assert rows == sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=repr)


def test_pipeline_stages(spark, tmp_path):
    docs = start = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DATA).write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        kept[name] = docs
        if number < 4:
            assert docs.schema.simpleString() == start.schema.simpleString()
    quality = spark.read.parquet(f"{DATA}/labels.parquet").join(kept["quality"], "doc_id").groupBy("quality").count()
    counts = {r.quality: r["count"] for r in quality.collect()}
    assert counts.get(0, 0) <= 0.1 * counts[1]
    assert 0 < kept["near_duplicates"].count() < kept["quality"].count()
    assert kept["tokens"].count() == kept["near_duplicates"].count() == kept["tokens"].where("exact").count()
    before, after = (kept[n].selectExpr("sum(length(text)) n").first().n for n in ("near_duplicates", "repeats"))
    assert after < before
    again = corpus_pipeline.run(spark, DATA)
    assert sorted(again.select("doc_id", "n_tokens").collect()) == sorted(docs.select("doc_id", "n_tokens").collect())


def test_pipeline_stages_take_odd_and_no_rows(spark, odd_docs):
    for docs in (odd_docs, odd_docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[1:]:
            got = stage(spark, docs, DATA)
            assert got.count() == docs.count() - (1 if name == "near_duplicates" and docs.count() else 0)
            if name != "tokens":
                assert got.columns == docs.columns
        assert corpus_pipeline.quality(spark, docs, DATA).columns == docs.columns


def test_the_mix_reaches_the_tokens(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i} " * (1 + i % 50), "abc"[i % 3]) for i in range(2000)], "doc_id long, text string, source string")
    mixed = corpus_pipeline.mixing(spark, docs, DATA)
    want = [(x.doc_id, x.source) for x in mixed.collect()]
    mixed.repartition(7).write.parquet(str(tmp_path / "mixed"))
    got = corpus_pipeline.tokens(spark, spark.read.parquet(str(tmp_path / "mixed")), DATA)
    got.write.parquet(str(tmp_path / "tokens"))
    got = spark.read.parquet(str(tmp_path / "tokens")).orderBy("mix_position", "mix_place")
    assert [(x.doc_id, x.source) for x in got.collect()] == want


def test_stages_hand_python_small_batches(spark):
    """A partition of 20 MB reaches a Python worker in batches of about 4 MB once a stage is set up."""
    import pyarrow as pa
    from pyspark.sql import functions as F

    def largest(batches):
        yield pa.RecordBatch.from_pydict({"n": [max(b.nbytes for b in batches)]})

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    before = spark.conf.get(setting := "spark.sql.execution.arrow.maxBytesPerBatch")
    try:
        spark.conf.unset(setting)
        corpus_pipeline.tokens(spark, docs, DATA)
        wide = spark.range(20, numPartitions=1).select(F.repeat(F.lit("word "), 200_000).alias("text"))
        assert wide.mapInArrow(largest, "n long").first()[0] < 8 << 20
    finally:
        spark.conf.set(setting, before)


def test_memory_of_an_earlier_owner_goes_back():
    """What one operator remembered leaves the process when another one begins, though later objects lie behind it."""
    import subprocess
    import sys
    from pathlib import Path

    code = """
import re
from pathlib import Path
from tidegate.llm.common import remembered

def held():
    return sum(map(int, re.findall(r"Pss_Anon:\\s+(\\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024

remembered("a")["words"] = [bytes(2000) for _ in range(100_000)]
behind, full = bytes(2000), held()
remembered("b")
print(full - held())
"""
    root = Path(__file__).resolve().parents[2]
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert float(out.stdout) > 150
