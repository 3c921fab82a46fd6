"""Every registered query against its SQL counterpart at the smallest scale."""

import math
import os
import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from workload import queries as own_queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    return con


def normal(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)

    def value(v):
        return None if isinstance(v, float) and math.isnan(v) else v

    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(own_queries.QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = entry_module.queries()[name](spark, DATA)
    got = normal(result.columns, [tuple(r) for r in result.collect()])
    found = duck.execute(entry_module.oracle_sql()[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(result.columns)
    assert got == normal(names, found.fetchall())


def test_flagship(spark):
    result = entry_module.entry(spark)
    assert not result.isEmpty()


def test_library_avoids_what_does_not_scale():
    banned = re.compile(r"crossJoin|localCheckpoint|\.collect\(\)|toLocalIterator|toPandas|toArrow|\.rdd\b")
    root = Path(entry_module.__file__).parent / "tidegate"
    for path in root.glob("**/*.py"):
        if "llm" not in path.relative_to(root).parts:
            found = banned.findall(path.read_text())
            # the query slices of both searches and the phrase parts, bounded by bytes
            assert found == {"dense.py": ["toPandas"], "retrieval.py": ["toArrow"],
                             "phrases.py": ["toLocalIterator"]}.get(path.name, []), path


def test_registry_without_the_subpackage(tmp_path):
    """A copy without ``tidegate/llm``, ``tests/llm`` and the pipeline still registers the other queries."""
    import shutil
    import subprocess
    import sys

    root = Path(entry_module.__file__).parent
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py"))
    probe = "import __spark_entry__ as e; print(len(e.queries()), sorted(e.queries()) == sorted(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", probe], cwd=copy, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    assert done.stdout.split() == [str(len(own_queries.QUERIES)), "True"]
