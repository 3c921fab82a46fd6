import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

@pytest.fixture
def make_docs(spark):
    """A documents table with more columns, some of them named like results of the operators."""
    def make(rows):
        full = [(i, t, "en", "s", 7, 0.5, "x", 3) for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, score double, matches string, node int")
    return make


#: Rows that every operator has to take.
ODD = [(1, None), (2, ""), (3, " \t\n "), (None, "without an id " * 9), (4, "é" * 60), (4, "é" * 60), (5, "a"), (6, "!?" * 40), (7, "kuni " * 30_000)]


@pytest.fixture
def odd_docs(make_docs):
    return make_docs(ODD)
