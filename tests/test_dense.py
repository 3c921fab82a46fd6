import numpy as np
import pytest

from tidegate.operators.dense import dense_knn


def brute_force(vectors, queries, k):
    def unit(v):
        n = np.linalg.norm(v)
        return np.array(v) / n if n else np.zeros(len(v))

    return {q: sorted((round(1 - float(unit(a) @ unit(b)), 9) + 0.0, v) for v, b in vectors)[:k]
            for q, a in queries}


@pytest.mark.parametrize("limit", [500, 2**25])
def test_any_slicing_equals_brute_force(spark, limit):
    rng = np.random.default_rng(5)
    vectors = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(150)]
    vectors = [(i, vectors[0][1] if i % 3 == 0 else v) for i, v in vectors] + [(900, [0.0] * 6)]
    queries = vectors[:20] + [(900, [0.0] * 6)]
    v = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(3)
    q = spark.createDataFrame(queries, "query_id long, embedding array<double>")
    got = {}
    rows = dense_knn(v, q, k=4, block_rows=16, slice_bytes=limit)
    for r in rows.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.distance, r.vec_id))
    want = brute_force(vectors, queries, 4)
    assert got.keys() == want.keys()
    for key in want:
        assert [x[1] for x in got[key]] == [x[1] for x in want[key]]
        assert [x[0] for x in got[key]] == pytest.approx([x[0] for x in want[key]], abs=2e-9)


def test_fewer_vectors_than_k(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0])], "vec_id long, embedding array<float>")
    q = v.withColumnRenamed("vec_id", "query_id")
    assert [tuple(r) for r in dense_knn(v, q).collect()] == [(1, 1, 1, 0.0)]


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, []), (5, [nan, 1.0]), (6, [1.0, inf]), (7, [None, 1.0]), (8, [1.0, 2.0, 3.0]), (9, [2.0, 0.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    got = {}
    for r in dense_knn(v, v.withColumnRenamed("vec_id", "query_id"), k=5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.distance))
    assert got == {1: [(1, 0.0), (9, 0.0), (2, 1.0)], 2: [(1, 1.0), (2, 1.0), (9, 1.0)], 8: [(8, 0.0)], 9: [(1, 0.0), (9, 0.0), (2, 1.0)]}


def test_no_queries(spark):
    v = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<double>")
    assert dense_knn(v, v.withColumnRenamed("vec_id", "query_id").limit(0)).count() == 0


def test_neither_side_passes_the_driver(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    def refused(self, *_):
        raise AssertionError("collected")

    for name in ("toPandas", "toArrow", "toLocalIterator"):
        monkeypatch.setattr(DataFrame, name, refused)
    v = spark.range(300).selectExpr("id AS vec_id", "array(cos(id), sin(id)) AS embedding").repartition(3)
    found = dense_knn(v, v.withColumnRenamed("vec_id", "query_id"), k=2, slice_bytes=500)
    plan = found._jdf.queryExecution().executedPlan().toString()
    monkeypatch.undo()
    assert "CartesianProduct" in plan and "BroadcastExchange" not in plan and plan.count("MapInArrow") == 3
    assert found.where("rank = 1 AND vec_id = query_id AND distance = 0").count() == 300


def test_null_ids_and_lengths_in_one_slice(spark):
    rows = [(None, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0, 0.0]), (2, [0.0, 1.0, 0.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = dense_knn(v, v.withColumnRenamed("vec_id", "query_id"), k=3).collect()
    assert sorted((str(r.query_id), r.rank, str(r.vec_id), r.distance) for r in got) == sorted(
        [("None", 1, "None", 0.0), ("None", 2, "1", 0.0), ("1", 1, "None", 0.0), ("1", 2, "1", 0.0), ("2", 1, "2", 0.0), ("2", 2, "2", 0.0), ("2", 3, "2", 0.0)])


def test_many_blocks_in_a_task_equal_brute_force(spark, monkeypatch):
    from tidegate.operators import dense
    monkeypatch.setattr(dense, "_BLOCK_VECTORS", 5)
    monkeypatch.setattr(dense, "_MERGE", 3)
    rng = np.random.default_rng(9)
    vectors = [(i, [float(x) for x in rng.integers(-2, 3, size=3)]) for i in range(200)]
    v = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(2)
    rows = dense_knn(v, v.withColumnRenamed("vec_id", "query_id"), k=3, slice_bytes=2000)
    got = {}
    for r in rows.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {q: [x[1] for x in w] for q, w in brute_force(vectors, vectors, 3).items()}
