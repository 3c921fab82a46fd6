"""Exact top-k, n-gram Jaccard join and embedding near-dedup against brute force."""

import random

import brute
import numpy as np
import pytest
from prose import prose, words

from tidegate.llm import embedding_dedup, jaccard, topk
from tidegate.llm.common import components
from tidegate.llm.embedding_dedup import near_duplicates
from tidegate.llm.jaccard import similar_documents
from tidegate.llm.topk import top_k

VECTORS = "vec_id long, embedding array<float>, label int, score string"


@pytest.mark.parametrize("shape", ["path", "star", "random", "empty"])
def test_components(spark, shape):
    r = random.Random(1)
    edges = {"path": [(i, i + 1) for i in range(60)], "star": [(0, i) for i in range(1, 90)] + [(90, i) for i in range(91, 99)],
             "random": [(r.randrange(80), r.randrange(80)) for _ in range(50)], "empty": []}[shape]
    groups = brute.Groups()
    for a, b in edges:
        groups.join(a, b)
    got = {x.node: x.root for x in components(spark.createDataFrame([(-a, -b) for a, b in edges], "a long, b long"), "t").collect()}
    lowest = {}
    for x in {x for e in edges for x in e}:
        lowest.setdefault(groups.root(x), []).append(-x)
    assert all(got[x] == min(g) for g in lowest.values() for x in g if len(g) > 1)


def near_copies(seed):
    """Groups of near copies of all degrees, shared passages, exact copies, short texts."""
    r, rows = random.Random(seed), []
    passage = words(r, 30)
    for group in range(12):
        base = words(r, r.choice([4, 9, 12, 40, 90, 200]))
        for _ in range(r.randint(1, 7)):
            copy = list(base)
            for _ in range(r.randint(0, max(1, len(base) // 12))):
                copy[r.randrange(len(copy))] = r.choice(words(r, 1))
            if r.random() < 0.3:
                copy[len(copy) // 2:len(copy) // 2] = passage
            rows.append(r.choice([" ", "\n", " \t"]).join(copy))
    rows += rows[:5] + [r.upper() for r in rows[:3]]
    ids = r.sample(range(1000), len(rows))
    return list(zip(ids, rows, strict=True))


@pytest.mark.parametrize(("width", "percent", "frequent"), [(3, 90, False), (5, 80, False), (3, 90, True), (2, 60, True)])
def test_jaccard_equals_brute_force(make_docs, monkeypatch, width, percent, frequent):
    if frequent:  # nearly all shared tokens go to the frequent class and are indexed by combinations
        monkeypatch.setattr(jaccard, "LOCAL_COUNT", 2)
        monkeypatch.setattr(jaccard, "FREQUENT_COUNT", 2)
    rows = near_copies(width + percent)
    got = similar_documents(make_docs(rows).repartition(3), width, percent, slices=5).collect()
    assert sorted(((x.doc_id, x.n_shingles, x.component_id) for x in got), key=repr) == brute.jaccard(rows, width, percent)


def test_jaccard_with_many_batches_and_blocks(make_docs, monkeypatch):
    monkeypatch.setattr(jaccard, "BATCH_TOKENS", 300)
    monkeypatch.setattr(jaccard, "_LIMIT", 1500)
    monkeypatch.setattr(jaccard, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(jaccard, "_TILE", 3)
    monkeypatch.setattr(jaccard, "_COLUMNS", 64)
    rows = near_copies(11)
    got = similar_documents(make_docs(rows).repartition(2), 3, 80, slices=3).collect()
    assert sorted(((x.doc_id, x.n_shingles, x.component_id) for x in got), key=repr) == brute.jaccard(rows, 3, 80)


def test_jaccard_large_group(make_docs):
    r = random.Random(5)
    base = words(r, 120)
    rows = []
    for i in range(700):  # a third of the rows are near copies of one text
        copy = list(base)
        copy[r.randrange(120)] = f"w{i}"
        rows.append((i, " ".join(copy) if i % 3 == 0 else prose(i + 99, 30)))
    got = {x.doc_id: x.component_id for x in similar_documents(make_docs(rows), 3, 90).collect()}
    assert {got[i] for i in range(0, 700, 3)} == {0} and all(got[i] == i for i in range(700) if i % 3)


def test_jaccard_odd_and_empty(odd_docs):
    got = sorted(((x.doc_id, x.n_shingles, x.component_id) for x in similar_documents(odd_docs, 3, 90).collect()), key=repr)
    assert got == brute.jaccard([(x.doc_id, x.text) for x in odd_docs.collect()], 3, 90)
    assert similar_documents(odd_docs.limit(0)).count() == 0


def vectors(seed, n, d=8):
    r = np.random.default_rng(seed)
    base = r.standard_normal((n // 3, d))
    rows = [base[i % len(base)] + (0.03 * r.standard_normal(d) if i >= len(base) else 0) for i in range(n)]
    rows = [(int(i), [float(np.float32(x)) for x in v], int(i % 2), "x") for i, v in zip(r.permutation(n), rows, strict=True)]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * d, [nan] + [1.0] * (d - 1), [inf] + [1.0] * (d - 1), [None] + [1.0] * (d - 1), [1.0, 2.0], [1.0, 2.0]]
    return rows + [(n + i, v, 0, "x") for i, v in enumerate(odd)] + [(n + 50, rows[0][1], None, "x"), (None, rows[1][1], rows[1][2], "x"), rows[2], rows[2]]


def cosine_rows(df):
    return sorted(((x.vec_id, x.n_links, x.component_id) for x in df.collect()), key=repr)


@pytest.mark.parametrize("blocks", [False, True])
def test_embedding_links(spark, monkeypatch, blocks):
    rows = vectors(3, 240)
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    got = near_duplicates(df, **({"leaf_rows": 16, "block_rows": 7, "spill": 0.05} if blocks else {}))
    want = brute.cosine([(i, v, label) for i, v, label, _ in rows], 0.98)
    assert all(x.kept == (None if x.vec_id is None else x.vec_id == x.component_id) for x in got.collect())
    assert cosine_rows(got) == want


def test_forest_recall(spark):
    r = np.random.default_rng(4)
    base = r.standard_normal((1500, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    near = base + r.standard_normal(base.shape) * 0.16 / 8  # cosines around 0.987
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(np.concatenate([base, near]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    m = np.array([v for _, v, _ in rows], np.float32).astype(float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    links = (m @ m.T >= 0.98).sum(1) - 1
    got = {x.vec_id: x.n_links for x in near_duplicates(df, leaf_rows=64).collect()}
    assert all(got[i] <= n for i, n in enumerate(links.tolist()))
    assert sum(got.values()) >= 0.97 * links.sum() > 1000


def test_one_vector_in_a_third_of_all_rows(spark):
    rows = [(i, [1.0, 0.0] if i % 3 == 0 else [float(i), 1.0 + i * i], 1) for i in range(300)]
    got = {x.vec_id: x for x in near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    want = {a: (n, c) for a, n, c in brute.cosine(rows, 0.98)}
    assert {i: (x.n_links, x.component_id) for i, x in got.items()} == want and got[0].kept and got[3].n_links >= 99


def test_embedding_dedup_of_nothing(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert near_duplicates(empty).count() == 0
    lone = spark.createDataFrame([(1, None, 1, "x"), (2, [1.0], None, "x")], VECTORS)
    assert cosine_rows(near_duplicates(lone)) == [(1, 0, 1), (2, 0, 2)]


def test_spanning_forest_of_blocks():
    r = np.random.default_rng(1)
    a = embedding_dedup.unit(r.standard_normal((40, 3)))
    one, two = embedding_dedup.forest_links(a, None, 0.9)
    assert len(one) < 40 and all(a[x] @ a[y] >= 0.9 for x, y in zip(one, two, strict=True))


def brute_top(rows, queries, k):
    fine = [(i, np.floor(np.array(v, float) * 1024).astype(int)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in sorted({i: v for i, v in fine if i in queries}.items()):
        scored = sorted((-int(v @ c), i) for i, c in fine if i != q and len(c) == len(v))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return out


@pytest.mark.parametrize("slice_bytes", [1 << 20, 400])
def test_top_k_equals_brute_force(spark, slice_bytes):
    r = np.random.default_rng(2)
    rows = [(int(i), [float(np.float32(x)) for x in v]) for i, v in enumerate(np.round(r.standard_normal((300, 6)), 1))]
    rows += [(300 + i, rows[i % 5][1]) for i in range(40)]  # ties
    rows += [(500, None), (510, []), (520, [float("nan")] * 6), (530, [None] + [1.0] * 5), (540, [float("inf")] * 6), (550, [1.0, 2.0]), (560, [3.0, 4.0]), (None, [1.0] * 6)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], VECTORS).repartition(3)
    got = [tuple(x) for x in top_k(df, df.where("vec_id % 10 = 0"), 7, slice_bytes=slice_bytes).orderBy("query_id", "rank").collect()]
    assert got == brute_top(rows, {i for i, _ in rows if i is not None and i % 10 == 0}, 7)


def test_top_k_scores_large_components(spark):
    r = np.random.default_rng(5)
    rows = [(i, [float(x) for x in np.round(r.standard_normal(6), 1)]) for i in range(120)]
    rows += [(200, [1e6, 1.0, -2.0, 0.5, 0.0, 3.0]), (210, [-7e4] * 6), (220, [1e6, 1e6, 0.0, 0.0, 0.0, 1.0]), (230, [65_536.0] + [0.0] * 5)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], VECTORS).repartition(3)
    got = [tuple(x) for x in top_k(df, df.where("vec_id % 10 = 0"), 7).orderBy("query_id", "rank").collect()]
    assert got == brute_top(rows, {i for i, _ in rows if i % 10 == 0}, 7)
    assert topk.products(np.array([[2.0 ** 80, 3.0]]), np.array([[0.0, 5.0]])).tolist() == [[15]]
    with pytest.raises(OverflowError):
        topk.products(np.array([[2.0 ** 40]]), np.array([[2.0 ** 23]]))


def test_top_k_stops_early():
    r = np.random.default_rng(3)
    rows = np.floor(np.concatenate([r.standard_normal((50, 8)) * 2000, r.standard_normal((4000, 8)) * 3]))
    pivots = topk.choose_pivots(rows, 6)
    scored = []
    best = topk.Best(1, 3)
    original = topk.products
    topk.products = lambda a, b: scored.append(len(a)) or original(a, b)
    try:
        q = rows[:1]
        topk._search(np.arange(len(rows)), rows, (np.array([-1]), q, topk.pivot_table(q, pivots), pivots), best, np.array([-(1 << 62)]))
    finally:
        topk.products = original
    assert sum(scored) < 1000 and best.rows[0][1].tolist() == np.lexsort((np.arange(len(rows)), -(rows @ q[0])))[:3].tolist()


def test_top_k_of_nothing(spark):
    empty = spark.createDataFrame([], VECTORS)
    one = spark.createDataFrame([(1, [1.0], 1, "x"), (1, [1.0], 1, "x")], VECTORS)
    assert top_k(empty, empty).count() == 0 and top_k(one, one).count() == 0 and top_k(one, empty).count() == 0


def test_fewer_words_than_a_shingle():
    for width in (1, 3, 5):
        sets = jaccard.shingle_sets([b"one", b"", b"ONE", b"one two"], width)
        assert [len(s) for s in sets] == [1, 0, 1, 2 if width == 1 else 1]
        assert sets[0].tolist() == sets[2].tolist()
    assert jaccard.shingle_sets([], 3) == [] and len(jaccard.shingle_sets([b"  "], 5)[0]) == 0
