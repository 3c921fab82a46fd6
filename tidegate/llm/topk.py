"""Exact top-k inner products by pivot-table elimination.

Vectors are whole numbers, floor(scale x). Every candidate's distances to a few pivots are
put beside those of a query: the largest difference is a lower bound of their distance,
hence (|q|^2 + |c|^2 - bound^2) / 2 an upper bound of their inner product. Candidates of a
batch are scored in the order of their bounds until the next bound falls below the k-th
best score so far, which every task keeps from batch to batch and which starts from the
scores of the sample that the pivots come from. Candidates stay where they are; queries
are sent to them in slices of bounded size. Pairs with a component too large for exact
bounds are all scored, in whole numbers of any size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.storage import materialise

from .common import BROADCAST_BYTES

SCALE = 1024
K = 10
#: The pivots are chosen from that many rows of each vector length.
SAMPLE_ROWS = 1024
PIVOTS = 12
#: Bounds are taken only of vectors whose squared distances are whole numbers below that.
LARGEST = 1 << 53
MAX_LENGTHS = 64
_CHUNK = 256
_TILE = 1 << 21  # query-candidate bounds held at once
_LOWEST = np.iinfo(np.int64).min


def usable(embedding: str = "embedding") -> Column:
    """Not null or empty, every component given and finite."""
    return F.coalesce((F.size(embedding) > 0) & F.forall(embedding, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False))), F.lit(False))


def is_small(rows: np.ndarray) -> np.ndarray:
    """Of each row of whole numbers, whether exact bounds can be taken of it."""
    return 4 * rows.shape[1] * np.abs(rows).max(1, initial=0) ** 2 < LARGEST


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column whose lists have one length, as doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers; in doubles or longs where these are exact.

    Raises ``OverflowError`` if a product itself leaves 64 bits.
    """
    tops = np.abs(a).max(1, initial=0) * float(np.abs(b).max(initial=0)) * a.shape[-1]
    top = tops.max(initial=0)
    if top < 2 ** 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if top < 2 ** 62 and np.abs(a).max(initial=0) < 2 ** 62 and np.abs(b).max(initial=0) < 2 ** 62:
        return a.astype(np.int64) @ b.T.astype(np.int64)
    out = np.empty((len(a), len(b)), np.int64)
    right = [[int(x) for x in row] for row in b.tolist()]
    for i, row in enumerate(a.tolist()):
        left = [int(x) for x in row]
        for j, other in enumerate(right):
            score = sum(x * y for x, y in zip(left, other, strict=True))
            if not -2 ** 63 <= score < 2 ** 63:
                raise OverflowError(f"an inner product of {score} leaves 64 bits")
            out[i, j] = score
    return out


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first rows of the sample."""
    chosen, far = [0], np.full(len(sample), np.inf)
    while len(chosen) < min(count, len(sample)):
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(1))
        chosen.append(int(far.argmax()))
    return sample[chosen]


def pivot_table(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (rows ** 2).sum(1)[:, None] + (pivots ** 2).sum(1)[None] - 2 * rows @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


class Best:
    """The ``k`` best (score, id) of each query, ties to the smaller id."""

    def __init__(self, queries: int, k: int):
        self.k, self.rows = k, [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * queries

    def floor(self, query: int) -> int:
        scores, _ = self.rows[query]
        return int(scores[-1]) if len(scores) == self.k else _LOWEST

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.rows[query][0], scores]), np.concatenate([self.rows[query][1], ids])
        order = np.lexsort((ids, -scores))[:self.k]
        self.rows[query] = scores[order], ids[order]


def _search(ids: np.ndarray, rows: np.ndarray, queries: tuple, best: Best, floors: np.ndarray) -> None:
    """Take one batch of candidates into account."""
    query_ids, q_rows, q_table, pivots = queries
    table, norms, q_norms = pivot_table(rows, pivots), (rows ** 2).sum(1), (q_rows ** 2).sum(1)
    tile = max(1, _TILE // max(1, len(rows)))
    for start in range(0, len(query_ids), tile):
        part = slice(start, start + tile)
        low = np.zeros((len(query_ids[part]), len(rows)))
        for p in range(table.shape[1]):
            np.maximum(low, np.abs(q_table[part, p, None] - table[None, :, p]), out=low)
        both = q_norms[part, None] + norms[None]
        high = (both - low ** 2) / 2 + both * 1e-9 + 1  # the slack covers rounding
        for i in range(len(low)):
            query = start + i
            reach = np.flatnonzero(high[i] >= max(best.floor(query), floors[query]))
            reach = reach[ids[reach] != query_ids[query]]
            reach = reach[np.argsort(-high[i][reach])]
            for at in range(0, len(reach), _CHUNK):
                chunk = reach[at:at + _CHUNK]
                floor = max(best.floor(query), floors[query])
                if high[i][chunk[0]] < floor:
                    break
                scores = products(rows[chunk], q_rows[query][None])[:, 0]
                good = scores >= floor
                if good.any():
                    best.add(query, scores[good], ids[chunk[good]])


def _score_all(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, q_rows: np.ndarray, best: Best, first: int) -> None:
    """Score every pair of a batch with the queries that ``best`` has from ``first`` on."""
    for at in range(0, len(rows), _CHUNK):
        part = slice(at, at + _CHUNK)
        for i, query in enumerate(q_rows):
            scores = products(rows[part], query[None])[:, 0]
            good = (ids[part] != query_ids[i]) & (scores >= best.floor(first + i))
            if good.any():
                best.add(first + i, scores[good], ids[part][good])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, scale: int = SCALE, slice_bytes: int = BROADCAST_BYTES // 2) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products of each query.

    Both tables have ``vec_id, embedding``. Ties go to the smaller ``vec_id``; rows with the
    query's own id are no candidates. Rows that are not ``usable`` or have no id take no
    part; vectors meet only vectors of their own length. Query rows that repeat an id count
    once (the smallest vector), candidate rows that repeat one count each. No query or no
    candidate gives no row. A score beyond 64 bits is an error.
    """
    def clean(df: DataFrame) -> DataFrame:
        return df.where(usable() & F.col("vec_id").isNotNull()).select(
            F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))

    candidates = clean(vectors)
    asked = materialise(clean(queries).groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "topk-queries")
    found: DataFrame | None = None
    lengths = sorted(r[0] for r in asked.groupBy(F.size("embedding").alias("n")).count().select("n").limit(MAX_LENGTHS + 1).collect())
    if len(lengths) > MAX_LENGTHS:
        raise ValueError(f"more than {MAX_LENGTHS} vector lengths")
    for length in lengths:
        own, mine = (df.where(F.size("embedding") == length) for df in (candidates, asked))
        largest = math.sqrt(LARGEST / (4 * length)) / scale
        bounded = own.where(F.forall("embedding", lambda x: F.abs(x) < largest - 1))
        sample = bounded.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).collect()
        sample_ids = np.array([r.vec_id for r in sample], np.int64)
        sample_rows = np.floor(np.array([r.embedding for r in sample]).reshape(len(sample), length) * scale)
        pivots = choose_pivots(sample_rows, PIVOTS) if len(sample) else np.zeros((1, length))
        slices = max(1, math.ceil(mine.count() * 8 * (length + PIVOTS) / slice_bytes))
        for number in range(slices):
            rows = mine.where(F.pmod(F.xxhash64("vec_id"), F.lit(slices)) == number).collect()
            if not rows:
                continue
            query_ids = np.array([r.vec_id for r in rows], np.int64)
            q_rows = np.floor(np.array([r.embedding for r in rows]) * scale)
            small_first = np.argsort(~is_small(q_rows), kind="stable")
            query_ids, q_rows = query_ids[small_first], q_rows[small_first]
            small = int(is_small(q_rows).sum())
            seeds = Best(small, k)
            for i in range(small):
                other = sample_ids != query_ids[i]
                seeds.add(i, products(sample_rows[other], q_rows[i][None])[:, 0], sample_ids[other])
            floors = np.array([seeds.floor(i) for i in range(small)], np.int64)
            shared = vectors.sparkSession.sparkContext.broadcast(
                (query_ids, q_rows, small, pivot_table(q_rows[:small], pivots), pivots, floors))

            def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
                query_ids, q_rows, small, q_table, pivots, floors = shared.value
                best = Best(len(query_ids), k)
                for batch in batches:
                    for at in range(0, batch.num_rows, 4096):
                        piece = batch.slice(at, 4096)
                        ids, rows = piece.column("vec_id").to_numpy(), np.floor(matrix(piece.column("embedding")) * scale)
                        fine = is_small(rows)
                        _search(ids[fine], rows[fine], (query_ids[:small], q_rows[:small], q_table, pivots), best, floors)
                        _score_all(ids[~fine], rows[~fine], query_ids[:small], q_rows[:small], best, 0)
                        _score_all(ids, rows, query_ids[small:], q_rows[small:], best, small)
                yield pa.RecordBatch.from_pydict({
                    "query_id": np.repeat(query_ids, [len(s) for s, _ in best.rows]),
                    "vec_id": np.concatenate([i for _, i in best.rows]), "score": np.concatenate([s for s, _ in best.rows])})

            part = own.mapInArrow(scan, "query_id long, vec_id long, score long")
            found = part if found is None else found.unionByName(part)
    if found is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
