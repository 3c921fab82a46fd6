"""Exact cosine nearest neighbours on given vectors.

Every query has to meet every vector. Both are packed into blocks of bounded size, one row
each: queries by slices, vectors by tasks. Every block of queries meets every block of vectors
in a Cartesian product, which keeps at most one partition of blocks in a task; a task
returns its best k per query, never the pairs, and nothing passes the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidegate.operators.retrieval import TOP_K, best_per_query

_BLOCK_ROWS = 1024           # queries multiplied at once
_SLICE_BYTES = 32 * 1024 * 1024
_ID_BYTES = 64
_PLACES = 9
_BLOCK_VECTORS, _BLOCK_BYTES = 4096, 4 * 1024 * 1024    # a block of vectors
_PARTITION_BYTES = 32 * 1024 * 1024                     # blocks of one partition of the product
_MERGE = 8                                              # results of blocks that a task holds for a slice


def _unit(rows) -> np.ndarray:
    """Rows scaled to length one; a zero row stays zero, so its distance is 1."""
    m = np.asarray(rows, dtype=np.float64)
    length = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, length, out=np.zeros_like(m), where=length > 0)


def is_vector(embedding: str = "embedding") -> Column:
    """Not null or empty, and every component given and finite."""
    finite = lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))
    return F.coalesce((F.size(embedding) > 0) & F.forall(embedding, finite), F.lit(False))


def _blocks(rows: DataFrame, name: str, most_rows: int, most_bytes: int) -> DataFrame:
    """Vectors of unit length packed by consecutive rows of one ``part`` and length: ``ids, width, matrix``."""
    kind = rows.schema[name].dataType
    schema = T.StructType([T.StructField(f"{name}s", T.ArrayType(kind)), T.StructField(f"{name}_width", T.IntegerType()),
                           T.StructField(f"{name}_matrix", T.BinaryType())])
    target = to_arrow_schema(schema)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = pc.list_value_length(batch.column("embedding")).to_numpy()
            parts = batch.column("part").to_numpy()
            for part, width in sorted(set(zip(parts.tolist(), widths.tolist()))):
                own = np.flatnonzero((parts == part) & (widths == width))
                step = max(1, min(most_rows, most_bytes // (8 * width)))
                for at in range(0, len(own), step):
                    rows = batch.take(pa.array(own[at:at + step]))
                    unit = _unit(rows.column("embedding").flatten().to_numpy().reshape(-1, width))
                    ids = rows.column(name)
                    yield pa.RecordBatch.from_arrays(
                        [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([width], pa.int32()),
                         pa.array([unit.tobytes()], pa.binary())], schema=target)

    return rows.select("part", name, "embedding").mapInArrow(pack, schema)


def _nearest(queries: np.ndarray, vec_ids: pa.Array, vectors: np.ndarray, k: int, block_rows: int) -> tuple[pa.Array, np.ndarray]:
    """Ids and distances (a row for each query) of the best ``k`` of one block of vectors,
    which is ordered by id; ties fall to the lowest id."""
    n, places, near = len(vec_ids), [], []
    for i in range(0, len(queries), block_rows):
        distance = np.round(1.0 - queries[i:i + block_rows] @ vectors.T, _PLACES) + 0.0
        places.append(_lowest(distance, np.arange(n), k))
        near.append(np.take_along_axis(distance, places[-1], axis=1))
    return vec_ids.take(pa.array(np.concatenate(places).ravel())), np.concatenate(near)


def _lowest(distance: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Columns of the ``k`` lowest distances of each row, ties by ``order``, whose numbers are unique in a row."""
    if distance.shape[1] <= k:
        return np.tile(np.arange(distance.shape[1]), (len(distance), 1))
    # distance and order in one integer: unique, so the cut at k is exact
    rank = np.rint(distance * 10**_PLACES).astype(np.int64) * (int(order.max()) + 1) + order
    return np.argpartition(rank, k - 1, axis=1)[:, :k]


def _merged(found: list[tuple[pa.Array, np.ndarray]], k: int) -> tuple[pa.Array, np.ndarray]:
    """The best ``k`` of the results of several blocks for the same queries."""
    if len(found) == 1:
        return found[0]
    distance = np.concatenate([d for _, d in found], axis=1)
    # the place of every candidate among all ids
    ids = pa.concat_arrays([i for i, _ in found])
    order = np.empty(len(ids), np.int64)
    order[pc.array_sort_indices(ids, null_placement="at_start").to_numpy()] = np.arange(len(ids))
    starts = np.cumsum([0, *(d.size for _, d in found)])
    at = np.concatenate([s + np.arange(d.size).reshape(d.shape) for s, (_, d) in zip(starts, found)], axis=1)
    best = _lowest(distance, order[at], k)
    return ids.take(pa.array(np.take_along_axis(at, best, axis=1).ravel())), np.take_along_axis(distance, best, axis=1)


def _rows(query_ids: pa.Array, vec_ids: pa.Array, distance: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
    each = np.repeat(np.arange(len(query_ids)), distance.shape[1])
    return pa.RecordBatch.from_arrays([query_ids.take(pa.array(each)), vec_ids, pa.array(distance.ravel())], schema=schema)


def dense_knn(
    vectors: DataFrame, queries: DataFrame, k: int = TOP_K, block_rows: int = _BLOCK_ROWS,
    slice_bytes: int = _SLICE_BYTES,
) -> DataFrame:
    """``query_id, rank, vec_id, distance``; ties are ordered by ``vec_id``.

    ``vectors`` has ``vec_id, embedding`` and ``queries`` ``query_id, embedding``. Rows whose
    embedding is null, empty, or holds a null, NaN or infinite component take no part on
    either side; vectors meet only queries of their own length. Both sides are counted
    first; queries are cut into as many slices as ``slice_bytes`` asks for.
    """
    cores = queries.sparkSession.sparkContext.defaultParallelism
    asked = queries.filter(is_vector()).select("query_id", "embedding")
    own = vectors.filter(is_vector()).select("vec_id", "embedding")
    asked_bytes, own_bytes = _bytes(asked), _bytes(own)
    slices = max(1, math.ceil(asked_bytes / slice_bytes))
    slice_of = F.pmod(F.xxhash64("query_id"), F.lit(slices)).cast("int").alias("part")
    # packed rows are dealt out once more, so that the product reads them and packs nothing again
    sliced = (_blocks(asked.select(slice_of, "*").repartition(min(slices, cores), "part").sortWithinPartitions("part"), "query_id", 1 << 30, slice_bytes)
              .repartition(max(1, math.ceil(asked_bytes / _PARTITION_BYTES))).withColumn("slice", F.monotonically_increasing_id()))
    blocks = (_blocks(own.select(F.lit(0).alias("part"), "*"), "vec_id", _BLOCK_VECTORS, _BLOCK_BYTES)
              .repartition(max(cores, math.ceil(own_bytes / _PARTITION_BYTES))))
    # no equality that Spark could shuffle by: all vectors may be of one length
    pairs = sliced.join(blocks.hint("shuffle_replicate_nl"), (F.col("query_id_width") - F.col("vec_id_width")) == 0)
    schema = T.StructType([asked.schema["query_id"], own.schema["vec_id"], T.StructField("distance", T.DoubleType())])
    target = to_arrow_schema(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, found = None, []      # a slice meets the blocks of its task one after another
        for batch in batches:
            for at in range(batch.num_rows):
                width, own = batch.column("query_id_width")[at].as_py(), batch.column("slice")[at].as_py()
                side = lambda name: (batch.column(f"{name}s")[at].values, np.frombuffer(
                    batch.column(f"{name}_matrix")[at].as_buffer(), np.float64).reshape(-1, width))
                (query_ids, query), (vec_ids, vector) = side("query_id"), side("vec_id")
                if own != last and found:
                    yield _rows(asking, *_merged(found, k), target)
                    found = []
                last, asking = own, query_ids
                order = pc.array_sort_indices(vec_ids, null_placement="at_start")
                found.append(_nearest(query, vec_ids.take(order), vector[order.to_numpy()], k, block_rows))
                if len(found) == _MERGE:
                    found = [_merged(found, k)]
        if found:
            yield _rows(asking, *_merged(found, k), target)

    return (best_per_query(pairs.mapInArrow(scan, schema), k, F.col("distance"), "vec_id")
            .select("query_id", "rank", "vec_id", "distance"))


def _bytes(rows: DataFrame) -> int:
    return rows.agg(F.coalesce(F.sum(F.size("embedding").cast("long") * 8 + _ID_BYTES), F.lit(0))).first()[0]
