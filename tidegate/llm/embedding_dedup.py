"""Near-duplicate vectors by a forest of random-projection trees.

Equal vectors of one label are one class. Each tree routes a class by random projections,
a new direction at every level; a projection within ``SPILL`` of the split goes to both
sides. Splits are medians of a bounded sample as long as a node has enough of it, then of
the whole sample. Only classes that meet in a leaf of the same label are compared, each
pair in double precision; a leaf that is too large for one task is compared block by
block, all blocks with all. Tasks return a spanning forest of the links they verify, never
the pairs. Unions make components; inside these, in blocks again, links are counted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.storage import materialise

from .common import block_pairs, components
from .topk import matrix

COSINE = 0.98
TREES = 4
LEAF_ROWS = 256
SPILL = 0.0125
#: The splits are fitted on that many classes.
SAMPLE_ROWS = 20_000
BLOCK_ROWS = 2048
_MIN_SPLIT = 64
_SEED = 20


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by their largest component first, so that no square overflows or vanishes."""
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows ** 2).sum(1, keepdims=True))


def fit_forest(sample: np.ndarray, trees: int, levels: int) -> list[tuple[np.ndarray, list[np.ndarray]]]:
    """Per tree the directions ``(levels, d)`` and for each level the split of every node (2^level)."""
    forest, random = [], np.random.default_rng(_SEED)
    for _ in range(trees):
        directions = random.standard_normal((levels, sample.shape[1]))
        directions /= np.linalg.norm(directions, axis=1, keepdims=True)
        projected, node, splits = sample @ directions.T, np.zeros(len(sample), np.int64), []
        for level in range(levels):
            values = projected[:, level]
            split = np.full(1 << level, np.median(values))
            order = np.argsort(node, kind="stable")
            for name, rows in zip(*_groups(node[order], order), strict=True):
                if len(rows) >= _MIN_SPLIT:
                    split[name] = np.median(values[rows])
            splits.append(split)
            node = 2 * node + (values > split[node])
        forest.append((directions, splits))
    return forest


def _groups(sorted_keys: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    names, starts = np.unique(sorted_keys, return_index=True)
    return names, np.split(order, starts[1:])


def leaves(rows: np.ndarray, tree: tuple[np.ndarray, list[np.ndarray]], spill: float) -> tuple[np.ndarray, np.ndarray]:
    """``(row, leaf)`` pairs; a row within ``spill`` of a split is in both halves."""
    directions, splits = tree
    projected = rows @ directions.T
    row, node = np.arange(len(rows)), np.zeros(len(rows), np.int64)
    for level, split in enumerate(splits):
        away = projected[row, level] - split[node]
        left, right = away <= spill, away > -spill
        row, node = np.concatenate([row[left], row[right]]), np.concatenate([2 * node[left], 2 * node[right] + 1])
    return row, node


def linked_blocks(a: np.ndarray, b: np.ndarray, cosine: float) -> Iterator[tuple[int, np.ndarray]]:
    """``(first row of a, truth table)`` tiles of which pairs of unit rows reach the cosine."""
    for start in range(0, len(a), 512):
        yield start, a[start:start + 512] @ b.T >= cosine


def forest_links(a: np.ndarray, b: np.ndarray | None, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links inside ``a``, or between ``a`` and ``b`` (numbered after ``a``)."""
    shift, other = (0, a) if b is None else (len(a), b)
    parent = np.arange(shift + len(other))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return int(x)

    one, two = [], []
    for start, table in linked_blocks(a, other, cosine):
        for i, line in enumerate(table):
            x = root(start + i)
            near = np.flatnonzero(line) + shift
            near = near[parent[near] != x]
            for y in near.tolist():
                x, z = root(start + i), root(y)
                if x != z:
                    parent[max(x, z)] = min(x, z)
                    one.append(start + i)
                    two.append(y)
    return np.array(one, np.int64), np.array(two, np.int64)


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, trees: int = TREES, spill: float = SPILL,
                    leaf_rows: int = LEAF_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``vec_id, n_links, component_id, kept``: one row per row of ``vectors(vec_id, embedding, label)``.

    ``n_links`` counts other rows of the component with a cosine of at least ``cosine``,
    ``component_id`` is the smallest ``vec_id`` reachable by links, ``kept`` is true where
    both are equal (null for a null id without links). Rows link only with equal labels and
    lengths; null labels, and vectors that are null, empty, zero or hold a null or
    non-finite component, link with nothing. Repeated rows are linked with each other.
    """
    rows = vectors.select("vec_id", F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    sound = (F.col("label").isNotNull() & (F.size("embedding") > 0)
             & F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
             & F.exists("embedding", lambda x: x != 0))
    # adding 0.0 turns a negative zero into zero, so equal vectors have equal hashes
    node = F.when(F.coalesce(sound, F.lit(False)), F.xxhash64("label", F.transform("embedding", lambda x: x + F.lit(0.0))))
    named = rows.withColumn("node", node)
    classes = materialise(named.where("node is not null").groupBy("node").agg(
        F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.count("*").alias("copies"),
        F.min("vec_id").alias("vec_id")), "vector-classes")
    by_label = classes.groupBy("label", F.size("embedding").alias("length")).agg(F.count("*").alias("n"))
    lengths = {r.length: r.most for r in by_label.groupBy("length").agg(F.max("n").alias("most")).limit(1024).collect()}
    edges = None
    for length, most in sorted(lengths.items()):
        own = classes.where(F.size("embedding") == length)
        levels = max(1, math.ceil(math.log2(max(1, most) / leaf_rows))) if most > leaf_rows else 0
        sample = unit(np.array([r.embedding for r in own.orderBy(F.xxhash64("node")).limit(SAMPLE_ROWS).select("embedding").collect()]))
        forest = fit_forest(sample, trees if levels else 1, levels)
        part = _leaf_links(own, forest, cosine, spill, block_rows)
        edges = part if edges is None else edges.unionByName(part)
    if edges is None:
        roots, counted = None, None
    else:
        roots = components(edges, "vector-links")
        counted = _count_links(classes, roots, cosine, block_rows)
    found = classes.select("node", "copies", "vec_id")
    if roots is None:
        found = found.select("node", F.lit(0).cast("long").alias("links"), "copies", F.col("vec_id").alias("component_id"))
    else:
        linked = roots.join(found, "node").groupBy("root").agg(F.min("vec_id").alias("component_id"))
        linked = roots.join(linked, "root").select("node", "component_id").join(counted, "node", "left")
        found = (found.join(linked, "node", "left")
                 .select("node", F.coalesce("links", F.lit(0)).alias("links"), "copies", F.coalesce("component_id", "vec_id").alias("component_id")))
    links = named.where("node is not null").select("vec_id", "node").join(found, "node", "left")
    alone = named.where("node is null").select("node", "vec_id", F.lit(0).cast("long").alias("links"),
                                               F.lit(1).cast("long").alias("copies"), F.col("vec_id").alias("component_id"))
    return links.unionByName(alone).select(
        "vec_id", F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        (F.col("vec_id") == F.coalesce("component_id", "vec_id")).alias("kept"))


def _leaf_links(classes: DataFrame, forest: list, cosine: float, spill: float, block_rows: int) -> DataFrame:
    shared = classes.sparkSession.sparkContext.broadcast(forest)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = unit(matrix(batch.column("embedding")))
                for number, tree in enumerate(shared.value):
                    row, leaf = leaves(rows, tree, spill)
                    yield pa.RecordBatch.from_pydict({
                        "node": batch.column("node").take(pa.array(row)), "label": batch.column("label").take(pa.array(row)),
                        "leaf": leaf * len(shared.value) + number,
                        "vector": pa.array([v.tobytes() for v in rows[row]], pa.binary())})

    def compare(batches: pa.Table) -> pa.Table:
        ids, blk = batches.column("node").to_numpy(), batches.column("blk").to_numpy()
        rows = np.frombuffer(b"".join(batches.column("vector").to_pylist())).reshape(len(ids), -1)
        first, second = batches.column("lo")[0].as_py(), batches.column("hi")[0].as_py()
        low = blk == first
        one, two = forest_links(rows[low], None if first == second else rows[~low], cosine)
        names = np.concatenate([ids[low], ids[~low]])
        return pa.table({"a": names[one], "b": names[two]})

    routed = classes.select("node", "label", "embedding").mapInArrow(route, "node long, label string, leaf long, vector binary")
    # what is alone in its leaf meets nothing; sizes are counted on the narrow columns only
    dealt = block_pairs(materialise(routed, "vector-leaves"), ["label", "leaf"], F.lit(1), block_rows)
    return dealt.groupBy("label", "leaf", "lo", "hi").applyInArrow(compare, "a long, b long")


def _count_links(classes: DataFrame, roots: DataFrame, cosine: float, block_rows: int) -> DataFrame:
    """``node, links``: rows (copies included) of other classes in the component that a class links with."""
    def count(batches: pa.Table) -> pa.Table:
        ids, blk = batches.column("node").to_numpy(), batches.column("blk").to_numpy()
        copies = batches.column("copies").to_numpy().astype(np.float64)
        rows = unit(matrix(batches.column("embedding").combine_chunks()))
        first, second = batches.column("lo")[0].as_py(), batches.column("hi")[0].as_py()
        low, same = blk == first, first == second
        a, b = rows[low], rows if same else rows[~low]
        weight_a, weight_b = copies[low], copies if same else copies[~low]
        total_a, total_b = np.zeros(len(a)), np.zeros(len(b))
        for start, table in linked_blocks(a, b, cosine):
            if same:
                table[np.arange(len(table)), start + np.arange(len(table))] = False
            total_a[start:start + len(table)] = table @ weight_b
            total_b += weight_a[start:start + len(table)] @ table
        out = total_a if same else np.concatenate([total_a, total_b])
        names = ids[low] if same else np.concatenate([ids[low], ids[~low]])
        return pa.table({"node": names, "links": out.astype(np.int64)})

    members = roots.join(classes.select("node", "embedding", "copies"), "node")
    dealt = block_pairs(members, ["root"], F.lit(1), block_rows)
    return dealt.groupBy("root", "lo", "hi").applyInArrow(count, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))
