"""What the operators of this package share: reading, joins of checked size, components, hashing."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.storage import materialise

#: A side of a join is sent to every executor only if its measured bytes stay below this.
BROADCAST_BYTES = 48 * 1024 * 1024


def remembered(owner: str) -> dict:
    """A dictionary that lasts in its Python process until another owner asks for one.

    Functions reach workers by value, without module state. Workers outlive stages, so what
    one operator remembers must not stay while another one works.
    """
    module = sys.modules.setdefault("_tidegate_remembered", types.ModuleType("_tidegate_remembered"))
    if getattr(module, "owner", None) != owner:
        module.owner, module.kept = owner, {}
        release()
    return module.kept


def release() -> None:
    """Give freed memory back to the system, which allocators otherwise keep for as long as the worker lives."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # glibc has it
    if trim:
        trim(0)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def is_held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept out of every fit: crc32 of the id as text, modulo 4, is 2. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def join_checked(left: DataFrame, side: DataFrame, on: str | list[str], how: str) -> DataFrame:
    """Join with a written table: broadcast if its measured size allows it, shuffled otherwise."""
    sizes = [F.octet_length(c) if t in ("string", "binary") else F.lit(8)
             for c, t in side.dtypes]
    total = side.agg(F.sum(sum((s + 16 for s in sizes), F.lit(0)))).first()[0] or 0
    return left.join(F.broadcast(side) if total <= BROADCAST_BYTES else side, on, how)


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of ``edges(a, b)`` (longs): one row ``(node, root)`` per node.

    ``root`` is the smallest node of the component. Alternates "everyone in a neighbourhood
    points to its smallest member" over larger and smaller neighbours until nothing moves;
    each step is grouped minima and equi-joins, so a node with many neighbours is partly
    aggregated before the shuffle and its join side may be split.
    """
    def signature(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum((F.xxhash64("a", "b") % 1_000_003).cast("long")),
                            F.max(F.xxhash64("b", "a"))).first())

    def smallest(df: DataFrame) -> DataFrame:
        return df.groupBy("a").agg(F.min("b").alias("m"))

    current = materialise(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    seen = signature(current)
    while seen[0]:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = smallest(both).select("a", F.least("a", "m").alias("m"))
        large = (both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .distinct())
        least = smallest(large)
        small = (large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        current = materialise(small, name)
        now = signature(current)
        if now == seen:
            break
        seen = now
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def block_pairs(rows: DataFrame, group: list[str], weight: Column, block_weight: int) -> DataFrame:
    """``rows`` (with a column ``node``) dealt to pairs of blocks of their group.

    A group has one block for each ``block_weight`` of its summed weight, and every two
    blocks meet in one group of the result: columns ``lo``, ``hi`` and the own block
    ``blk``. Groups of one row are left out. No task gets more than about two blocks.
    """
    sizes = rows.groupBy(*group).agg(F.count("*").alias("n"), F.sum(weight).alias("weight")).where("n > 1")
    blocks = F.ceil(F.col("weight") / block_weight).cast("int")
    return (rows.join(sizes, group)
            .withColumn("blk", F.pmod(F.xxhash64("node"), blocks).cast("int"))
            .withColumn("mate", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .withColumns({"lo": F.least("blk", "mate"), "hi": F.greatest("blk", "mate")}).drop("mate", "n", "weight"))


def pieces(batches: Iterator[pa.RecordBatch], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that one piece holds about ``size`` bytes (a longer row stays whole)."""
    for batch in batches:
        if batch.num_rows:
            rows = max(1, int(batch.num_rows * size / max(1, batch.nbytes)))
            for start in range(0, batch.num_rows, rows):
                yield batch.slice(start, rows)
    release()


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of every text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


_BASE = 0x9E3779B97F4A7C15


def _power(kind: str, n: int) -> np.ndarray:
    kind = f"powers {kind}"
    base = _BASE if kind.endswith("up") else pow(_BASE, -1, 1 << 64)
    known = remembered("hash")
    table = known.get(kind)
    if table is None or len(table) < n:
        size = (int(n) // (1 << 18) + 1) << 18
        table = known[kind] = np.concatenate(
            [np.ones(1, np.uint64), np.cumprod(np.full(size, base, np.uint64), dtype=np.uint64)])
    return table[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial hash; ``span_hash`` takes any span's hash from them."""
    terms = (data.astype(np.uint64) + np.uint64(1)) * _power("up", len(data))
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[start:end]``, equal for equal bytes and lengths."""
    down = _power("down", len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))
