"""Exact top-k chunks over postings with block maxima and threshold pruning.

Chunks are dealt to blocks of about ``CHUNKS_PER_BLOCK`` by a hash of their key. A query's
score of any chunk in a block is at most the sum, over the query's terms, of the query weight
times the largest weight of the term in the block: the block's bound. Then:

1. bounds of every (query, block) that shares a term, from the block maxima only;
2. the ``FIRST_BLOCKS`` blocks of the highest bounds per query are scored exactly; their k-th
   best distance is a threshold that the k-th best of all chunks reaches too;
3. only (query, block) pairs whose bound reaches the threshold are scored, and the k best per
   query are ranked as :func:`retrieve` does.

Nothing is dropped that could rank: a block below the threshold holds no chunk that could tie
or beat the k-th best. The answers are those of :func:`retrieve`.

Maxima are as many as a third to all of the postings, so they are not stored: whole blocks are
dealt to parts of bounded size by the texts of their chunks, and a part takes the maxima of
the asked terms, or scores its asked pairs, where it has its chunks. No row of a term is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.text import words
from tidegate.operators.retrieval import (
    TOP_K, _CELLS, _PLACES, _SLICE_BYTES, _Best, _padding, _shared, _Slice, _slices, best_per_query, of_slice, query_vectors)
from tidegate.operators.tfidf import CHUNK_KEYS, Dealing, TextIndex
from tidegate.storage import Scratch, freed_shuffles, materialise

CHUNKS_PER_BLOCK = 64
#: Blocks of the highest bounds that each query scores first, for its threshold.
FIRST_BLOCKS = 16
#: Block numbers that are sent to the chunks at most, so that texts of other blocks are not shuffled.
_FEW_BLOCKS = 1 << 20
#: A bound this far below the threshold still counts: scores are rounded before they rank.
_SLACK = 2 * 10.0 ** -_PLACES


def block_of(blocks: int) -> Column:
    return F.pmod(F.xxhash64(*CHUNK_KEYS), F.lit(blocks)).cast("int")


@dataclass(frozen=True)
class BlockMaxima:
    """The chunks of an index with their ``block``, whose maxima follow from them, and the number of blocks."""

    index: TextIndex
    blocks: int

    def _part(self, parts: int) -> Column:
        return F.pmod("block", F.lit(parts)).cast("int")

    def _dealt(self, dealing: Dealing, number: int, some: DataFrame | None = None) -> DataFrame:
        """Whole blocks by part, those of one round; ``some`` names the blocks that are asked for if they are few."""
        rows = self.index.unread_rows.withColumn("block", block_of(self.blocks)).withColumn("part", self._part(dealing.parts))
        if some is not None:
            rows = rows.join(F.broadcast(some), "block", "left_semi")
        return (rows.where(F.pmod("part", F.lit(dealing.rounds)) == number)
                .repartition(max(1, dealing.parts // dealing.rounds), "part").sortWithinPartitions("part")
                .select("part", "block", *CHUNK_KEYS, words(F.col("chunk")).alias("words"), "stored", "norm"))

    def _rounds(self, one: Callable[[Dealing, int], DataFrame], scratch: Scratch, name: str) -> DataFrame:
        dealing = Dealing.of(self.index.n_chunks)
        return reduce(DataFrame.unionByName, [scratch.materialise(one(dealing, number), name) for number in range(dealing.rounds)])

    def bounds(self, shared: Broadcast, ids: T.DataType, scratch: Scratch) -> DataFrame:
        """``query_id, block, bound, n_postings`` of every pair that shares a term."""
        schema = T.StructType([T.StructField("query_id", ids), T.StructField("block", T.IntegerType()),
                               T.StructField("bound", T.DoubleType()), T.StructField("n_postings", T.LongType())])
        run = _bound_part(shared, self.index.n_chunks)
        return self._rounds(lambda dealing, number: self._dealt(dealing, number).groupBy("part").applyInArrow(run, schema), scratch, "bounds")

    def scores(self, pairs: DataFrame, shared: Broadcast, k: int, scratch: Scratch) -> DataFrame:
        """``query_id, chunk, distance``: of the chunks of the given (query, block) pairs the best ``k`` per query and part."""
        ids = pairs.schema["query_id"]
        schema = T.StructType([T.StructField("query_id", ids.dataType), *[self.index.table.schema[c] for c in CHUNK_KEYS],
                               T.StructField("distance", T.DoubleType())])

        blocks = pairs.select("block").distinct()
        some = blocks if blocks.count() <= min(self.blocks // 4, _FEW_BLOCKS) else None

        def one(dealing: Dealing, number: int) -> DataFrame:
            asked = pairs.select("query_id", "block").withColumn("part", self._part(dealing.parts))
            asked = asked.where(F.pmod("part", F.lit(dealing.rounds)) == number)
            return (self._dealt(dealing, number, some).groupBy("part").cogroup(asked.groupBy("part"))
                    .applyInArrow(_score_part(shared, self.index.n_chunks, k), schema))

        return self._rounds(one, scratch, "scores")


def _by_block(table: pa.Table) -> pa.RecordBatch:
    """The rows of a part by block, as one batch."""
    return table.take(pc.sort_indices(table["block"])).combine_chunks().to_batches()[0]


def _bound_part(shared: Broadcast, n_chunks: int):
    def run(table: pa.Table) -> pa.Table:
        if not shared.value.num_rows:
            return pa.table({"query_id": pa.nulls(0, shared.value.schema.field("query_id").type), "block": pa.array([], pa.int32()),
                             "bound": pa.array([], pa.float64()), "n_postings": pa.array([], pa.int64())})
        asked, rows = _Slice(shared.value, n_chunks), _by_block(table)
        names, block = np.unique(rows.column("block").to_numpy(), return_inverse=True)
        row, term, weight = asked.postings(rows)
        # the largest weight and the number of postings of each (block, term)
        cell = block[row] * len(asked.terms) + term
        order = np.argsort(cell, kind="stable")
        cell, weight = cell[order], weight[order]
        heads = np.flatnonzero(np.diff(cell, prepend=-1))
        most = np.maximum.reduceat(weight, heads) if len(heads) else weight
        counts = np.diff(heads, append=len(cell)).astype(np.float64)
        block, term = np.divmod(cell[heads], len(asked.terms))
        out, step = [], max(1, _CELLS // asked.n)
        for at in range(0, len(names), step):
            own, n = slice(*np.searchsorted(block, (at, at + step))), min(step, len(names) - at)
            bound = asked.by_term(block[own] - at, term[own], most[own], n)
            known = asked.counted(block[own] - at, term[own], counts[own], n)
            which, query = np.nonzero(known)
            out.append(pa.table({"query_id": asked.query_ids.take(pa.array(query)), "block": pa.array(names[at + which], pa.int32()),
                                 "bound": bound[which, query], "n_postings": known[which, query].astype(np.int64)}))
        return pa.concat_tables(out)
    return run


def _score_part(shared: Broadcast, n_chunks: int, k: int):
    def run(table: pa.Table, pairs: pa.Table) -> pa.Table:
        keys = table.select(list(CHUNK_KEYS)).schema
        empty = pa.table({"query_id": pa.nulls(0, shared.value.schema.field("query_id").type),
                          **{c: pa.nulls(0, keys.field(c).type) for c in CHUNK_KEYS}, "distance": pa.array([], pa.float64())})
        table = table.filter(pc.is_in(table["block"], value_set=pairs["block"].combine_chunks()))
        if not table.num_rows:
            return empty
        asked, rows = _Slice(shared.value, n_chunks), _by_block(table)
        best = _Best(asked, k, keys)
        names, block = np.unique(rows.column("block").to_numpy(), return_inverse=True)
        of_pair = np.searchsorted(names, pairs["block"].to_numpy())
        query = pc.index_in(pairs["query_id"], value_set=asked.query_ids).to_numpy()
        by_pair = np.argsort(of_pair, kind="stable")
        of_pair, query = of_pair[by_pair], query[by_pair]
        row, term, weight = asked.postings(rows)
        step = max(1, _CELLS // asked.n)
        for at in range(0, rows.num_rows, step):
            n = min(step, rows.num_rows - at)
            first, last = block[at], block[at + n - 1]
            own, some = slice(*np.searchsorted(row, (at, at + n))), slice(*np.searchsorted(of_pair, (first, last + 1)))
            wanted = np.zeros((last - first + 1, asked.n), bool)
            wanted[of_pair[some] - first, query[some]] = True
            wanted = wanted[block[at:at + n] - first]
            best.add(rows.select(list(CHUNK_KEYS)).slice(at, n), asked.by_term(row[own] - at, term[own], weight[own], n, asked=wanted))
        found = list(best.rows())
        return pa.Table.from_batches(found) if found else empty
    return run


def block_maxima(index: TextIndex, chunks_per_block: int = CHUNKS_PER_BLOCK) -> BlockMaxima:
    """The blocks of an index, for :func:`retrieve_blockmax`."""
    return BlockMaxima(index, max(1, math.ceil(index.n_chunks / chunks_per_block)))


def retrieve_blockmax(queries: DataFrame, index: TextIndex, maxima: BlockMaxima, k: int = TOP_K,
                      keep: Scratch | None = None, first_blocks: int = FIRST_BLOCKS) -> tuple[DataFrame, dict]:
    """``query_id, rank, doc_id, chunk_no, distance`` as :func:`retrieve`, and what was scored.

    The second value holds ``matches`` (query-posting pairs that share a term) and ``scored``
    (those scored exactly, in the first block and in the blocks kept); their ratio is the share
    of the full scan done. A query without known terms gets the first chunks at distance 1.
    """
    k = min(k, index.n_chunks)
    spark = queries.sparkSession
    order = (F.col("distance"), *CHUNK_KEYS)
    matches = scored = 0
    with freed_shuffles(spark), Scratch(spark) as scratch:
        vectors = scratch.materialise(query_vectors(queries, index, scratch), "vectors")
        slices, found = _slices(vectors, _SLICE_BYTES), []
        for number in range(slices):
            own = of_slice(vectors, number, slices)
            shared = _shared(own)
            bounds = maxima.bounds(shared, vectors.schema["query_id"].dataType, scratch)
            first = scratch.materialise(
                best_per_query(bounds, first_blocks, F.col("bound").desc(), "block").select("query_id", "block", "n_postings"), "first")
            first_scores = maxima.scores(first, shared, k, scratch)
            head = best_per_query(first_scores, k, *order)
            threshold = (head.groupBy("query_id").agg((1 - F.max("distance")).alias("threshold"), F.count("*").alias("n"))
                         .where(F.col("n") >= k).select("query_id", "threshold"))
            # a chunk lies in one block: the first blocks' scores stand, the others that may rank are added
            kept = scratch.materialise(
                bounds.join(first.select(F.col("query_id").alias("_query"), F.col("block").alias("_block")),
                            F.col("query_id").eqNullSafe(F.col("_query")) & (F.col("block") == F.col("_block")), "left_anti")
                .join(threshold.withColumnRenamed("query_id", "_query"), F.col("query_id").eqNullSafe(F.col("_query")), "left")
                .where(F.col("threshold").isNull() | (F.col("bound") >= F.col("threshold") - _SLACK))
                .select("query_id", "block", "n_postings"), "kept")
            best = best_per_query(first_scores.unionByName(maxima.scores(kept, shared, k, scratch)), k, *order).drop("rank")
            found.append(scratch.materialise(best, "best"))
            matches += bounds.agg(F.sum("n_postings")).first()[0] or 0
            scored += first.unionByName(kept).agg(F.sum("n_postings")).first()[0] or 0
            shared.destroy()
        filled = (reduce(DataFrame.unionByName, found)
                  .unionByName(_padding(queries, index, k))
                  .groupBy("query_id", *CHUNK_KEYS).agg(F.min("distance").alias("distance")))
        ranked = best_per_query(filled, k, *order).select("query_id", "rank", *CHUNK_KEYS, "distance")
        ranked = keep.materialise(ranked, "ranked") if keep else materialise(ranked, "ranked")
    return ranked, {"matches": matches, "scored": scored, "blocks": maxima.blocks}
