"""Listed phrases from a table, found by a multi-pattern automaton.

``phrases`` is a table ``place, phrase``; a text's match is the phrase of the smallest place
that occurs in the lower-cased text (the rule of :func:`~tidegate.operators.guard.toxic_phrase`,
where the list order is the place). The phrases are measured first; up to ``PART_BYTES`` they
are sent to every executor as one list and each Python worker builds one Aho-Corasick automaton
from it, which finds all phrases of a text in one pass over it. A larger table is cut into
parts of at most that size by place; each part scans the texts, and the smallest place of all
parts wins, so no phrase is dropped at any size.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.storage import materialise

PART_BYTES = 64 * 1024 * 1024
_automata: dict[str, object] = {}


def _automaton(token: str, phrases: list[tuple[int, str]]):
    """One automaton per part and Python worker, kept while the worker lives."""
    if token not in _automata:
        import ahocorasick
        _automata.clear()
        machine, empty = ahocorasick.Automaton(), None
        best: dict[str, int] = {}
        for place, phrase in phrases:
            if phrase == "":
                empty = place if empty is None else min(empty, place)
            elif phrase not in best or place < best[phrase]:
                best[phrase] = place
        for phrase, place in best.items():
            machine.add_word(phrase, (place, phrase))
        if best:
            machine.make_automaton()
        _automata[token] = (machine if best else None, empty)
    return _automata[token]


def _scan(shared, token: str, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, empty = _automaton(token, shared.value)
        for batch in batches:
            places, found = [], []
            for low in batch.column("_low").to_pylist():
                best = None
                if low is not None:
                    if empty is not None:
                        best = (empty, "")
                    if machine is not None:
                        for _, hit in machine.iter(low):
                            if best is None or hit[0] < best[0]:
                                best = hit
                places.append(None if best is None else best[0])
                found.append(None if best is None else best[1])
            columns = [batch.column(key), pa.array(places, pa.int64()), pa.array(found, pa.string())]
            names = [key, "place", "phrase"]
            if "_row" in batch.schema.names:
                columns, names = columns + [batch.column("_row")], names + ["_row"]
            yield pa.RecordBatch.from_arrays(columns, names=names)
    return run


def listed_phrases(texts: DataFrame, phrases: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, place, phrase``: the listed phrase of the smallest place in each lower-cased text.

    One row per row of ``texts``; no match, or a null text: nulls. Null phrases never match, an
    empty one matches every text that is not null; a phrase listed twice counts at its smaller
    place. Text is lower-cased by Spark, as the rule's SQL does.
    """
    spark = texts.sparkSession
    listed = phrases.select(F.col("place").cast("long").alias("place"), F.col("phrase").cast("string").alias("phrase")).where(
        F.col("phrase").isNotNull() & F.col("place").isNotNull())
    size = listed.agg(F.coalesce(F.sum(F.octet_length("phrase") + 16), F.lit(0)), F.min("place"), F.max("place")).first()
    parts = max(1, math.ceil(2 * size[0] / PART_BYTES))  # parts by hash: room for uneven ones
    low = texts.select(F.col(key), F.lower(F.col(text)).alias("_low"))
    if parts > 1:  # every part scans the same numbered rows
        low = materialise(low.withColumn("_row", F.monotonically_increasing_id()), "phrase-texts")
    schema = f"{key} {texts.schema[key].dataType.simpleString()}, place long, phrase string" + (", _row long" if parts > 1 else "")
    found = None
    for part in range(parts):
        mine = listed.where(F.pmod(F.xxhash64("phrase"), F.lit(parts)) == part) if parts > 1 else listed
        values = [(r.place, r.phrase) for r in mine.toLocalIterator()]  # measured: at most PART_BYTES
        shared = spark.sparkContext.broadcast(values)
        scanned = low.mapInArrow(_scan(shared, uuid.uuid4().hex, key), schema)
        found = scanned if found is None else found.unionByName(scanned)
    if parts == 1:
        return found
    best = F.min(F.when(F.col("place").isNotNull(), F.struct("place", "phrase")))
    return found.groupBy("_row", key).agg(best.alias("_best")).select(key, "_best.place", "_best.phrase")
