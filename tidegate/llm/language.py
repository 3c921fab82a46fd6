"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased, everything but letters becomes one space, and all 2- and 3-grams
of it are hashed into ``BUCKETS`` counters. Learning adds up counters by language as a
Spark aggregate over all training rows; the matrix of log probabilities, whose size is
bounded by languages times buckets, goes to the workers.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mix, pieces, remembered

BUCKETS = 1 << 15
#: The matrix stays below 64 MB; a fit on more languages is refused.
MAX_LANGUAGES = 256
_GRAMS = (2, 3)


def _fold() -> np.ndarray:
    """For each code point its lower-case letter, a space for anything else."""
    if "fold" not in remembered("letters"):
        table = np.full(sys.maxunicode + 1, 32, np.uint32)
        for c in range(sys.maxunicode + 1):
            x = chr(c)
            if x.isalpha():
                low = x.lower()
                table[c] = ord(low) if len(low) == 1 else c
        remembered("letters")["fold"] = table
    return remembered("letters")["fold"]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams of all texts, the text each belongs to, and whether a text has a letter."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    folded = _fold()[codes]
    lettered = np.bincount(owner[folded != 32], minlength=len(texts)) > 0
    keep = np.ones(len(folded), bool)
    keep[1:] = (folded[1:] != 32) | (folded[:-1] != 32) | (owner[1:] != owner[:-1])
    folded, owner = folded[keep].astype(np.uint64), owner[keep]
    buckets, owners = [], []
    for n in _GRAMS:
        if len(folded) >= n:
            key = folded[:len(folded) - n + 1].copy()
            for i in range(1, n):
                key = key * np.uint64(0x100000001B3) + folded[i:len(folded) - n + 1 + i]
            inside = owner[:len(owner) - n + 1] == owner[n - 1:]
            buckets.append((mix(key[inside] + np.uint64(n)) & np.uint64(BUCKETS - 1)).astype(np.int64))
            owners.append(owner[:len(owner) - n + 1][inside])
    return (np.concatenate(buckets) if buckets else np.zeros(0, np.int64),
            np.concatenate(owners) if owners else np.zeros(0, np.int64), lettered)


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    log_prior: np.ndarray
    log_matrix: np.ndarray  # buckets x languages

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The most probable language of each text and its posterior probability."""
        bucket, owner, lettered = grams(texts)
        total = np.tile(self.log_prior, (len(texts), 1))
        for column in range(len(self.languages)):
            total[:, column] += np.bincount(owner, self.log_matrix[bucket, column], len(texts))
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        best = total.argmax(1)
        share = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
        return ([self.languages[b] if ok else "und" for b, ok in zip(best, lettered, strict=True)],
                np.where(lettered, share, 0.0))


def fit_language(docs: DataFrame) -> LanguageModel:
    """Learn from every row of ``docs(text, lang)`` with both given; whole texts, all rows.

    Counters are added up inside each batch first, so that a language holding most rows
    sends few rows. No usable row gives a model that answers ``und``.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for piece in pieces(batches):
            texts, langs = piece.column("text").to_pylist(), piece.column("lang").to_pylist()
            bucket, owner, _ = grams(texts)
            names = sorted(set(langs))
            code = np.array([names.index(x) for x in langs])[owner] if len(owner) else owner
            counts = np.bincount(code * BUCKETS + bucket, minlength=len(names) * BUCKETS).reshape(-1, BUCKETS)
            for name, line in zip(names, counts, strict=True):
                totals[name] = totals.get(name, 0) + line
                rows[name] = rows.get(name, 0) + langs.count(name)
            if len(totals) > MAX_LANGUAGES:
                raise ValueError(f"more than {MAX_LANGUAGES} languages")
        for name, line in totals.items():
            used = np.flatnonzero(line)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([name] * (len(used) + 1), pa.string()),
                "bucket": pa.array(np.r_[-1, used].astype(np.int32)), "n": pa.array(np.r_[rows[name], line[used]])})

    usable = docs.where("text is not null and lang is not null").select("text", "lang")
    counted = (usable.mapInArrow(count, "lang string, bucket int, n long")
               .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    table = counted.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("counts")).orderBy("lang").limit(MAX_LANGUAGES + 1)
    languages, prior, columns = [], [], []
    for row in table.collect():
        line = np.zeros(BUCKETS)
        for bucket, n in row.counts:
            if bucket < 0:
                prior.append(n)
            else:
                line[bucket] = n
        languages.append(row.lang)
        columns.append(np.log((line + 0.5) / (line.sum() + 0.5 * BUCKETS)))
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return LanguageModel(languages, np.log(np.array(prior, float) / max(1, sum(prior))),
                         np.array(columns).T.copy() if columns else np.zeros((BUCKETS, 0)))


def predict_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (posterior probability, 0 for ``und``).

    ``und`` where the text is null, empty or without a letter. Other columns stay; columns
    with these two names are replaced. Narrow, nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.log_prior, model.log_matrix))
    kept = docs.drop("lang_pred", "score")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = LanguageModel(*shared.value)
        for piece in pieces(batches):
            lang, score = own.predict([t or "" for t in piece.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(lang, pa.string()), pa.array(score)],
                                             names=[*piece.schema.names, "lang_pred", "score"])

    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return kept.mapInArrow(work, schema)
