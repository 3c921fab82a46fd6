"""Quality classifier by compression: two zstandard dictionaries and a calibrated size difference.

Texts are cut into chunks of ``CHUNK`` bytes; every chunk is compressed once with a
dictionary built from good text and once with one built from bad text. The size
difference over the number of bytes, with the size itself, goes through a logistic
calibration fitted on rows that built neither dictionary.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import is_held_out, pieces, remembered, utf8

CHUNK = 1024
DICTIONARY_BYTES = 64 * 1024
#: Bounds of the fit: labelled rows of each class, and bytes kept of one of them.
SAMPLE_PER_CLASS = 3000
SAMPLE_TEXT_BYTES = 16 * 1024
THRESHOLD = 0.7
#: Bytes of text at which its own features weigh half.
SHORT = 64
_LEVEL = 3


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Probability of label 1 for each text; without usable text that of a featureless one."""
        x = _standard(texts, _features(texts, self.good, self.bad), self.centre, self.scale)
        return 1 / (1 + np.exp(-np.clip(_expand(x) @ self.weights, -30, 30)))


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    known = remembered("zstandard").setdefault("compressors", {})
    if dictionary not in known:
        if len(known) > 7:
            known.clear()
        content = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if content:
            content.precompute_compress(level=_LEVEL)
        known[dictionary] = zstandard.ZstdCompressor(
            level=_LEVEL, dict_data=content, write_content_size=False, write_dict_id=False)
    return known[dictionary]


def _chunks(text: bytes) -> list[bytes]:
    """Even chunks of at most ``CHUNK`` bytes."""
    count = -(-len(text) // CHUNK)
    return [text[i * len(text) // count:(i + 1) * len(text) // count] for i in range(count)]


def _features(texts: list[bytes], good: bytes, bad: bytes) -> np.ndarray:
    """Per text: normalised size difference, normalised size, share of chunks that the bad side wins."""
    by_good, by_bad, out = _compressor(good), _compressor(bad), np.zeros((len(texts), 3))
    for i, text in enumerate(texts):
        if text:
            parts = _chunks(text)
            a = np.array([len(by_good.compress(c)) for c in parts], float)
            b = np.array([len(by_bad.compress(c)) for c in parts], float)
            out[i] = ((b.sum() - a.sum()) / (a.sum() + b.sum()), a.sum() / (len(text) + 16 * len(parts)),
                      (b < a).mean())
    return out


def _standard(texts: list[bytes], x: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Features around those of a usual good text; the shorter a text, the less its own ones weigh."""
    n = np.array([len(t) for t in texts], float)
    return (x - centre) / scale * (n / (n + SHORT))[:, None]


def _expand(x: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(x)), x, x ** 2, x[:, 0] * x[:, 1], x[:, 0] * x[:, 2], x[:, 1] * x[:, 2]])


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary, or plain text as one where there is too little to train on."""
    samples = [c for t in texts for c in _chunks(t)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _own_lines(texts: list[bytes]) -> list[bytes]:
    """The lines of each text that no other text has: shared ones would mark whoever holds them."""
    lines = [set(t.split(b"\n")) for t in texts]
    count = Counter(line for own in lines for line in own)
    return [b"\n".join(line for line in t.split(b"\n") if count[line] == 1) for t in texts]


def _calibrate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge-damped logistic regression by Newton steps."""
    z, damp = _expand(x), 1e-3 * len(y) + 1e-6
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (y - p) - damp * np.r_[0, w[1:]]
        curve = (z * (p * (1 - p))[:, None]).T @ z + damp * np.eye(len(w))
        w = w + np.linalg.solve(curve, slope)
    return w


def clear_labels(labels: DataFrame) -> DataFrame:
    """``doc_id, quality`` outside the held-out quarter; contradicting and null labels are left out."""
    return (labels.where(~is_held_out() & F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
            .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("high"))
            .where("quality = high").select("doc_id", "quality"))


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """At most ``per_class`` labelled rows of each class outside the held-out quarter: doc_id, quality, text.

    The rows are those with the smallest hash of their id, so the sample does not depend on
    the layout. Null and empty texts are not used.
    """
    clear = clear_labels(labels).withColumn("place", F.xxhash64("doc_id"))
    picked = [clear.where(F.col("quality") == q).orderBy("place", "doc_id").limit(per_class) for q in (0, 1)]
    sample = F.broadcast(picked[0].unionByName(picked[1]))
    return (docs.where("text is not null and length(text) > 0").select("doc_id", "text").join(sample, "doc_id")
            .select("doc_id", "quality", "place", F.substring(F.encode("text", "utf-8"), 1, SAMPLE_TEXT_BYTES).alias("text")))


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> QualityModel:
    """Fit on a bounded sample (see ``training_rows``); one half builds dictionaries, the other calibrates.

    The sample may hold the classes in other shares than the labels do; the calibration is
    shifted to the shares of all labels, so that scores are probabilities among them.
    Without labelled rows of both classes the score is the share of label 1, 0.5 if there is none.
    """
    rows = sorted((r.place, r.doc_id, r.quality, bytes(r.text)) for r in training_rows(docs, labels, per_class).collect())
    halves = [[(t, q) for i, (_, _, q, t) in enumerate(rows) if i % 2 == half] for half in (0, 1)]
    own = _own_lines([t for t, _ in halves[0]])
    good, bad = (_dictionary([t for t, (_, q) in zip(own, halves[0], strict=True) if q == side]) for side in (1, 0))
    texts, y = [t for t, _ in halves[1]], np.array([q for _, q in halves[1]], float)
    if len(set(y)) < 2 or not good or not bad:
        rate = (sum(q for _, _, q, _ in rows) + 1) / (len(rows) + 2)
        return QualityModel(good, bad, np.zeros(3), np.ones(3), np.r_[np.log(rate / (1 - rate)), np.zeros(9)])
    x = _features(texts, good, bad)
    centre, scale = x[y == 1].mean(0), x.std(0) + 1e-9
    weights = _calibrate(_standard(texts, x, centre, scale), y)
    counts = {r.quality: r["count"] for r in clear_labels(labels).groupBy("quality").count().collect()}
    weights[0] += np.log(counts[1] / counts[0]) - np.log(y.sum() / (len(y) - y.sum()))
    return QualityModel(good, bad, centre, scale, weights)


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``docs`` with a column ``score``: the probability that the whole text has label 1.

    All other columns stay as they are (one named ``score`` is replaced). Null and empty
    texts get the score of a text without features. Narrow, nothing is shuffled.
    """
    kept = docs.drop("score")
    fields = kept.schema.fields

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            score = model.score(utf8(piece.column("text")))
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(score)], names=[*piece.schema.names, "score"])

    schema = kept.schema.__class__(list(fields)).add("score", "double")
    return kept.mapInArrow(work, schema)
