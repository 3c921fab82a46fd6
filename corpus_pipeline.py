"""A corpus from raw documents to token ids: stages over the whole table, each from Parquet to Parquet."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.bpe import round_trip
from tidegate.llm.common import join_checked, read
from tidegate.llm.jaccard import similar_documents
from tidegate.llm.mixing import mix_sources
from tidegate.llm.quality import THRESHOLD, fit_quality, score_quality
from tidegate.llm.suffix_dedup import remove_repeats
from tidegate.storage import materialise

#: Bytes of rows that go to a Python worker at once; the executor and the worker hold a few times as much a task.
BATCH_BYTES = 4 << 20


def _small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session's queries; they are planned when a stage's result is written."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; the rest go."""
    _small_batches(spark)
    model = fit_quality(docs, read(spark, sf_dir, "labels"))
    return score_quality(docs, model).where(F.col("score") >= THRESHOLD).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Rows that repeat an id stay once if they are equal in all columns. Rows without an id
    are in no group and stay.
    """
    _small_batches(spark)
    groups = materialise(similar_documents(docs, width=5, percent=80), "pipeline-groups")
    by_id = groups.where("doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(
        F.max(F.col("doc_id") == F.col("component_id")).alias("_first"), (F.count("*") > 1).alias("_repeated"))
    marked = materialise(by_id.where("not _first or _repeated"), "pipeline-marked")
    joined = join_checked(docs.withColumn("_id", F.col("doc_id").cast("long")), marked, "_id", "left")
    once = joined.where("_repeated and _first").select(*docs.columns).dropDuplicates()
    return joined.where("_first is null").select(*docs.columns).unionByName(once)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has too; ``n_chars`` follows the text."""
    _small_batches(spark)
    cut = remove_repeats(docs, as_text=True)
    text = F.when(F.size("removed") > 0, F.col("kept")).otherwise(F.col("text"))
    cut = cut.withColumn("text", text)
    if "n_chars" in docs.columns:
        n_chars = F.when(F.size("removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
        cut = cut.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order in which the sources are mixed."""
    return mix_sources(docs).orderBy("mix_position", "mix_place").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, its place in the mix, and whether the ids decode to its text.

    Files do not keep an order when they are read, so the place is derived again from the
    same rows: ``mix_position`` and ``mix_place`` order the result.
    """
    _small_batches(spark)
    placed = mix_sources(docs.select("doc_id", "source", "text"))
    coded = round_trip(placed, public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select("doc_id", "source", "mix_position", "mix_place", F.size("ids").cast("long").alias("n_tokens"), "ids",
                        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("exact"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeats", repeats), ("mixing", mixing), ("tokens", tokens)]

#: Trained scores, hashed similarity and token ids have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
