"""Guardrails and guarded retrieval on a stream of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidegate.functions.text import strip
from tidegate.operators.guard import guard_queries
from tidegate.operators.retrieval import TOP_K
from tidegate.operators.tfidf import TextIndex
from tidegate.plans.guarded_rag import guarded_rag
from tidegate.storage import Scratch


def read_query_stream(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Files of a folder as a stream, with a given schema."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.format(fmt).load(path)


def usable_queries(stream: DataFrame, text: str = "query") -> DataFrame:
    """Stripped queries, blank ones dropped."""
    return stream.withColumn(text, strip(F.col(text))).filter(F.col(text) != "")


def start_guardrail(
    queries: DataFrame, out: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Append every query with its guardrail result to a Parquet folder."""
    return (guard_queries(usable_queries(queries)).writeStream
            .format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint).option("path", out)
            .trigger(**(trigger or {"availableNow": True})).start())


def start_guarded_rag(
    queries: DataFrame, index: TextIndex, out: str, checkpoint: str, k: int = TOP_K, **trigger
) -> StreamingQuery:
    """Answer each micro-batch as a query table against the stored index.

    A batch is read from the source once. It writes its own ``batch_id=N`` folder,
    overwrites it when it is replayed, and leaves nothing else.
    """
    return (usable_queries(queries).writeStream
            .foreachBatch(_answer_batch(index, out, k))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def _answer_batch(index: TextIndex, out: str, k: int) -> Callable[[DataFrame, int], None]:
    def answer(batch: DataFrame, batch_id: int) -> None:
        with Scratch(batch.sparkSession) as scratch:
            asked = scratch.materialise(batch, "batch")
            guarded_rag(asked, index, k, scratch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return answer
