"""Document scan: one file is one text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_documents(spark: SparkSession, path) -> DataFrame:
    """Columns ``doc_id`` (the file path) and ``text`` (the whole file)."""
    return (spark.read.text(path, wholetext=True)
            .select(F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("text")))
