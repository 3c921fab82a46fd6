"""JSON Lines sinks and sources for training records and link payloads, and the manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGES_TYPE = T.ArrayType(T.StructType([
    T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]))
CHATML_SCHEMA = T.StructType([T.StructField("messages", MESSAGES_TYPE)])
ALPACA_SCHEMA = T.StructType([
    T.StructField(c, T.StringType()) for c in ("instruction", "input", "output")])

PAYLOAD_SCHEMA = T.StructType([
    T.StructField("source_url", T.StringType()), T.StructField("link_count", T.LongType()),
    T.StructField("links", T.ArrayType(T.StringType()))])


def write_jsonl(records: DataFrame, path: str) -> int:
    """Write one JSON object per line and return how many, counted by the same job."""
    seen = Observation()
    (records.observe(seen, F.count(F.lit(1)).alias("records"))
     .write.mode("overwrite").option("ignoreNullFields", False).json(path))
    return seen.get["records"]


def read_chatml(spark: SparkSession, path) -> DataFrame:
    """ChatML records; a missing ``messages`` is an empty list, a bad line raises."""
    raw = spark.read.schema(CHATML_SCHEMA).option("mode", "FAILFAST").json(path)
    return raw.select(F.coalesce("messages", F.array().cast(MESSAGES_TYPE)).alias("messages"))


def read_alpaca(spark: SparkSession, path) -> DataFrame:
    """Alpaca records; a missing field is empty text, a bad line raises."""
    raw = spark.read.schema(ALPACA_SCHEMA).option("mode", "FAILFAST").json(path)
    return raw.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ALPACA_SCHEMA.names])


def read_payloads(spark: SparkSession, path) -> DataFrame:
    """Link payloads as written; a bad line raises."""
    return spark.read.schema(PAYLOAD_SCHEMA).option("mode", "FAILFAST").json(path)


def output_manifest(spark: SparkSession, outputs: dict[str, str], records: dict[str, int]) -> DataFrame:
    """Records, files and bytes per written data set.

    Record counts are those of the jobs that wrote the data; contents are not read again.
    """
    listed = None
    for name, path in outputs.items():
        files = (spark.read.format("binaryFile").load(path)
                 .select(F.lit(name).alias("dataset"), F.col("length")))
        listed = files if listed is None else listed.unionByName(files)
    counts = F.create_map(*[x for n, c in records.items() for x in (F.lit(n), F.lit(c).cast("bigint"))])
    return listed.groupBy("dataset").agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes")).select(
        "dataset", counts[F.col("dataset")].alias("records"), "files", "bytes")
