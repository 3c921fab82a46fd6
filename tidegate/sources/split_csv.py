"""CSV files whose quoted fields hold newlines, read in many byte ranges.

A multi-line CSV file cannot be cut at any newline: one inside quotes does not end a record.
Here the lines of every byte range (Spark's splits of the file) are read in parallel and
numbered, and the record ends are found in two passes:

1. every range counts its lines and the parity of its quote characters (a doubled quote, the
   escape, counts twice and changes nothing);
2. the parities of the ranges before give each range the state it starts in (inside quotes
   or not), which a table of one row per range carries; in the range, a line ends a record
   where the running parity is even. A record that begins in an earlier range takes the last
   record start before it, carried the same way.

Lines are then grouped into records by the number of their first line (a record is one group,
however many ranges it spans) and parsed by Spark's CSV parser. Results equal a multi-line
read of the same files.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.operators.tickets import require_columns
from tidegate.sources.tickets_csv import _field_count, null_na_tokens
from tidegate.storage import Scratch, materialise

_OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def _quotes(line) -> F.Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def records(spark: SparkSession, path: str, range_bytes: int | None = None) -> DataFrame:
    """``file, line, record``: every CSV record of the files with the number of its first line.

    Newlines inside quotes stay in the record; a line break is ``\\n``, a ``\\r`` before it is
    kept inside quotes and dropped at a record's end. ``range_bytes`` sets the size of a byte
    range read by one task (the session's ``spark.sql.files.maxPartitionBytes`` if None).
    """
    setting = "spark.sql.files.maxPartitionBytes"
    saved = spark.conf.get(setting)
    with Scratch(spark, "split-csv") as scratch:
        if range_bytes:
            spark.conf.set(setting, str(range_bytes))
        try:
            lines = scratch.materialise(
                spark.read.option("lineSep", "\n").text(path).select(
                    F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
                    F.monotonically_increasing_id().alias("seq"), F.col("value").alias("text"),
                    (_quotes(F.col("value")) % 2).cast("int").alias("odd")), "lines")
        finally:
            spark.conf.set(setting, saved)
        per_file = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
        ranges = scratch.materialise(
            lines.groupBy("file", "range").agg(F.count("*").alias("n"), (F.sum("odd") % 2).cast("int").alias("odd"))
            .select("file", "range", F.coalesce(F.sum("n").over(per_file), F.lit(0)).alias("before"),
                    F.coalesce(F.sum("odd").over(per_file) % 2, F.lit(0)).cast("int").alias("opens")), "ranges")
        in_range = Window.partitionBy("file", "range").orderBy("seq")
        numbered = lines.join(ranges, ["file", "range"]).select(
            "file", "range", "text", "opens", (F.col("before") + F.row_number().over(in_range) - 1).alias("line"),
            ((F.col("opens") + F.sum("odd").over(in_range)) % 2 == 0).alias("ends"))
        ended_before = F.lag("ends").over(Window.partitionBy("file", "range").orderBy("line"))
        # a range's first line starts a record if the range opens outside quotes
        marked = scratch.materialise(numbered.withColumn(
            "starts", F.coalesce(ended_before, F.col("opens") == 0)).drop("opens"), "marked")
        # the last record start of each range, carried to the ranges after it
        last = marked.where("starts").groupBy("file", "range").agg(F.max("line").alias("last"))
        carried = scratch.materialise(
            ranges.select("file", "range").join(last, ["file", "range"], "left").select(
                "file", "range", F.max("last").over(per_file).alias("carried")), "carried")
        running = Window.partitionBy("file", "range").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
        owned = marked.join(carried, ["file", "range"]).select(
            "file", "line", "ends", "text",
            F.coalesce(F.max(F.when(F.col("starts"), F.col("line"))).over(running), F.col("carried")).alias("record"))
        grouped = owned.groupBy("file", "record").agg(
            F.array_sort(F.collect_list(F.struct("line", "text", "ends"))).alias("parts"))
        text = F.array_join(F.transform("parts", lambda p: p["text"]), "\n")
        closed = F.element_at("parts", -1)["ends"]
        text = F.when(closed, F.regexp_replace(text, "\r$", "")).otherwise(text)
        return materialise(grouped.select("file", F.col("record").alias("line"), text.alias("record")), "csv-records")


def read_split_csv(spark: SparkSession, path: str, range_bytes: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Ticket CSV files with a header, split into byte ranges: ``(tickets, overlong)`` as
    :func:`~tidegate.sources.tickets_csv.read_tickets` gives them.

    Each file's first record is its header; every column is a string bound by the header of
    the first file; a short row is padded with nulls, a row with more fields than the header
    goes to ``overlong`` as raw text; blank records are skipped, as the CSV reader does.
    """
    found = records(spark, path, range_bytes)
    header = found.where("line = 0").select("record").first()
    if header is None:
        raise ValueError("no header")
    names = next(csv.reader(io.StringIO(header[0])))
    require_columns(names)
    body = found.where("line > 0 AND trim(record) <> ''")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    overlong = F.coalesce(_field_count(F.col("record")) > len(names), F.lit(False))
    parsed = body.select(F.col("record"), overlong.alias("_over"),
                         F.from_csv("record", schema.simpleString(), _OPTIONS).alias("_row"))
    rows = parsed.where(~F.col("_over")).select(*[F.col("_row")[c].alias(c) for c in names])
    return null_na_tokens(rows, names), parsed.where("_over").select(F.col("record").alias("raw"))
