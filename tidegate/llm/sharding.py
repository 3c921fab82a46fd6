"""Sharding by extendible hashing, in DataFrame operations only.

A directory is indexed by leading bits of a 60-bit hash of the key. A bucket that exceeds
the byte limit is split on its next bit, any other stays. As bucket sizes only shrink on
the way down, the bucket of a row is the shortest prefix of its hash that fits; rounds add
up bytes per cell of a few more bits and read the buckets of all depths between from
these cells, so rows are aggregated once and only rows of oversized cells again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.storage import materialise

HASH_BITS = 60
#: Bits that a later round looks ahead.
STEP = 12


def hash_bits(key: str) -> Column:
    """The leading 60 bits of md5 of the key as text; a null key counts as empty text."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def _directory(cells: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """Buckets of the cells at ``high`` bits that are final: ``cell, depth, prefix, shard_bytes, stuck``.

    A bucket is final if it fits, or if it holds one hash value only and cannot be split.
    """
    opened = cells.withColumn("depth", F.explode(F.sequence(F.lit(low), F.lit(high)))).withColumn(
        "prefix", F.expr(f"shiftright(cell, {high} - depth)"))
    buckets = (opened.groupBy("depth", "prefix")
               .agg(F.sum("bytes").alias("shard_bytes"), F.min("first").alias("first"), F.max("last").alias("last"))
               .withColumn("stuck", F.col("shard_bytes") > limit)
               .where(~F.col("stuck") | (F.col("first") == F.col("last")))
               .select("depth", "prefix", "shard_bytes", "stuck"))
    final = opened.select("cell", "depth", "prefix").join(buckets, ["depth", "prefix"])
    return (final.groupBy("cell").agg(F.min(F.struct("depth", "prefix", "shard_bytes", "stuck")).alias("b"))
            .select("cell", "b.*"))


def _pages(rows: DataFrame, limit: int) -> DataFrame:
    """Rows of buckets with one hash value, dealt to pages that fit the limit.

    A page takes as many rows as the largest row of the bucket allows, at least one. The rows
    are first dealt round-robin and written with the number of their part, so that a hash
    value holding most rows is never in one task and every later step reads the same parts;
    rows are numbered inside a part and shifted by the rows of the parts before.
    """
    spark = rows.sparkSession
    dealt = materialise(rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
                        .withColumn("part", F.spark_partition_id()), "shard-stuck")
    parts = dealt.groupBy("h", "part").agg(F.count("*").alias("n"), F.max("n_bytes").alias("most"))
    per_hash = Window.partitionBy("h")
    before = per_hash.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("h", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"),
                         F.max("most").over(per_hash).alias("most"))
    number = F.row_number().over(Window.partitionBy("h", "part").orderBy("n_bytes")) - 1 + F.col("shift")
    return (dealt.join(parts, ["h", "part"])
            .withColumn("page", F.floor(number / F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest("most", F.lit(1))))))
            .drop("part", "shift", "most"))


def shard(docs: DataFrame, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Shards of at most ``limit`` bytes: ``key, n_bytes, depth, prefix, page, shard_bytes``.

    One row per row of ``docs``. ``depth`` leading hash bits, as the number ``prefix``, name
    the bucket; ``page`` is 0 unless all rows of an oversized bucket have one hash value
    (repeated keys, or one huge text): these fill pages, and a text beyond the limit has a
    page for itself. ``shard_bytes`` counts the whole bucket. Null texts have 0 bytes, null
    keys share the hash of empty text. No rows give no shards.
    """
    rows = materialise(docs.select(F.col(key).alias("key"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
                                   hash_bits(key).alias("h")), "shard-rows")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    low, high = 0, min(HASH_BITS, max(1, (total // max(1, limit)).bit_length() + 2))
    pending, done = rows, None
    while True:
        cell = F.shiftright("h", HASH_BITS - high)
        cells = materialise(pending.groupBy(cell.alias("cell")).agg(
            F.sum("n_bytes").alias("bytes"), F.min("h").alias("first"), F.max("h").alias("last")), "shard-cells")
        directory = materialise(_directory(cells, low, high, limit), "shard-directory")
        settled = pending.withColumn("cell", cell).join(directory, "cell").drop("cell")
        done = settled if done is None else done.unionByName(settled)
        left = cells.join(directory, "cell", "left_anti").select("cell")
        if left.isEmpty():
            break
        pending = pending.withColumn("cell", cell).join(left, "cell", "left_semi").drop("cell")
        low, high = high + 1, min(HASH_BITS, high + STEP)
    columns = [F.col("key").alias(key), "n_bytes", "depth", "prefix", F.col("page").cast("long").alias("page"), "shard_bytes"]
    plain = done.where("not stuck").withColumn("page", F.lit(0))
    return plain.select(*columns).unionByName(_pages(done.where("stuck"), limit).select(*columns))
