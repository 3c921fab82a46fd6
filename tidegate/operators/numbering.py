"""Row numbers in a total order without a window over all rows.

``row_number() OVER (ORDER BY ...)`` with no partition runs in one task. Here the rows are
range-partitioned by the order and sorted in each part, written once with their part and
their place in it (the low bits of ``monotonically_increasing_id``), and every part's rows
are counted. The counts, one row per part, give each part the rows before it; a row's number
is that plus its place. Ties that remain after all order columns are broken by the row's
place in its input, so identical rows are spread over parts like any others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.storage import materialise

_PLACE_BITS = 33  # monotonically_increasing_id keeps the place in a part in its lower 33 bits


def number_rows(df: DataFrame, *order: Column, name: str = "row_no") -> DataFrame:
    """``df`` with ``name``: 1, 2, ... in ``order`` (columns with their direction and nulls).

    Rows equal in every order column are numbered in the order of their place in the input.
    No rows give no rows. The numbered rows are a written table.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = "_tie_" + name
    ranked = (df.withColumn(tie, F.monotonically_increasing_id())
              .repartitionByRange(parts, *order, F.col(tie)).sortWithinPartitions(*order, F.col(tie))
              .withColumn("_at_" + name, F.monotonically_increasing_id()))
    placed = materialise(ranked.select(
        "*", F.shiftright("_at_" + name, _PLACE_BITS).alias("_part_" + name),
        F.col("_at_" + name).bitwiseAND((1 << _PLACE_BITS) - 1).alias("_place_" + name)), "numbered")
    sizes = placed.groupBy("_part_" + name).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part_" + name).rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_part_" + name, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    numbered = placed.join(F.broadcast(shifts), "_part_" + name)  # one row per part
    return numbered.select(*df.columns, (F.col("_shift") + F.col("_place_" + name) + 1).alias(name))
