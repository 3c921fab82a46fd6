"""Mixing sources to target weights by Pfair scheduling, in DataFrame operations only.

Each source is cut into blocks; a slot takes one. A fluid mix would serve all sources at
once, by their exact weights, and when one ends the others share its part. Block i of a
source is released when the fluid begins it and due when the fluid is through with it, both
in whole slots; each slot takes, among released blocks, the one due first. These windows
can always be met, so over the whole run a source is never a whole block away from the
fluid. One pass over the slots keeps only where every source stands at each ``cycle``-th
slot; from there the cycles are scheduled side by side.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.storage import materialise

from .common import join_checked
from .sharding import HASH_BITS, hash_bits

BLOCK_ROWS = 64
CYCLE = 1000
#: A slot looks at every source, so sources are bounded.
MAX_SOURCES = 2048
#: Slots by which fluid times may be off.
_ROUNDING = 1e-6
_BUCKET_BITS = 12


def _bind(value: Column, use) -> Column:
    """``use`` of a value that is evaluated once."""
    return F.transform(F.array(value), use)[0]


def _entry(everything: Column, s: Column, i: Column) -> Column:
    """Source ``s`` of ``everything`` with ``i`` blocks taken: the window of its next block."""
    def slots(i: Column) -> Column:
        """Slots until the fluid has served ``i`` blocks of the source."""
        return _bind(i / F.get(everything, s)["weight"], lambda v: F.aggregate(
            everything, F.lit(0.0), lambda t, x: t + F.least(x["blocks"].cast("double"), x["weight"] * v)))

    return F.struct(s.cast("int").alias("s"), i.cast("long").alias("i"), F.get(everything, s)["blocks"].alias("blocks"),
                    F.floor(slots(i) + _ROUNDING).cast("long").alias("released"),
                    F.ceil(slots(i + 1) - _ROUNDING).cast("long").alias("due"))


def _next(state: Column, slot: Column) -> Column:
    """The source whose next block is due first among the released ones."""
    return F.array_min(F.transform(state, lambda x: F.when(x["i"] < x["blocks"], F.struct(
        (x["released"] > slot).alias("early"), x["due"].alias("due"), x["s"].alias("s")))))["s"]


def _take(everything: Column, state: Column, chosen: Column) -> Column:
    return F.transform(state, lambda x: F.when(x["s"] == chosen, _entry(everything, x["s"], x["i"] + 1)).otherwise(x))


def _cycle(everything: Column, taken: Column, first: Column, last: Column) -> Column:
    """Blocks of the slots ``first`` to ``last``: array of (source, i)."""
    def step(state: Column, slot: Column) -> Column:
        return _bind(_next(state["at"], slot), lambda c: F.struct(
            _take(everything, state["at"], c).alias("at"),
            F.concat(state["done"], F.array(F.struct(c.alias("s"), F.get(state["at"], c)["i"].alias("i")))).alias("done")))

    start = F.struct(F.transform(taken, lambda i, s: _entry(everything, s, i)).alias("at"),
                     F.expr("cast(array() as array<struct<s:int,i:bigint>>)").alias("done"))
    return F.aggregate(F.sequence(first, last), start, step, lambda state: state["done"])


def _cycle_starts(everything: Column, total: Column, cycle: int) -> Column:
    """For each cycle the blocks that were taken of every source before it."""
    def run(state: Column, number: Column) -> Column:
        slots = F.sequence(number * cycle, F.least((number + 1) * cycle, total) - 1)
        return F.struct(
            F.aggregate(slots, state["at"], lambda at, slot: _bind(_next(at, slot), lambda c: _take(everything, at, c))).alias("at"),
            F.concat(state["starts"], F.array(F.transform(state["at"], lambda x: x["i"]))).alias("starts"))

    start = F.struct(F.transform(everything, lambda _, s: _entry(everything, s, F.lit(0))).alias("at"),
                     F.expr("cast(array() as array<array<bigint>>)").alias("starts"))
    numbers = F.sequence(F.lit(0).cast("long"), F.floor((total - 1) / cycle))
    return F.aggregate(numbers, start, run, lambda state: state["starts"])


def plan_mix(sizes: DataFrame, weights: Mapping[str, float] | None, alpha: float, block_rows: int, cycle: int) -> DataFrame:
    """From ``sizes(source, rows)``: ``source, mix_block, mix_position`` of every block.

    Sources without a given weight weigh one block a cycle.
    """
    if weights is None:
        weight = F.pow(F.col("rows").cast("double"), F.lit(alpha))
    else:
        given = [x for s, w in weights.items() for x in (F.lit(s), F.lit(float(w)))]
        weight = F.coalesce(F.create_map(*given)[F.col("source")], F.lit(0.0)) if given else F.lit(0.0)
    planned = sizes.select("source", F.greatest(weight, F.lit(0.0)).alias("weight"), F.ceil(F.col("rows") / block_rows).cast("long").alias("blocks"))
    whole = planned.agg(F.array_sort(F.collect_list(F.struct("source", "weight", "blocks"))).alias("all")).where(F.size("all") > 0)
    whole = whole.where(F.when(F.size("all") > MAX_SOURCES, F.raise_error(F.lit(f"more than {MAX_SOURCES} sources"))).otherwise(F.lit(True)))
    given = F.aggregate("all", F.lit(0.0), lambda a, x: a + x["weight"])
    least = F.when(given > 0, given / cycle).otherwise(F.lit(1.0))
    whole = whole.withColumn("least", least).withColumn("all", F.transform("all", lambda x: x.withField(
        "weight", F.when(x["weight"] > 0, x["weight"]).otherwise(F.col("least")))))
    whole = whole.withColumn("total", F.aggregate("all", F.lit(0).cast("long"), lambda n, x: n + x["blocks"]))
    cycles = (whole.select("all", "total", F.posexplode(_cycle_starts(F.col("all"), F.col("total"), cycle)).alias("number", "taken"))
              .withColumn("first", F.col("number").cast("long") * cycle)
              .withColumn("last", F.least(F.col("first") + cycle, F.col("total")) - 1).repartition("number"))
    slots = cycles.select("all", "first", F.posexplode(_cycle(F.col("all"), F.col("taken"), F.col("first"), F.col("last"))).alias("slot", "turn"))
    return slots.select(F.get("all", F.col("turn.s"))["source"].alias("source"), F.col("turn.i").alias("mix_block"),
                        (F.col("first") + F.col("slot")).alias("mix_position"))


def mix_sources(docs: DataFrame, weights: Mapping[str, float] | None = None, alpha: float = 0.5,
                block_rows: int = BLOCK_ROWS, cycle: int = CYCLE, key: str = "doc_id", source: str = "source") -> DataFrame:
    """``docs`` with ``mix_block``, ``mix_position`` and ``mix_place``: every row once, in its slot.

    ``mix_position`` numbers blocks in mixed order from 0, ``mix_block`` those of the row's
    source, ``mix_place`` rows in a block. Without ``weights`` a source weighs its row count
    to the power ``alpha``. ``cycle`` only sets how many slots a task schedules, and the weight
    of sources that have none given. Rows of a source are ordered by a hash of their key; equal keys
    keep an arbitrary order among themselves. A null source is a source of its own. Columns
    with the three names are replaced.
    """
    kept = docs.drop("mix_block", "mix_position", "mix_place")
    named = kept.withColumns({"_source": F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")),
                              "_h": hash_bits(key)}).withColumn("_bucket", F.shiftright("_h", HASH_BITS - _BUCKET_BITS))
    counts = named.groupBy("_source", "_bucket").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("_source", "_bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_shift"))
    sizes = counts.groupBy(F.col("_source").alias("source")).agg(F.sum("n").alias("rows"))
    weights = None if weights is None else {f"={s}": w for s, w in weights.items()}
    slots = materialise(plan_mix(sizes, weights, alpha, block_rows, cycle).withColumnRenamed("source", "_source"), "mix-slots")
    number = F.row_number().over(Window.partitionBy("_source", "_bucket").orderBy("_h", key)) - 1
    placed = (named.withColumn("_number", number)
              .join(shifts, ["_source", "_bucket"])
              .withColumn("_number", F.col("_number") + F.col("_shift"))
              .withColumn("mix_block", F.floor(F.col("_number") / block_rows))
              .withColumn("mix_place", (F.col("_number") % block_rows).cast("int")))
    placed = join_checked(placed, slots, ["_source", "mix_block"], "inner")
    return placed.select(*[F.col(f"`{c}`") for c in kept.columns], "mix_block", "mix_position", "mix_place")
