"""Prefix trie of conversations with subtree rollups.

A conversation is a path of turns ``(role, text)``; every distinct prefix of ``d`` turns is a
node at depth ``d`` below the textless root, and the conversations that start with it are its
members. A node is named by ``(depth, conv_id)`` where ``conv_id`` is its smallest member, so
the ancestor of a node at depth ``e`` is the node that its own ``conv_id`` passes at depth
``e``: a lookup in the table of (conversation, depth) rows, keyed by unique pairs.

Nodes are found by grouping those rows by a SHA-256 chain over the turns (``key_d =
sha256(key_{d-1} + sha256(role) + sha256(text))``), which identifies a prefix by content.

Subtree totals (childless nodes, saved tokens) are rolled up the parent-edge forest by
doubling: after round ``k`` a node holds the totals of its descendants less than ``2^k``
levels below it, and round ``k`` adds what every node holds to its ancestor ``2^k`` levels
up. Each round is a join on unique (conversation, depth) pairs and a grouped sum, which is
partly aggregated before its shuffle, so a node with a third of all conversations below it is
never one task. ``ceil(log2(depth + 1))`` rounds suffice.

The members that end at a node are hashed in ascending order by streaming them through
SHA-256 in range-partitioned, sorted parts: memory stays one Arrow batch whatever the node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.storage import materialise

#: Words that a node's last text counts: runs of anything but space and \t \n \v \f \r.
WORDS = r"[^\x20\x09-\x0D]+"
#: Conversations that share the head of their base: ``c - c % BASE_EVERY``.
BASE_EVERY = 20
#: Turns taken from the base: unsigned crc32 of the decimal id, modulo this.
HEAD_MOD = 4
ROOT_KEY = hashlib.sha256(b"root").hexdigest()
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, role, text``: turns numbered from 1 by turn (nulls first), ties by role and text.

    Null roles and texts become empty; rows without a conv_id belong to no conversation and go.
    """
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return rows.withColumn("pos", F.row_number().over(order).cast("long")).drop("turn")


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation c with the head of its base: ``(ids, rebuilt)``.

    ``ids`` holds ``conv_id, n_turns`` for every conv_id; ``rebuilt`` holds ``conv_id, pos,
    role, text``: the first ``h`` turns of conversation ``c - c % 20`` (all if fewer, none if
    absent), then c's own turns after its first ``h``; ``h`` is crc32 of decimal c, mod 4.
    """
    lengths = turns.groupBy("conv_id").agg(F.count("*").alias("n_own"))
    ids = lengths.select("conv_id", "n_own", (F.crc32(F.col("conv_id").cast("string")) % HEAD_MOD).alias("h"),
                         (F.col("conv_id") - F.col("conv_id") % BASE_EVERY).alias("base"))
    base_len = lengths.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    ids = ids.join(base_len, "base", "left").withColumn(
        "n_head", F.least("h", F.coalesce("n_base", F.lit(0))))
    head_rows = turns.where(F.col("pos") <= HEAD_MOD - 1).select(F.col("conv_id").alias("base"), "pos", "role", "text")
    head = ids.select("conv_id", "base", "h").join(head_rows, "base").where(F.col("pos") <= F.col("h")).select(
        "conv_id", "pos", "role", "text")
    own = turns.join(ids.select("conv_id", "h", "n_head"), "conv_id").where(F.col("pos") > F.col("h")).select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("n_head")).alias("pos"), "role", "text")
    n_turns = F.col("n_head") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))
    return ids.select("conv_id", n_turns.cast("long").alias("n_turns")), head.unionByName(own)


def _chain_one(frame: pd.DataFrame) -> pd.DataFrame:
    """Prefix keys of one conversation's turns, in order of ``pos``."""
    frame = frame.sort_values("pos")
    keys, parents, key = [], [], ROOT_KEY
    for turn in frame["turn_key"]:
        parents.append(key)
        key = hashlib.sha256((key + turn).encode()).hexdigest()
        keys.append(key)
    return pd.DataFrame({"conv_id": frame["conv_id"].to_numpy(), "depth": frame["pos"].to_numpy(),
                         "key": keys, "parent_key": parents, "words": frame["words"].to_numpy()})


def paths(ids: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """One row per conversation and depth, root included: ``conv_id, depth, key, parent_key, words, ends``."""
    turn_key = F.concat(F.sha2("role", 256), F.sha2("text", 256))
    steps = rebuilt.select("conv_id", "pos", turn_key.alias("turn_key"),
                           F.regexp_count("text", F.lit(WORDS)).cast("long").alias("words"))
    schema = "conv_id long, depth long, key string, parent_key string, words long"
    chained = steps.groupBy("conv_id").applyInPandas(_chain_one, schema)
    root = ids.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(ROOT_KEY).alias("key"),
                      F.lit(None).cast("string").alias("parent_key"), F.lit(0).cast("long").alias("words"))
    rows = chained.unionByName(root).join(ids, "conv_id")
    return rows.select("conv_id", "depth", "key", "parent_key", "words", (F.col("depth") == F.col("n_turns")).alias("ends"))


def _stream_sha(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of ascending decimal ids per node, from rows sorted by node and id."""
    node, hasher, first, out = None, None, True, {"depth": [], "conv_id": [], "ends_sha256": []}

    def close():
        out["depth"].append(node[0])
        out["conv_id"].append(node[1])
        out["ends_sha256"].append(hasher.hexdigest())

    for batch in batches:
        depths, nodes, members = (batch.column(i).to_pylist() for i in range(3))
        for d, n, m in zip(depths, nodes, members):
            if node != (d, n):
                if node is not None:
                    close()
                node, hasher, first = (d, n), hashlib.sha256(), True
            hasher.update((str(m) if first else "," + str(m)).encode())
            first = False
        if len(out["depth"]) >= 65_536:
            yield pa.RecordBatch.from_pydict(out)
            out = {k: [] for k in out}
    if node is not None:
        close()
    yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
        [("depth", pa.int64()), ("conv_id", pa.int64()), ("ends_sha256", pa.string())]))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Nodes of the prefix trie of rebuilt conversations, with subtree totals.

    One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null at the
    root), ``n_convs`` (members), ``n_children``, ``n_leaves`` (childless nodes in its subtree,
    itself included), ``saved_tokens`` (over its subtree, each node's ``n_convs - 1`` times the
    words of its last text), ``ends_sha256`` (SHA-256 of its members of exactly ``depth`` turns,
    decimal, ascending, comma-joined; no such member: hash of the empty string).

    Defined results: null role or text is empty text; rows without conv_id are dropped; equal
    turns are ordered by role, then text; a rebuilt conversation without turns is a member of
    the root only; no rows give no nodes. Extra input columns are ignored.
    """
    turns = materialise(ordered_turns(conversations), "trie-turns")
    ids, rebuilt = rebuild(turns)
    ids = materialise(ids, "trie-ids")
    rows = materialise(paths(ids, rebuilt), "trie-paths")
    grouped = rows.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent_key").alias("parent_key"),
        F.count("*").alias("n_convs"), F.max("words").alias("words"))
    grouped = materialise(grouped, "trie-grouped")
    names = grouped.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    children = grouped.where(F.col("parent_key").isNotNull()).groupBy("parent_key").agg(F.count("*").alias("n_children"))
    nodes = (grouped.join(names, "parent_key", "left").join(children.withColumnRenamed("parent_key", "key"), "key", "left")
             .select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
                     ((F.col("n_convs") - 1) * F.col("words")).alias("saved")))
    nodes = materialise(nodes, "trie-nodes")
    # (conversation, depth) -> the node it passes there: unique pairs on both sides of every lookup.
    passes = materialise(rows.join(grouped.select("key", F.col("conv_id").alias("node")), "key")
                         .select("conv_id", "depth", "node"), "trie-passes")
    totals = nodes.select("depth", "conv_id", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
                          F.col("saved").alias("saved_tokens"))
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    step = 1
    while step <= deepest:
        ups = (totals.where(F.col("depth") >= step)
               .select(F.col("conv_id"), (F.col("depth") - step).alias("depth"), "n_leaves", "saved_tokens")
               .join(passes, ["conv_id", "depth"])
               .groupBy("depth", F.col("node").alias("conv_id"))
               .agg(F.sum("n_leaves").alias("up_leaves"), F.sum("saved_tokens").alias("up_saved")))
        totals = materialise(totals.join(ups, ["depth", "conv_id"], "left").select(
            "depth", "conv_id", (F.col("n_leaves") + F.coalesce("up_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("up_saved", F.lit(0))).alias("saved_tokens")), "trie-totals")
        step *= 2
    ends = rows.where("ends").join(grouped.select("key", F.col("conv_id").alias("node")), "key").select(
        "depth", "node", "conv_id")
    spark = conversations.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hashed = (ends.repartitionByRange(parts, "depth", "node").sortWithinPartitions("depth", "node", "conv_id")
              .mapInArrow(_stream_sha, "depth long, conv_id long, ends_sha256 string"))
    return (nodes.join(totals, ["depth", "conv_id"]).join(hashed, ["depth", "conv_id"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256")))
