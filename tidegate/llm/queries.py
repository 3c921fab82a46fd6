"""The queries of this package: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import round_trip
from .common import is_held_out, read
from .embedding_dedup import near_duplicates
from .jaccard import similar_documents
from .language import fit_language, predict_language
from .licenses import scan_licenses
from .mixing import mix_sources
from .packing import pack_documents
from .prefix_trie import prefix_trie
from .repair import repair_damaged
from .quality import THRESHOLD, fit_quality, score_quality
from .sharding import HASH_BITS, shard
from .suffix_dedup import remove_repeats
from .topk import top_k

SHARD_BYTES = 64 * 1024 * 1024
SMALL_SHARD_BYTES = 64 * 1024


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = scan_licenses(read(spark, sf_dir, "documents").select("doc_id", "text"))
    phrases = F.filter("matches", lambda m: m["phrase"])
    names = lambda found: F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda m: m["label"]))), ",")
    return scanned.select(
        "doc_id", "n_words", F.size(phrases).cast("long").alias("n_base"),
        F.array_min(F.transform(phrases, lambda m: m["first_word"])).alias("first_word"),
        F.array_max(F.transform(phrases, lambda m: m["first_word"])).alias("last_word"),
        names(phrases).alias("base_labels"), names(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0)).alias("score"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = fit_language(docs.where(~is_held_out()))
    return predict_language(docs.select("doc_id", is_held_out().alias("held_out"), "text"), model).drop("text")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(read(spark, sf_dir, "documents"), SHARD_BYTES)


def shard_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator with a limit that splits buckets at every scale."""
    return shard(read(spark, sf_dir, "documents"), SMALL_SHARD_BYTES)


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 100 = 0"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["length"]).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = fit_quality(docs, read(spark, sf_dir, "labels"))
    scored = score_quality(docs.select("doc_id", is_held_out().alias("held_out"), "text"), model).drop("text")
    return scored.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(read(spark, sf_dir, "documents"), width=3, percent=90)


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "embeddings"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "mix_block", "mix_position", "mix_place")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read(spark, sf_dir, "conversations"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(read(spark, sf_dir, "conversations"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def crc32_sql(text: str) -> str:
    """Unsigned crc32 of an ASCII text, bit by bit, for DuckDB (which has none)."""
    step = "lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END"
    byte = "lambda c, b: list_reduce(list_prepend(xor(c, b), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]), " + step + ")"
    codes = f"list_transform(range(strlen({text})), lambda i: ascii(({text})[i + 1])::UBIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {codes}), {byte}), 4294967295::UBIGINT)"


PREFIX_TRIE_SQL = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, count(*) AS n_own FROM t GROUP BY ALL),
i AS (SELECT l.conv_id, l.n_own, {crc32_sql("l.conv_id::VARCHAR")} % 4 AS h, coalesce(b.n_own, 0) AS n_base,
  l.conv_id - l.conv_id % 20 AS base FROM l LEFT JOIN l AS b ON b.conv_id = l.conv_id - l.conv_id % 20),
r AS (SELECT i.conv_id, t.pos, t.role, t.text FROM i JOIN t ON t.conv_id = i.base AND t.pos <= i.h
  UNION ALL SELECT i.conv_id, t.pos - i.h + least(i.h, i.n_base), t.role, t.text FROM i JOIN t ON t.conv_id = i.conv_id AND t.pos > i.h),
n AS (SELECT conv_id, least(h, n_base) + greatest(n_own - h, 0) AS n_turns FROM i),
p AS (SELECT conv_id, pos AS depth, string_agg(sha256(role) || sha256(text), '') OVER (PARTITION BY conv_id ORDER BY pos) AS prefix,
  len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM r
  UNION ALL SELECT conv_id, 0, '', 0 FROM n),
pn AS (SELECT p.*, min(conv_id) OVER (PARTITION BY prefix) AS node FROM p),
nd AS (SELECT pn.node AS conv_id, pn.depth, count(*) AS n_convs, any_value(pn.words) AS words,
  coalesce(sha256(string_agg(pn.conv_id::VARCHAR, ',' ORDER BY pn.conv_id) FILTER (WHERE pn.depth = n.n_turns)), sha256('')) AS ends_sha256
  FROM pn JOIN n USING (conv_id) GROUP BY pn.node, pn.depth),
par AS (SELECT nd.conv_id, nd.depth, q.node AS parent_conv_id FROM nd LEFT JOIN pn AS q ON q.conv_id = nd.conv_id AND q.depth = nd.depth - 1),
ch AS (SELECT parent_conv_id, depth - 1 AS depth, count(*) AS n_children FROM par WHERE parent_conv_id IS NOT NULL GROUP BY ALL),
f AS (SELECT nd.*, par.parent_conv_id, coalesce(ch.n_children, 0) AS n_children FROM nd JOIN par USING (conv_id, depth)
  LEFT JOIN ch ON ch.parent_conv_id = nd.conv_id AND ch.depth = nd.depth),
s AS (SELECT a.node AS conv_id, a.depth, sum(CASE WHEN u.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
  sum((u.n_convs - 1) * u.words) AS saved_tokens FROM f AS u JOIN pn AS a ON a.conv_id = u.conv_id AND a.depth <= u.depth GROUP BY ALL)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, f.parent_conv_id, CAST(f.n_convs AS BIGINT) AS n_convs,
  CAST(f.n_children AS BIGINT) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens,
  f.ends_sha256 FROM f JOIN s USING (conv_id, depth)"""


def _shards_sql(limit: int) -> str:
    return f"""
WITH r AS (SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
  ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS h FROM documents),
b AS (SELECT d AS depth, h >> ({HASH_BITS} - d) AS prefix, sum(n_bytes) AS shard_bytes
  FROM r, (SELECT unnest(range(0, {HASH_BITS + 1})) AS d) GROUP BY ALL
  HAVING sum(n_bytes) <= {limit} OR min(h) = max(h)),
f AS (SELECT r.doc_id, r.n_bytes, b.*, row_number() OVER (PARTITION BY r.doc_id ORDER BY b.depth) AS place
  FROM r JOIN b ON b.prefix = r.h >> ({HASH_BITS} - b.depth))
SELECT doc_id, n_bytes, CAST(depth AS INTEGER) AS depth, prefix, CAST(0 AS BIGINT) AS page,
  CAST(shard_bytes AS BIGINT) AS shard_bytes FROM f WHERE place = 1"""


TOP_K_SQL = """
WITH v AS (SELECT vec_id, embedding FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS (SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding) AS x FROM v),
n AS (SELECT vec_id, i, CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM c),
s AS (SELECT q.vec_id AS query_id, o.vec_id, CAST(sum(q.x * o.x) AS BIGINT) AS score
  FROM n AS q JOIN n AS o ON q.i = o.i AND q.vec_id <> o.vec_id WHERE q.vec_id % 100 = 0 GROUP BY ALL)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 10"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licenses": op1_licenses, "op2_language": op2_language, "op3_sharding": op3_sharding,
    "op4_topk": op4_topk, "op5_suffix_dedup": op5_suffix_dedup, "op6_quality": op6_quality, "op7_bpe": op7_bpe, "op8_jaccard": op8_jaccard, "op9_mixing": op9_mixing,
    "op10_embedding_dedup": op10_embedding_dedup, "op11_prefix_trie": op11_prefix_trie,
    "op12_repair": op12_repair, "op13_packing": op13_packing,
    "shard_small": shard_small,
}

ORACLE_SQL: dict[str, str] = {
    "op3_sharding": _shards_sql(SHARD_BYTES), "op4_topk": TOP_K_SQL, "shard_small": _shards_sql(SMALL_SHARD_BYTES),
    "op11_prefix_trie": PREFIX_TRIE_SQL,
}
