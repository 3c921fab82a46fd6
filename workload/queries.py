"""Registered queries: one callable per operator, flat results with named columns."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.text import (
    char_length, estimate_tokens, keywords, sentences, strip)
from tidegate.operators import conversations as conv
from tidegate.operators import guard, links, sft, tickets
from tidegate.operators.answer import answer_queries
from tidegate.operators.chunking import chunk_documents
from tidegate.operators.dense import dense_knn
from tidegate.operators.retrieval import retrieve, retrieval_report
from tidegate.operators.blockmax import BlockMaxima, block_maxima, retrieve_blockmax
from tidegate.operators.numbering import number_rows
from tidegate.operators.phrases import listed_phrases
from tidegate.operators.segments import add_segment, merge_segments
from tidegate.operators.tfidf import TextIndex, build_index
from tidegate.plans.crawl import screened_frontier, write_link_payloads
from tidegate.plans.guarded_rag import guarded_rag
from tidegate.sources.jsonl import (
    CHATML_SCHEMA, output_manifest, read_alpaca, read_chatml, read_payloads, write_jsonl)
from tidegate.sources.split_csv import read_split_csv
from tidegate.sources.tickets_csv import null_na_tokens, read_tickets
from tidegate.storage import new_path
from tidegate.streaming.queries import read_query_stream, start_guarded_rag, start_guardrail
from workload.views import table, view, view_over

_indexes: dict[tuple[str, str], TextIndex] = {}


def index_of(spark: SparkSession, sf_dir: str) -> TextIndex:
    """The TF-IDF index over ``documents``, stored once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _indexes:
        _indexes[key] = build_index(table(spark, sf_dir, "documents"))
    return _indexes[key]


def _tickets(spark, sf_dir):
    return null_na_tokens(view(spark, sf_dir, "tickets"))


def _clean(spark, sf_dir):
    return tickets.clean_tickets(_tickets(spark, sf_dir))


def _benchmark(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query"))


# --- text and tickets -----------------------------------------------------------------
def text_measures(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", char_length(text).alias("chars"), estimate_tokens(text).alias("tokens"),
        F.size(sentences(strip(text))).cast("bigint").alias("n_sentences"))


def query_keywords(spark, sf_dir):
    return (_benchmark(spark, sf_dir)
            .select("query_id", F.explode(keywords(F.col("query"))).alias("keyword")))


def sanitise_fields(spark, sf_dir):
    return tickets.sanitise_fields(_tickets(spark, sf_dir))


def validate_clean(spark, sf_dir):
    return _clean(spark, sf_dir)


def validate_rejected(spark, sf_dir):
    return tickets.rejected_tickets(_tickets(spark, sf_dir)).withColumn(
        "failed_columns", F.array_join("failed_columns", ","))


def validation_report(spark, sf_dir):
    return tickets.validation_report(_tickets(spark, sf_dir))


def column_errors(spark, sf_dir):
    return tickets.column_errors(_tickets(spark, sf_dir))


# --- training records -----------------------------------------------------------------
def chatml_messages(spark, sf_dir):
    return sft.explode_messages(sft.to_chatml(_clean(spark, sf_dir), ("ticket_id",)), "ticket_id")


def alpaca_records(spark, sf_dir):
    return sft.to_alpaca(_clean(spark, sf_dir), ("ticket_id",))


def multiturn_chatml(spark, sf_dir):
    return sft.flat_messages(view(spark, sf_dir, "conversations_sparse"))


def multiturn_records(spark, sf_dir):
    """The nested form, one record per conversation, read back flat."""
    records = sft.conversations_to_chatml(view(spark, sf_dir, "conversations_sparse"))
    return sft.explode_messages(records, "conv_id")


def sft_stats(spark, sf_dir):
    clean = _clean(spark, sf_dir)
    return sft.both_stats(sft.to_chatml(clean), sft.to_alpaca(clean)).select(
        "format", "row_count", *[F.round(c, 6).alias(c) for c in _AVERAGES])


_AVERAGES = ("avg_prompt_chars", "avg_completion_chars", "avg_prompt_tokens",
             "avg_completion_tokens")


def stats_by_group(spark, sf_dir):
    pairs = table(spark, sf_dir, "documents").select(
        "lang", F.col("text").alias("prompt"), F.col("source").alias("completion"))
    return sft.dataset_stats(pairs, "lang").select(
        "lang", "row_count", *[F.round(c, 6).alias(c) for c in _AVERAGES])


def stats_by_category(spark, sf_dir):
    records = sft.to_chatml(_clean(spark, sf_dir), ("issue_category",))
    return sft.dataset_stats(sft.chatml_pairs(records, ("issue_category",)), "issue_category").select(
        "issue_category", "row_count", *[F.round(c, 6).alias(c) for c in _AVERAGES])


def jsonl_roundtrip(spark, sf_dir):
    path = new_path(spark, "alpaca")
    write_jsonl(sft.to_alpaca(_clean(spark, sf_dir)), path)
    return read_alpaca(spark, path)


def chatml_roundtrip(spark, sf_dir):
    path = new_path(spark, "chatml")
    write_jsonl(sft.to_chatml(_clean(spark, sf_dir)), path)
    return sft.chatml_pairs(read_chatml(spark, path))


def manifest(spark, sf_dir):
    paths = {"chatml": new_path(spark, "chatml"), "alpaca": new_path(spark, "alpaca")}
    clean = _clean(spark, sf_dir)
    records = {"chatml": write_jsonl(sft.to_chatml(clean), paths["chatml"]),
               "alpaca": write_jsonl(sft.to_alpaca(clean), paths["alpaca"])}
    return output_manifest(spark, paths, records).select(
        "dataset", "records", (F.col("files") > 0).alias("has_files"), (F.col("bytes") > 0).alias("has_bytes"))


def record_preview(spark, sf_dir):
    records = sft.to_chatml(_clean(spark, sf_dir), ("ticket_id",))
    shown = sft.preview(records, "ticket_id", n=3).select(
        "ticket_id", F.from_json("record", CHATML_SCHEMA)["messages"].alias("messages"))
    return sft.explode_messages(shown, "ticket_id")


def _tickets_as_csv(spark, sf_dir) -> str:
    """Tickets written as CSV files with a header, every seventh conversation with a field too many."""
    path = new_path(spark, "tickets-csv")
    fields = [F.concat(F.lit('"'), F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
              for c in tickets.REQUIRED_COLUMNS]
    line = F.concat_ws(",", *fields, F.when(F.col("issue_category") == "Billing", F.lit('"one, too many"')))

    def under_a_header(batches):
        header = ",".join(tickets.REQUIRED_COLUMNS)
        for batch in batches:
            if header and len(batch):
                yield pd.DataFrame({"value": [header]})
                header = ""
            yield batch

    rows = view(spark, sf_dir, "tickets").select(line.alias("value"))
    rows.repartition(3).mapInPandas(under_a_header, "value string").write.text(path)
    return path


def _tickets_found(found: DataFrame, overlong: DataFrame) -> DataFrame:
    keyed = overlong.select(F.regexp_extract("raw", '^"([^"]*)"', 1).alias("ticket_id"))
    return (found.select(*tickets.REQUIRED_COLUMNS, F.lit(False).alias("overlong"))
            .unionByName(keyed.withColumn("overlong", F.lit(True)), allowMissingColumns=True))


def numbered_documents(spark, sf_dir):
    """Every document numbered by length (longest first), then id, text, language and source."""
    docs = table(spark, sf_dir, "documents")
    order = [F.col("n_chars").desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in ("doc_id", "text", "lang", "source")]]
    return number_rows(docs, *order).select("row_no", "doc_id", "n_chars")


def tickets_csv(spark, sf_dir):
    """Tickets written as CSV, every seventh conversation with a field too many, and read back."""
    return _tickets_found(*read_tickets(spark, _tickets_as_csv(spark, sf_dir)))


def tickets_csv_split(spark, sf_dir):
    """The same files read in byte ranges of 64 KB: record ends found by quote parity."""
    return _tickets_found(*read_split_csv(spark, _tickets_as_csv(spark, sf_dir), range_bytes=64 * 1024))


# --- guardrails -----------------------------------------------------------------------
def _flat(df: DataFrame, result: str, *keys: str) -> DataFrame:
    return df.select(*keys, *[F.col(f"{result}.{f}").alias(f) for f in (
        "passed", "violation_type", "matched_pattern", "message")])


def input_guardrail(spark, sf_dir):
    return _flat(guard.guard_queries(view(spark, sf_dir, "prompts")), "input_guardrail", "query_id")


def guardrail_summary(spark, sf_dir):
    prompts = guard.guard_queries(view(spark, sf_dir, "prompts"))
    answers = guard.guard_answers(view(spark, sf_dir, "answers"))
    return guard.violation_summary(prompts, {"input": "input_guardrail"}).unionByName(
        guard.violation_summary(answers, {"output": "output_guardrail"}))


def phrase_table(spark, sf_dir) -> DataFrame:
    """The fixed toxic phrases at places 0 to 3, then every word pair of ``benchmark`` at its first place."""
    fixed = spark.createDataFrame(list(enumerate(guard.TOXIC_PHRASES)), "place long, phrase string")
    words = F.filter(F.split(F.lower("text"), "[ \t\n\r]+"), lambda w: w != "")
    pairs = F.when(F.size("w") >= 2, F.transform(F.sequence(F.lit(0), F.size("w") - 2), lambda i: F.struct(
        i.alias("i"), F.concat(F.col("w")[i], F.lit(" "), F.col("w")[i + 1]).alias("phrase"))))
    found = (table(spark, sf_dir, "benchmark").where(F.col("item_id").isNotNull())
             .select("item_id", words.alias("w")).select("item_id", F.explode(pairs).alias("p"))
             .groupBy(F.col("p.phrase").alias("phrase"))
             .agg((F.min(F.col("item_id") * 1_000_000 + F.col("p.i")) + 4).alias("place")))
    return fixed.unionByName(found.select("place", "phrase"))


def toxic_phrase_table(spark, sf_dir):
    """Every document against a phrase table from ``benchmark``: the phrase of the smallest place."""
    return listed_phrases(table(spark, sf_dir, "documents"), phrase_table(spark, sf_dir))


def guardrail_rollup(spark, sf_dir):
    """Violations by stage, type and source (the role of a prompt, the source of a document), with subtotals."""
    prompts = guard.guard_queries(view(spark, sf_dir, "prompts")).withColumnRenamed("role", "source")
    answers = guard.guard_answers(view(spark, sf_dir, "answers"))
    return guard.violation_rollup({"input": (prompts, "input_guardrail"), "output": (answers, "output_guardrail")})


def output_guardrail(spark, sf_dir):
    return _flat(guard.guard_answers(view(spark, sf_dir, "answers")), "output_guardrail", "doc_id")


def corpus_scrub(spark, sf_dir):
    return guard.screen_corpus(table(spark, sf_dir, "documents")).select(
        "doc_id", "clean",
        F.col("input_check.violation_type").alias("input_violation"),
        F.col("output_check.violation_type").alias("output_violation"),
        F.col("output_check.matched_pattern").alias("matched_pattern"))


# --- retrieval ------------------------------------------------------------------------
def chunks(spark, sf_dir):
    return chunk_documents(table(spark, sf_dir, "documents"))


def term_idf(spark, sf_dir):
    return index_of(spark, sf_dir).vocab.select("term", "df", F.round("idf", 6).alias("idf"))


def chunk_weights(spark, sf_dir):
    return index_of(spark, sf_dir).postings.select(
        "doc_id", "chunk_no", "term", F.col("tf").cast("bigint").alias("tf"),
        F.round("weight", 6).alias("weight"))


def chunk_weights_segments(spark, sf_dir):
    """The weights of ``chunk_weights`` from an index grown by three segments, added out of order."""
    docs = table(spark, sf_dir, "documents")
    path = new_path(spark, "segmented-index")
    for part in (2, 0, 1):
        add_segment(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(3)) == part), path)
    return merge_segments(spark, path).postings.select(
        "doc_id", "chunk_no", "term", F.col("tf").cast("bigint").alias("tf"), F.round("weight", 6).alias("weight"))


def _topk(spark, sf_dir, **options):
    ranked = retrieve(_benchmark(spark, sf_dir), index_of(spark, sf_dir), **options)
    return ranked.withColumn("rank", F.col("rank").cast("bigint")).withColumn(
        "distance", F.round("distance", 6))


def retrieve_topk(spark, sf_dir):
    return _topk(spark, sf_dir)


_maxima: dict[tuple[str, str], BlockMaxima] = {}


def maxima_of(spark: SparkSession, sf_dir: str) -> BlockMaxima:
    """Block maxima of the index over ``documents``, stored once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _maxima:
        _maxima[key] = block_maxima(index_of(spark, sf_dir))
    return _maxima[key]


def retrieve_topk_blockmax(spark, sf_dir):
    """The same answers, scoring only the blocks whose bound reaches each query's threshold."""
    ranked, _ = retrieve_blockmax(_benchmark(spark, sf_dir), index_of(spark, sf_dir), maxima_of(spark, sf_dir))
    return ranked.withColumn("rank", F.col("rank").cast("bigint")).withColumn("distance", F.round("distance", 6))


def retrieve_topk_terms(spark, sf_dir):
    """The same answers from the postings of the query terms, however many match."""
    return _topk(spark, sf_dir, few=float("inf"))


def retrieve_topk_chunks(spark, sf_dir):
    """The same answers from the chunk vectors, however few terms match."""
    return _topk(spark, sf_dir, few=-1.0)


def retrieval_summary(spark, sf_dir):
    ranked = retrieve(_benchmark(spark, sf_dir), index_of(spark, sf_dir))
    return retrieval_report(ranked).select(
        "query_id", "k", *[F.round(c, 6).alias(c) for c in (
            "min_distance", "avg_distance", "max_distance")])


def _knn(spark, sf_dir, **options):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return (dense_knn(vectors, vectors.withColumnRenamed("vec_id", "query_id"), **options)
            .select("query_id", F.col("rank").cast("bigint").alias("rank"), "vec_id",
                    F.round("distance", 6).alias("distance")))


def knn(spark, sf_dir):
    return _knn(spark, sf_dir)


def knn_slices(spark, sf_dir):
    """The same search with slices so small that there are several at every scale."""
    return _knn(spark, sf_dir, slice_bytes=64 * 1024)


def extractive_answer(spark, sf_dir):
    queries, index = _benchmark(spark, sf_dir), index_of(spark, sf_dir)
    answered = answer_queries(queries, retrieve(queries, index), index.chunks)
    return answered.select("query_id", "answer",
                           F.size("retrieved_chunks").cast("bigint").alias("n_chunks"))


def _flat_responses(responses: DataFrame) -> DataFrame:
    return responses.select(
        "query_id", "blocked", "answer",
        F.array_join("retrieved_chunks", "|").alias("chunks"),
        F.col("input_guardrail.violation_type").alias("input_violation"),
        F.col("output_guardrail.passed").alias("output_passed"),
        F.col("output_guardrail.violation_type").alias("output_violation"))


def guarded_rag_responses(spark, sf_dir):
    return _flat_responses(guarded_rag(view(spark, sf_dir, "prompts"), index_of(spark, sf_dir)))


# --- links ----------------------------------------------------------------------------
def page_links(spark, sf_dir):
    return (links.page_links(view(spark, sf_dir, "pages_x"))
            .select("page_id", F.posexplode("links").alias("_pos", "target"))
            .select("page_id", (F.col("_pos") + 1).cast("bigint").alias("position"), "target"))


def link_edges(spark, sf_dir):
    return links.host_in_degree(links.link_edges(view(spark, sf_dir, "pages_x")))


def link_payload(spark, sf_dir):
    return links.link_payload(view(spark, sf_dir, "pages_x")).withColumn(
        "links", F.array_join("links", "|"))


def payload_roundtrip(spark, sf_dir):
    path = new_path(spark, "payloads")
    write_link_payloads(view(spark, sf_dir, "pages_x"), path)
    return read_payloads(spark, path).withColumn("links", F.array_join("links", "|"))


def url_screen(spark, sf_dir):
    return links.screen_urls(view(spark, sf_dir, "urls_x"), view(spark, sf_dir, "host_ips")).select(
        "url_id", "host", "verdict")


def crawl_frontier(spark, sf_dir):
    return screened_frontier(view(spark, sf_dir, "pages_x"), view(spark, sf_dir, "host_ips")).select(
        "url", "verdict")


# --- conversations --------------------------------------------------------------------
def conversation_truncate(spark, sf_dir):
    return conv.truncate_conversations(view(spark, sf_dir, "conversations_x")).select("conv_id", "turn")


def conversation_outcome(spark, sf_dir):
    return conv.conversation_outcome(view(spark, sf_dir, "conversations_x"))


# --- streams --------------------------------------------------------------------------
def _prompt_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "conversations").schema
    # a glob, because a plain stream path has to be a folder and the table may be one file
    stream = read_query_stream(spark, f"{sf_dir}/conversations.parque[t]", schema)
    return view_over("prompts", conversations=stream)


def stream_guardrail(spark, sf_dir):
    out = new_path(spark, "guarded-stream")
    start_guardrail(_prompt_stream(spark, sf_dir), out, f"{out}-progress").awaitTermination()
    return _flat(spark.read.parquet(out), "input_guardrail", "query_id")


def stream_rag(spark, sf_dir):
    out = new_path(spark, "rag-stream")
    start_guarded_rag(_prompt_stream(spark, sf_dir), index_of(spark, sf_dir), out,
                      f"{out}-progress").awaitTermination()
    return _flat_responses(spark.read.parquet(out))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "text_measures": text_measures,
    "query_keywords": query_keywords,
    "sanitise_fields": sanitise_fields,
    "validate_clean": validate_clean,
    "validate_rejected": validate_rejected,
    "validation_report": validation_report,
    "column_errors": column_errors,
    "chatml_messages": chatml_messages,
    "alpaca_records": alpaca_records,
    "multiturn_chatml": multiturn_chatml,
    "multiturn_records": multiturn_records,
    "sft_stats": sft_stats,
    "stats_by_group": stats_by_group,
    "stats_by_category": stats_by_category,
    "jsonl_roundtrip": jsonl_roundtrip,
    "chatml_roundtrip": chatml_roundtrip,
    "output_manifest": manifest,
    "record_preview": record_preview,
    "tickets_csv": tickets_csv,
    "input_guardrail": input_guardrail,
    "guardrail_summary": guardrail_summary,
    "output_guardrail": output_guardrail,
    "corpus_scrub": corpus_scrub,
    "chunks": chunks,
    "term_idf": term_idf,
    "chunk_weights": chunk_weights,
    "retrieve_topk": retrieve_topk,
    "retrieve_topk_terms": retrieve_topk_terms,
    "retrieve_topk_blockmax": retrieve_topk_blockmax,
    "chunk_weights_segments": chunk_weights_segments,
    "tickets_csv_split": tickets_csv_split,
    "toxic_phrase_table": toxic_phrase_table,
    "guardrail_rollup": guardrail_rollup,
    "numbered_documents": numbered_documents,
    "retrieve_topk_chunks": retrieve_topk_chunks,
    "retrieval_report": retrieval_summary,
    "dense_knn": knn,
    "dense_knn_slices": knn_slices,
    "extractive_answer": extractive_answer,
    "guarded_rag": guarded_rag_responses,
    "page_links": page_links,
    "link_edges": link_edges,
    "link_payload": link_payload,
    "payload_roundtrip": payload_roundtrip,
    "url_screen": url_screen,
    "crawl_frontier": crawl_frontier,
    "conversation_truncate": conversation_truncate,
    "conversation_outcome": conversation_outcome,
    "stream_guardrail": stream_guardrail,
    "stream_rag": stream_rag,
}
