"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

import re

from tidegate.operators import guard, sft, tickets
from tidegate.sources.tickets_csv import NA_TOKENS
from workload.views import view_sql

# RE2 spellings of Unicode whitespace and word characters
WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
NWS = r"[^\s\x0b\x1c-\x1f\x85\p{Z}]"
WORD = r"[\p{L}\p{N}_]"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def _regex(pattern: str, ignore_case: bool = True) -> str:
    classes = {r"\S": NWS, r"\s": WS, r"\d": r"\p{Nd}"}
    pattern = re.sub(r"\\.", lambda m: classes.get(m.group(0), m.group(0)), pattern)
    return quoted(("(?i)" if ignore_case else "") + pattern)


# --- the library's fixed values in RE2 form ---------------------------------------------
INJECTIONS = [(d.kind, d.label, _regex(d.pattern, d.ignore_case)) for d in guard.INJECTION_CATALOGUE]
PHRASES = guard.TOXIC_PHRASES


def _leak(d: guard.Detector) -> tuple[str, int]:
    """Pattern and the group that holds the match. RE2 has an ASCII word boundary only: it is
    spelled out, but for card numbers, where it makes no difference on this data."""
    if d.kind == "ssn":
        digits = d.pattern.removeprefix(r"\b").removesuffix(r"\b").replace(r"\d", "[0-9]")
        return _regex(rf"(^|[^\p{{L}}\p{{N}}_])({digits})($|[^\p{{L}}\p{{N}}_])", False), 2
    return _regex(d.pattern, d.ignore_case), 0


LEAKS = [_leak(d) for d in guard.LEAK_CATALOGUE]
SYSTEM, INSTRUCTION, NA = sft.SYSTEM_MESSAGE, sft.ALPACA_INSTRUCTION, NA_TOKENS
FIELDS = list(tickets.REQUIRED_COLUMNS)


def sanitised(c: str) -> str:
    no_control = rf"regexp_replace({strip(c)}, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g')"
    return rf"regexp_replace(nfc_normalize({no_control}), '\n{{3,}}', chr(10) || chr(10), 'g')"


def blank(c: str) -> str:
    return f"({c} IS NULL OR {strip(c)} = '')"


def tokens(c: str) -> str:
    return f"greatest(1, length({c}) // 4)"


def stripped_bad(columns=FIELDS) -> str:
    return " OR ".join(blank(c) for c in columns)


CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, body: str, *needs: str) -> None:
    CTES[name] = (needs, body)


def sql(body: str, *needs: str) -> str:
    """``body`` behind the CTEs it needs, each after its own needs."""
    order: list[str] = []

    def visit(name: str) -> None:
        for other in CTES[name][0]:
            visit(other)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    listed = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n][1]})" for n in order)
    return f"WITH {listed}\n{body}" if order else body


for _view in ("prompts", "answers", "tickets", "pages_x", "conversations_x",
              "conversations_sparse", "urls_x", "host_ips"):
    cte(_view, view_sql(_view))

# --- tickets --------------------------------------------------------------------------
_na = ", ".join(map(quoted, NA))
cte("raw", "SELECT " + ", ".join(
    f"CASE WHEN {c} IN ({_na}) THEN NULL ELSE {c} END AS {c}" for c in FIELDS) + " FROM tickets",
    "tickets")
cte("clean", "SELECT " + ", ".join(f"{sanitised(c)} AS {c}" for c in FIELDS)
    + f" FROM raw WHERE NOT ({stripped_bad()})", "raw")
_user = ("customer_query || chr(10) || chr(10) || '[Support Context — Issue Category: ' || "
         "issue_category || ' | Ticket: ' || ticket_id || ' | Agent Notes: ' || agent_context || ']'")
_input = ("'Issue Category: ' || issue_category || chr(10) || 'Ticket ID: ' || ticket_id || chr(10) "
          "|| 'Customer Query: ' || customer_query || chr(10) || 'Agent Context: ' || agent_context")
cte("chatml_pairs", f"SELECT issue_category, {quoted(SYSTEM)} || ' ' || {_user} AS prompt, "
    "verified_resolution AS completion FROM clean", "clean")
cte("alpaca", f"SELECT ticket_id, {quoted(INSTRUCTION)} AS instruction, {_input} AS input, "
    "verified_resolution AS output FROM clean", "clean")


def averages(prompt: str, completion: str) -> str:
    return ", ".join(
        f"round(coalesce(avg({m(t)}), 0.0), 6) AS avg_{n}_{u}"
        for u, m in (("chars", lambda t: f"length({t})"), ("tokens", tokens))
        for n, t in (("prompt", prompt), ("completion", completion)))


# --- guardrails -----------------------------------------------------------------------
def input_check(c: str) -> dict[str, str]:
    """SQL of violation type, fragment and message for a prompt."""
    def case(value, otherwise: str) -> str:
        arms = " ".join(f"WHEN regexp_matches({c}, {p}) THEN {value(k, lab, p)}" for k, lab, p in INJECTIONS)
        return f"CASE {arms} ELSE {otherwise} END"

    nl = "chr(10)"
    return {
        "kind": case(lambda k, lab, p: quoted(k), "NULL"),
        "match": case(lambda k, lab, p: f"regexp_extract({c}, {p}, 0)", "NULL"),
        "message": case(
            lambda k, lab, p: f"'🚨 SECURITY VIOLATION DETECTED' || {nl} || '   Type    : {lab}' || {nl} "
            f"|| '   Fragment: ''' || regexp_extract({c}, {p}, 0) || '''' || {nl} "
            "|| '   Action  : Query halted. No retrieval or generation performed.'",
            "'✅ Input guardrail PASSED'"),
    }


def output_check(c: str) -> dict[str, str]:
    """SQL of violation type, fragment and message for an answer."""
    def case(toxic, leak, otherwise: str) -> str:
        arms = [f"WHEN contains(lower({c}), {quoted(p)}) THEN {toxic(p)}" for p in PHRASES]
        arms += [f"WHEN regexp_matches({c}, {p}) THEN {leak(f'substr(regexp_extract({c}, {p}, {g}), 1, 20)')}"
                 for p, g in LEAKS]
        return f"CASE {' '.join(arms)} ELSE {otherwise} END"

    nl = "chr(10)"
    return {
        "kind": case(lambda p: "'toxicity'", lambda m: "'credential_leakage'", "NULL"),
        "match": case(quoted, lambda m: f"{m} || '…'", "NULL"),
        "message": case(
            lambda p: f"'⛔ OUTPUT BLOCKED: Toxic content detected (''{p}'').' || {nl} "
            "|| '   The response has been suppressed to protect users.'",
            lambda m: f"'⛔ OUTPUT BLOCKED: Credential / PII leakage detected.' || {nl} "
            f"|| '   Pattern matched: ''' || {m} || '…''' || {nl} "
            "|| '   The response has been suppressed for security.'",
            "'✅ Output guardrail PASSED'"),
    }


_in, _out = input_check("query"), output_check("answer")
cte("prompts_checked", f"SELECT query_id, query, {_in['kind']} AS kind, {_in['match']} AS match, "
    f"{_in['message']} AS message FROM prompts", "prompts")
cte("answers_checked", f"SELECT doc_id, {_out['kind']} AS kind, {_out['match']} AS match, "
    f"{_out['message']} AS message FROM answers", "answers")
_FLAT = "kind IS NULL AS passed, kind AS violation_type, match AS matched_pattern, message"

# --- retrieval ------------------------------------------------------------------------
cte("chunk_rows", f"""
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS chunk_no, chunk
FROM (SELECT doc_id, i, {strip('substr(text, CAST(i * 240 + 1 AS BIGINT), 300)')} AS chunk
      FROM documents, unnest(range(0, (length(text) + 239) // 240)) AS u(i)) AS w
WHERE chunk <> ''""")
cte("chunk_words", f"SELECT doc_id, chunk_no, regexp_extract_all(lower(chunk), '{WORD}{{2,}}') AS w "
    "FROM chunk_rows", "chunk_rows")
cte("tf", """
SELECT doc_id, chunk_no, term, count(*) AS tf FROM (
 SELECT doc_id, chunk_no, unnest(w) AS term FROM chunk_words
 UNION ALL
 SELECT doc_id, chunk_no, w[i] || ' ' || w[i + 1] FROM chunk_words, unnest(range(1, len(w))) AS u(i)
) AS t GROUP BY ALL""", "chunk_words")
cte("vocab", """
SELECT term, count(*) AS df,
 ln((1.0 + (SELECT count(*) FROM chunk_rows)) / (1 + count(*))) + 1 AS idf
FROM tf GROUP BY term""", "chunk_rows", "tf")
cte("weights", """
SELECT doc_id, chunk_no, term, tf, v / sqrt(sum(v * v) OVER (PARTITION BY doc_id, chunk_no)) AS weight
FROM (SELECT tf.*, (1 + ln(tf)) * idf AS v FROM tf JOIN vocab USING (term)) AS x""", "tf", "vocab")


def search_ctes(prefix: str, source: str, *needs: str) -> None:
    """CTEs ``<prefix>top`` and ``<prefix>answers`` for queries ``(query_id, query)``."""
    p = prefix
    cte(f"{p}words", f"SELECT query_id, regexp_extract_all(lower(query), '{WORD}{{2,}}') AS w "
        f"FROM ({source}) AS s", *needs)
    cte(f"{p}tf", f"""
SELECT query_id, term, count(*) AS tf FROM (
 SELECT query_id, unnest(w) AS term FROM {p}words
 UNION ALL
 SELECT query_id, w[i] || ' ' || w[i + 1] FROM {p}words, unnest(range(1, len(w))) AS u(i)
) AS t GROUP BY ALL""", f"{p}words")
    cte(f"{p}weights", f"""
SELECT query_id, term, v / sqrt(sum(v * v) OVER (PARTITION BY query_id)) AS weight
FROM (SELECT query_id, term, (1 + ln(tf)) * idf AS v FROM {p}tf JOIN vocab USING (term)) AS x""",
        f"{p}tf", "vocab")
    cte(f"{p}scores", f"""
SELECT query_id, doc_id, chunk_no, round(1 - sum(q.weight * c.weight), 9) AS distance
FROM {p}weights AS q JOIN weights AS c USING (term) GROUP BY ALL
UNION ALL
SELECT query_id, doc_id, chunk_no, 1.0 FROM ({source}) AS s,
 (SELECT doc_id, chunk_no FROM chunk_rows ORDER BY ALL LIMIT 3) AS f""",
        f"{p}weights", "weights", "chunk_rows", *needs)
    cte(f"{p}top", f"""
SELECT * FROM (
 SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, doc_id, chunk_no) AS rank
 FROM (SELECT query_id, doc_id, chunk_no, min(distance) AS distance FROM {p}scores GROUP BY ALL) AS m
) AS r WHERE rank <= 3""", f"{p}scores")
    cte(f"{p}context", f"""
SELECT query_id, any_value(query) AS query, count(*) AS n_chunks,
 string_agg(chunk, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS context,
 string_agg(chunk, '|' ORDER BY rank) AS chunks
FROM {p}top JOIN chunk_rows USING (doc_id, chunk_no) JOIN ({source}) AS s USING (query_id)
GROUP BY query_id""", f"{p}top", "chunk_rows", *needs)
    cte(f"{p}sentences", f"""
SELECT query_id, pos, sentence, len(list_filter(kws, lambda k: contains(lower(sentence), k))) AS score
FROM (SELECT query_id, kws, unnest(sents) AS sentence, generate_subscripts(sents, 1) AS pos
 FROM (SELECT query_id, list_distinct(regexp_extract_all(lower(query), '{WORD}{{4,}}')) AS kws,
  string_split(regexp_replace(context, '([.!?]){WS}+', '\\1' || chr(1), 'g'), chr(1)) AS sents
  FROM {p}context) AS a) AS b""", f"{p}context")
    source_line = "chr(10) || chr(10) || '[Source: Policy Knowledge Base | Fallback Engine]'"
    cte(f"{p}answers", f"""
SELECT query_id, n_chunks, chunks, CASE WHEN score > 0
 THEN 'Based on corporate policy:' || chr(10) || chr(10) || {strip('sentence')} || {source_line}
 ELSE 'Based on the retrieved policy context, here is the relevant information:' || chr(10) || chr(10)
  || {strip('substr(context, 1, 600)')} || {source_line} END AS answer
FROM {p}context JOIN (
 SELECT query_id, sentence, score FROM {p}sentences
 QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, pos) = 1) AS b USING (query_id)""",
        f"{p}context", f"{p}sentences")


search_ctes("b_", "SELECT item_id AS query_id, text AS query FROM benchmark")
search_ctes("p_", "SELECT query_id, query FROM prompts_checked WHERE kind IS NULL", "prompts_checked")
_NOTICE = "'⚠️  The generated response was blocked by the output safety filter.' || chr(10) || "
_RAG = f"""
SELECT query_id, out_kind IS NOT NULL AS blocked,
 CASE WHEN out_kind IS NULL THEN answer ELSE {_NOTICE} out_message END AS answer, chunks,
 CAST(NULL AS VARCHAR) AS input_violation, out_kind IS NULL AS output_passed, out_kind AS output_violation
FROM (SELECT *, {_out['kind']} AS out_kind, {_out['message']} AS out_message FROM p_answers) AS a
UNION ALL
SELECT query_id, TRUE, message, '', kind, NULL, NULL FROM prompts_checked WHERE kind IS NOT NULL"""

# --- links ----------------------------------------------------------------------------
_HREF = _regex(r"""<a\s[^>]*?href=["']([^"']+)["']""")
_PATH = "regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1)"
cte("refs", f"""
SELECT page_id, url, pos, {strip('href')} AS ref,
 regexp_extract(url, '^(https?://[^/?#]*)', 1) AS site,
 CASE WHEN contains({_PATH}, '/') THEN regexp_extract({_PATH}, '^(.*/)', 1) ELSE '/' END AS folder
FROM (SELECT page_id, url, unnest(h) AS href, generate_subscripts(h, 1) AS pos
 FROM (SELECT page_id, url, regexp_extract_all(html, {_HREF}, 1) AS h FROM pages_x) AS a) AS b""",
    "pages_x")
cte("targets", r"""
SELECT page_id, url, min(pos) AS pos, target FROM (
 SELECT page_id, url, pos, CASE
  WHEN regexp_matches(ref, '^https?://') THEN ref
  WHEN starts_with(ref, '//') THEN regexp_extract(url, '^(https?:)', 1) || ref
  WHEN starts_with(ref, '/') THEN site || ref
  WHEN starts_with(ref, '../') THEN site || regexp_replace(folder, '[^/]+/$', '') || substr(ref, 4)
 END AS target
 FROM refs WHERE ref <> '' AND NOT regexp_matches(ref, '^(#|javascript:|mailto:|tel:)')) AS r
GROUP BY page_id, url, target""", "refs")
_HOST = r"lower(regexp_extract(target, '^https?://([^/?#:]*)', 1))"
cte("page_lists", """
SELECT page_id, url, coalesce(count(target), 0) AS link_count,
 coalesce(string_agg(target, '|' ORDER BY pos), '') AS links
FROM pages_x LEFT JOIN targets USING (page_id, url) GROUP BY page_id, url""", "pages_x", "targets")


def screened(source: str) -> str:
    """Host and verdict for rows ``(id, url)``."""
    return rf"""
SELECT u.id, u.url, u.host, CASE
 WHEN scheme NOT IN ('http', 'https') THEN 'unsupported_scheme'
 WHEN netloc = '' THEN 'no_host'
 WHEN u.host = '' THEN 'no_hostname'
 WHEN starts_with(address, '::ffff:') THEN 'mapped_ipv4'
 WHEN address IS NULL OR regexp_matches(address, '^(10|127|0)\.|^192\.168\.|^169\.254\.|^::1$|^f[cd][0-9a-f]{{2}}:')
  OR (starts_with(address, '172.') AND CAST(split_part(address, '.', 2) AS INT) BETWEEN 16 AND 31)
 THEN 'ssrf_blocked' ELSE 'ok' END AS verdict
FROM (SELECT h.*, CASE WHEN regexp_matches(h.host, '^[0-9.]+$') OR contains(h.host, ':') THEN h.host ELSE ip END AS address
 FROM (SELECT *, lower(CASE WHEN starts_with(hp, '[') THEN regexp_extract(hp, '^\[([^\]]*)', 1)
   ELSE regexp_extract(hp, '^([^:]*)', 1) END) AS host
  FROM (SELECT *, regexp_extract(netloc, '([^@]*)$', 1) AS hp
   FROM (SELECT *, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) AS scheme,
     regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1) AS netloc FROM ({source}) AS s) AS a) AS b) AS h
 LEFT JOIN host_ips ON h.host = host_ips.host) AS u"""


# --- conversations --------------------------------------------------------------------
cte("kept_turns", """
SELECT conv_id, turn, text FROM (
 SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS round,
  min(CASE WHEN contains(text, 'TERMINATE') THEN turn END) OVER (PARTITION BY conv_id) AS last_turn
 FROM conversations_x) AS c
WHERE round <= 20 AND (last_turn IS NULL OR turn <= last_turn)""", "conversations_x")


def _first(marker: str, name: str) -> str:
    return f"min(CASE WHEN contains(text, {quoted(marker)}) THEN turn END) AS {name}"


ORACLE_SQL: dict[str, str] = {
    "text_measures": f"""
SELECT doc_id, length(text) AS chars, {tokens('text')} AS tokens,
 len(string_split(regexp_replace({strip('text')}, '([.!?]){WS}+', '\\1' || chr(1), 'g'), chr(1))) AS n_sentences
FROM documents""",
    "query_keywords": f"""
SELECT DISTINCT item_id AS query_id, unnest(regexp_extract_all(lower(text), '{WORD}{{4,}}')) AS keyword
FROM benchmark""",
    "sanitise_fields": sql(
        "SELECT " + ", ".join(f"{sanitised(f'coalesce({c}, {quoted(str())})')} AS {c}" for c in FIELDS)
        + " FROM raw", "raw"),
    "validate_clean": sql("SELECT * FROM clean", "clean"),
    "validate_rejected": sql(
        f"SELECT *, concat_ws(',', {', '.join(f'CASE WHEN {blank(c)} THEN {quoted(c)} END' for c in FIELDS)}) "
        f"AS failed_columns FROM raw WHERE {stripped_bad()}", "raw"),
    "validation_report": sql(f"""
SELECT count(*) AS total_rows, count(*) FILTER (WHERE NOT ({stripped_bad()})) AS valid_rows,
 count(*) FILTER (WHERE {stripped_bad()}) AS invalid_rows,
 CAST(sum({' + '.join(f'CAST({blank(c)} AS BIGINT)' for c in FIELDS)}) AS BIGINT) AS null_field_errors,
 5 * count(*) AS sanitised_fields,
 CAST(sum({' + '.join(f'CAST(coalesce({sanitised(c)} <> {c}, FALSE) AS BIGINT)' for c in FIELDS)}) AS BIGINT) AS changed_fields
FROM raw""", "raw"),
    "column_errors": sql(
        "SELECT * FROM (" + " UNION ALL ".join(
            f"SELECT {quoted(c)} AS column_name, count(*) FILTER (WHERE {blank(c)}) AS n_errors FROM raw"
            for c in FIELDS) + ") AS e WHERE n_errors > 0", "raw"),
    "chatml_messages": sql(f"""
SELECT ticket_id, CAST(1 AS BIGINT) AS position, 'system' AS role, {quoted(SYSTEM)} AS content FROM clean
UNION ALL SELECT ticket_id, 2, 'user', {_user} FROM clean
UNION ALL SELECT ticket_id, 3, 'assistant', verified_resolution FROM clean""", "clean"),
    "alpaca_records": sql("SELECT * FROM alpaca", "alpaca"),
    "multiturn_chatml": sql("""
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS position, role, text AS content
FROM conversations_sparse""", "conversations_sparse"),
    "sft_stats": sql(f"""
SELECT 'chatml' AS format, count(*) AS row_count, {averages('prompt', 'completion')} FROM chatml_pairs
UNION ALL
SELECT 'alpaca', count(*), {averages("instruction || ' ' || input", 'output')} FROM alpaca""",
        "chatml_pairs", "alpaca"),
    "stats_by_group": f"""
SELECT lang, count(*) AS row_count, {averages('text', 'source')} FROM documents GROUP BY lang""",
    "stats_by_category": sql(f"""
SELECT issue_category, count(*) AS row_count, {averages('prompt', 'completion')}
FROM chatml_pairs GROUP BY issue_category""", "chatml_pairs"),
    "jsonl_roundtrip": sql("SELECT instruction, input, output FROM alpaca", "alpaca"),
    "chatml_roundtrip": sql("SELECT prompt, completion FROM chatml_pairs", "chatml_pairs"),
    "input_guardrail": sql(f"SELECT query_id, {_FLAT} FROM prompts_checked", "prompts_checked"),
    "guardrail_summary": sql("""
SELECT 'input' AS stage, coalesce(kind, 'passed') AS violation_type, count(*) AS n
FROM prompts_checked GROUP BY ALL
UNION ALL
SELECT 'output', coalesce(kind, 'passed'), count(*) FROM answers_checked GROUP BY ALL""",
        "prompts_checked", "answers_checked"),
    "output_guardrail": sql(f"SELECT doc_id, {_FLAT} FROM answers_checked", "answers_checked"),
    "corpus_scrub": f"""
SELECT doc_id, i IS NULL AND o IS NULL AS clean, i AS input_violation, o AS output_violation,
 m AS matched_pattern
FROM (SELECT doc_id, {input_check('text')['kind']} AS i, {output_check('text')['kind']} AS o,
 {output_check('text')['match']} AS m FROM documents) AS d""",
    "chunks": sql("SELECT doc_id, chunk_no, chunk FROM chunk_rows", "chunk_rows"),
    "term_idf": sql("SELECT term, df, round(idf, 6) AS idf FROM vocab", "vocab"),
    "chunk_weights": sql(
        "SELECT doc_id, chunk_no, term, tf, round(weight, 6) AS weight FROM weights", "weights"),
    "retrieve_topk": sql(
        "SELECT query_id, rank, doc_id, chunk_no, round(distance, 6) AS distance FROM b_top", "b_top"),
    "retrieval_report": sql("""
SELECT query_id, count(*) AS k, round(min(distance), 6) AS min_distance,
 round(avg(distance), 6) AS avg_distance, round(max(distance), 6) AS max_distance
FROM b_top GROUP BY query_id""", "b_top"),
    "dense_knn": """
SELECT query_id, rank, vec_id, round(distance, 6) AS distance FROM (
 SELECT query_id, vec_id, distance,
  row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank
 FROM (SELECT q.vec_id AS query_id, v.vec_id AS vec_id,
   round(1 - list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])), 9) AS distance
  FROM embeddings AS q, embeddings AS v) AS d) AS r
WHERE rank <= 3""",
    "extractive_answer": sql("SELECT query_id, answer, n_chunks FROM b_answers", "b_answers"),
    "guarded_rag": sql(_RAG, "p_answers", "prompts_checked"),
    "page_links": sql("""
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS position, target
FROM targets""", "targets"),
    "link_edges": sql(f"SELECT {_HOST} AS host, count(*) AS n_edges FROM targets GROUP BY 1", "targets"),
    "link_payload": sql("SELECT url AS source_url, link_count, links FROM page_lists", "page_lists"),
    "url_screen": sql("SELECT id AS url_id, host, verdict FROM ("
                      + screened("SELECT url_id AS id, url FROM urls_x") + ") AS v",
                      "urls_x", "host_ips"),
    "crawl_frontier": sql("SELECT url, verdict FROM ("
                          + screened("SELECT DISTINCT 0 AS id, target AS url FROM targets") + ") AS v",
                          "targets", "host_ips"),
    "conversation_truncate": sql("SELECT conv_id, turn FROM kept_turns", "kept_turns"),
    "conversation_outcome": sql(f"""
SELECT conv_id, terminated_turn, review_passed_turn, approved_turn, n_turns, turns_used,
 NOT ended AND n_turns > turns_used AS capped
FROM (SELECT conv_id, {_first('TERMINATE', 'terminated_turn')},
  {_first('SECURITY REVIEW PASSED', 'review_passed_turn')}, {_first('CODE APPROVED', 'approved_turn')},
  count(*) AS n_turns FROM conversations_x GROUP BY conv_id) AS o
JOIN (SELECT conv_id, count(*) AS turns_used, bool_or(contains(text, 'TERMINATE')) AS ended
 FROM kept_turns GROUP BY conv_id) AS k USING (conv_id)""", "conversations_x", "kept_turns"),
}
_MESSAGES = ORACLE_SQL["chatml_messages"]
ORACLE_SQL |= {
    "output_manifest": sql("""
SELECT dataset, (SELECT count(*) FROM clean) AS records, TRUE AS has_files, TRUE AS has_bytes
FROM (VALUES ('chatml'), ('alpaca')) AS d(dataset)""", "clean"),
    "record_preview": f"""
SELECT * FROM ({_MESSAGES}) AS m
WHERE ticket_id IN (SELECT DISTINCT ticket_id FROM ({_MESSAGES}) AS k ORDER BY ticket_id LIMIT 3)""",
    "tickets_csv": sql(
        "SELECT " + ", ".join(f"CASE WHEN {c} NOT IN ({_na}) THEN {c} END AS {c}" for c in FIELDS)
        + ", FALSE AS overlong FROM tickets WHERE issue_category <> 'Billing' UNION ALL SELECT ticket_id, "
        "NULL, NULL, NULL, NULL, TRUE FROM tickets WHERE issue_category = 'Billing'", "tickets"),
    "payload_roundtrip": ORACLE_SQL["link_payload"],
    "retrieve_topk_terms": ORACLE_SQL["retrieve_topk"],
    "retrieve_topk_blockmax": ORACLE_SQL["retrieve_topk"],
    "chunk_weights_segments": ORACLE_SQL["chunk_weights"],
    "retrieve_topk_chunks": ORACLE_SQL["retrieve_topk"],
    "dense_knn_slices": ORACLE_SQL["dense_knn"],
    "multiturn_records": ORACLE_SQL["multiturn_chatml"],
}
_PHRASES = """
WITH w AS (SELECT item_id, list_filter(string_split_regex(lower(text), '[ \t\n\r]+'), lambda x: x <> '') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
g AS (SELECT item_id, unnest(range(0, len(w) - 1)) AS i, w FROM w WHERE len(w) >= 2),
p AS (SELECT 4 + min(item_id * 1000000 + i) AS place, w[i + 1] || ' ' || w[i + 2] AS phrase FROM g GROUP BY 2
  UNION ALL SELECT * FROM (VALUES (0, 'profanity1'), (1, 'profanity2'), (2, 'hate speech'), (3, 'slur')) AS f(place, phrase)),
d AS (SELECT row_number() OVER () AS r, doc_id, lower(text) AS low FROM documents)
SELECT d.doc_id, CAST(min(p.place) AS BIGINT) AS place, arg_min(p.phrase, p.place) AS phrase
FROM d LEFT JOIN p ON contains(d.low, p.phrase) GROUP BY d.r, d.doc_id"""
ORACLE_SQL["toxic_phrase_table"] = _PHRASES
ORACLE_SQL["numbered_documents"] = """
SELECT row_number() OVER (ORDER BY n_chars DESC NULLS LAST, doc_id ASC NULLS FIRST, text ASC NULLS FIRST,
  lang ASC NULLS FIRST, source ASC NULLS FIRST) AS row_no, doc_id, n_chars FROM documents"""
ORACLE_SQL["guardrail_rollup"] = sql(f"""
SELECT stage, violation_type, source, CAST(grouping(stage, violation_type, source) AS INTEGER) AS level, count(*) AS n
FROM (SELECT 'input' AS stage, coalesce({_in['kind']}, 'passed') AS violation_type, role AS source FROM prompts
  UNION ALL SELECT 'output', coalesce({_out['kind']}, 'passed'), source FROM answers) AS v
GROUP BY ROLLUP (stage, violation_type, source)""", "prompts", "answers")
ORACLE_SQL["stream_guardrail"] = ORACLE_SQL["input_guardrail"]
ORACLE_SQL["tickets_csv_split"] = ORACLE_SQL["tickets_csv"]
ORACLE_SQL["stream_rag"] = ORACLE_SQL["guarded_rag"]
