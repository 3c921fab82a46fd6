"""Input and output guardrails as Column expressions, and corpus screening.

Each guardrail is one ``CASE`` over a catalogue in priority order: a pattern is tried
only when no earlier one hit, and the matched text is extracted only on a hit. Nearly all
text is clean, so a pattern that cannot match without certain literals is tried only on
text that holds one of them.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.text import FOLD_TO_ASCII, bind, holds_any, java_regex


class Detector(NamedTuple):
    """A pattern with its names; ``needs`` lists lower-case literals, one of which every
    match holds (none: always tried)."""

    kind: str
    label: str
    pattern: str
    ignore_case: bool = True
    needs: tuple[str, ...] = ()


# --- fixed values: catalogues and messages that results must equal -------------------
# the order is the priority
INJECTION_CATALOGUE = [
    Detector(
        "system_prompt_override",
        "System-prompt override attempt",
        r"ignore\s+(all\s+)?(previous|prior|above|earlier)\s+instructions?"
        r"|system\s+override"
        r"|you\s+are\s+now\s+(?:in\s+)?(?:DAN|developer|god)\s+mode"
        r"|forget\s+(?:everything|all)\s+(?:you\s+know|previously)"
        r"|act\s+as\s+(?:an?\s+)?unfiltered"
        r"|disregard\s+(?:your\s+)?(?:previous\s+)?instructions?"
        r"|new\s+instructions?\s*[:=]"
        r"|override\s+(?:your\s+)?(?:system\s+)?prompt",
        needs=("instruction", "override", "mode", "forget", "unfiltered"),
    ),
    Detector(
        "delimiter_collision",
        "Delimiter / template injection attempt",
        r"###\s*(?:instruction|system|prompt|context)"
        r"|<\|im_start\||<\|im_end\|"
        r"|\[INST\]|\[/INST\]"
        r"|<<SYS>>|<</SYS>>"
        r"|\{\{[^\n]*?\}\}"
        r"|<system>|</system>",
        needs=("###", "<|im_", "inst]", "sys>>", "{{", "system>"),
    ),
    Detector(
        "exfiltration_probe",
        "Exfiltration / secret-extraction probe",
        r"(print|show|reveal|display|output|repeat|tell me)\s+"
        r"(your|the|all|any)?\s*"
        r"(initial|hidden|system|original|secret|internal|full)\s+"
        r"(prompt|instructions?|context|policies?|data)"
        r"|what\s+(are|is)\s+your\s+(hidden|secret|system)\s+(instructions?|prompt)"
        r"|show\s+all\s+(hidden|secret|internal)\s+policies"
        r"|dump\s+(all|the|your)\s+(context|data|memory|knowledge|instructions?)",
        needs=("initial", "hidden", "system", "original", "secret", "internal", "full", "dump"),
    ),
]

TOXIC_PHRASES = ["profanity1", "profanity2", "hate speech", "slur"]

LEAK_CATALOGUE = [
    Detector("secret_key", "secret key", r"sk-[A-Za-z0-9]{20,}", needs=("sk-",)),
    Detector("cloud_access_key", "cloud access key", r"AKIA[0-9A-Z]{16}", needs=("akia",)),
    Detector("password", "password", r"(?:password|passwd|pwd)\s*[:=]\s*\S+",
             needs=("password", "passwd", "pwd")),
    Detector("bearer_token", "bearer token", r"Bearer\s+[A-Za-z0-9\-._~+/]+=*", needs=("bearer",)),
    Detector("api_key", "API key",
             r"api[_-]?key\s*[:=]\s*['\"]?[A-Za-z0-9\-_]{16,}['\"]?", needs=("api",)),
    Detector("ssn", "US social security number", r"\b\d{3}-\d{2}-\d{4}\b", ignore_case=False),
    Detector("card_number", "card number", r"\b(?:\d[ -]?){13,16}\b", ignore_case=False),
]
LEAK_SHOWN = 20

INPUT_PASSED = "✅ Input guardrail PASSED"
INPUT_BLOCKED = (
    "🚨 SECURITY VIOLATION DETECTED\n   Type    : ",
    "\n   Fragment: '",
    "'\n   Action  : Query halted. No retrieval or generation performed.",
)
OUTPUT_PASSED = "✅ Output guardrail PASSED"
TOXIC_BLOCKED = (
    "⛔ OUTPUT BLOCKED: Toxic content detected ('",
    "').\n   The response has been suppressed to protect users.",
)
LEAK_BLOCKED = (
    "⛔ OUTPUT BLOCKED: Credential / PII leakage detected.\n   Pattern matched: '",
    "'\n   The response has been suppressed for security.",
)
# --- end of fixed values -------------------------------------------------------------


def _result(passed: bool, kind: Column, matched: Column, message: Column) -> Column:
    return F.struct(
        F.lit(passed).alias("passed"),
        kind.cast("string").alias("violation_type"),
        matched.cast("string").alias("matched_pattern"),
        message.alias("message"),
    )


def _passed(message: str) -> Column:
    return _result(True, F.lit(None), F.lit(None), F.lit(message))


def _first_of(branches: list[tuple[Column, Column]]) -> Column:
    """CASE WHEN over ``(condition, value)`` pairs, in order; null when none holds."""
    chain = F.when(*branches[0])
    for condition, value in branches[1:]:
        chain = chain.when(condition, value)
    return chain


def detect(text: Column, pattern: str, ignore_case: bool = True) -> Column:
    """The first matched fragment of one detector, or null."""
    return F.nullif(F.regexp_extract(text, java_regex(pattern, ignore_case), 0), F.lit(""))


def _scan(text: Column, detectors: list[Detector], blocked, before=None) -> Column:
    """Result of the first detector that hits, null when none does.

    ``blocked(detector, fragment)`` builds the result. ``before(low)`` gives a result
    that comes first, from the lower-cased text. The lower-cased text is made once.
    """
    seen = F.struct(F.lower(text).alias("low"), holds_any(text, FOLD_TO_ASCII).alias("odd"))

    def first(v: Column) -> Column:
        branches = []
        for d in detectors:
            regex = java_regex(d.pattern, d.ignore_case)
            hit = text.rlike(regex)
            if d.needs:
                hit = (v["odd"] | holds_any(v["low"], d.needs)) & hit
            branches.append((hit, blocked(d, F.regexp_extract(text, regex, 0))))
        found = _first_of(branches)
        return F.coalesce(before(v["low"]), found) if before else found

    return bind(seen, first)


def input_guardrail(text: Column, catalogue: list[Detector] = INJECTION_CATALOGUE) -> Column:
    """Struct ``passed, violation_type, matched_pattern, message`` for a prompt."""
    head, middle, tail = INPUT_BLOCKED

    def blocked(d: Detector, fragment: Column) -> Column:
        return bind(fragment, lambda hit: _result(
            False, F.lit(d.kind), hit, F.concat(F.lit(head + d.label + middle), hit, F.lit(tail))))

    return F.coalesce(_scan(text, catalogue, blocked), _passed(INPUT_PASSED))


def toxic_phrase(text: Column, phrases: list[str] = TOXIC_PHRASES) -> Column:
    """The first phrase of the list found in the lower-cased text, or null."""
    return bind(F.lower(text), lambda low: _listed_phrase(low, phrases))


def _listed_phrase(low: Column, phrases: list[str]) -> Column:
    return F.get(F.filter(F.array(*map(F.lit, phrases)), lambda p: F.contains(low, p)), F.lit(0))


def output_guardrail(
    text: Column, phrases: list[str] = TOXIC_PHRASES, leaks: list[Detector] = LEAK_CATALOGUE,
    mask: bool = False,
) -> Column:
    """Struct as for :func:`input_guardrail`, for an answer or a document.

    Toxic phrases come before leaks. ``mask=True`` shows the kind of leak instead of
    the first characters of the secret.
    """
    def toxic(low: Column) -> Column:
        return bind(_listed_phrase(low, phrases), lambda p: F.when(p.isNotNull(), _result(
            False, F.lit("toxicity"), p, F.concat(F.lit(TOXIC_BLOCKED[0]), p, F.lit(TOXIC_BLOCKED[1])))))

    def blocked(d: Detector, fragment: Column) -> Column:
        shown = F.lit(f"<{d.kind}>") if mask else F.concat(
            F.substring(fragment, 1, LEAK_SHOWN), F.lit("…"))
        return bind(shown, lambda s: _result(
            False, F.lit("credential_leakage"), s,
            F.concat(F.lit(LEAK_BLOCKED[0]), s, F.lit(LEAK_BLOCKED[1]))))

    return F.coalesce(_scan(text, leaks, blocked, toxic), _passed(OUTPUT_PASSED))


def guard_queries(queries: DataFrame, text: str = "query", out: str = "input_guardrail") -> DataFrame:
    """Add the input guardrail result to a table (or stream) of prompts."""
    return queries.withColumn(out, input_guardrail(F.col(text)))


def guard_answers(
    answers: DataFrame, text: str = "answer", out: str = "output_guardrail", mask: bool = False
) -> DataFrame:
    """Add the output guardrail result to a table (or stream) of answers."""
    return answers.withColumn(out, output_guardrail(F.col(text), mask=mask))


def violation_summary(screened: DataFrame, stages: dict[str, str]) -> DataFrame:
    """Rows per stage and violation type; ``stages`` maps stage name to result column."""
    per_stage = F.explode(F.array(*[
        F.struct(F.lit(name).alias("stage"),
                 F.coalesce(F.col(column)["violation_type"], F.lit("passed")).alias("violation_type"))
        for name, column in stages.items()
    ]))
    return (screened.select(per_stage.alias("v"))
            .groupBy("v.stage", "v.violation_type")
            .agg(F.count("*").alias("n")))


def violation_rollup(screened: dict[str, tuple[DataFrame, str]], source: str = "source") -> DataFrame:
    """Rows by stage, violation type and source, with the subtotals of a rollup.

    ``screened`` maps a stage name to a table and its result column; every table has the
    column ``source``. Result: ``stage, violation_type, source, level, n``; ``level`` is the
    grouping id (0: all three, 1: stage and type, 3: stage, 7: everything), so a null source of
    the data is told from a subtotal. Partial counts are merged before the shuffle.
    """
    rows = None
    for name, (table, column) in screened.items():
        part = table.select(F.lit(name).alias("stage"),
                            F.coalesce(F.col(column)["violation_type"], F.lit("passed")).alias("violation_type"),
                            F.col(source).cast("string").alias("source"))
        rows = part if rows is None else rows.unionByName(part)
    return (rows.rollup("stage", "violation_type", "source")
            .agg(F.grouping_id().cast("int").alias("level"), F.count("*").alias("n")))


def screen_corpus(docs: DataFrame, text: str = "text", mask: bool = False) -> DataFrame:
    """Run both guardrails over a corpus: adds both results and ``clean``.

    ``clean_part`` and ``flagged_part`` select the two sides; ``write_screened`` writes
    both in one pass.
    """
    return (docs
            .withColumn("input_check", input_guardrail(F.col(text)))
            .withColumn("output_check", output_guardrail(F.col(text), mask=mask))
            .withColumn("clean", F.col("input_check.passed") & F.col("output_check.passed")))


def clean_part(screened: DataFrame) -> DataFrame:
    return screened.filter("clean").drop("input_check", "output_check", "clean")


def flagged_part(screened: DataFrame) -> DataFrame:
    return screened.filter("not clean")


def write_screened(screened: DataFrame, path: str) -> None:
    """One scan, two folders: ``clean=true`` and ``clean=false``."""
    screened.write.partitionBy("clean").mode("overwrite").parquet(path)
