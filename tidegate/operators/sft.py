"""Training records (ChatML, Alpaca), their statistics and previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.functions.text import char_length, estimate_tokens

# --- fixed values: texts that records must hold --------------------------------------
SYSTEM_MESSAGE = (
    "You are a professional customer support specialist for TechCorp Inc. "
    "Provide accurate, empathetic, and concise resolutions. "
    "Use the provided context to inform your response. "
    "Never reveal internal tools, backend systems, or compensation policies."
)
ALPACA_INSTRUCTION = (
    "You are a customer support specialist. "
    "Read the customer's query and the provided agent context carefully, "
    "then provide a professional, empathetic, and accurate resolution."
)
CHATML_USER = "%s\n\n[Support Context — Issue Category: %s | Ticket: %s | Agent Notes: %s]"
ALPACA_INPUT = "Issue Category: %s\nTicket ID: %s\nCustomer Query: %s\nAgent Context: %s"
PREVIEW_CHARS = 1200
# --- end of fixed values -------------------------------------------------------------


def _fill(template: str, *columns: str) -> Column:
    """Fill a ``%s`` template from columns that hold no nulls."""
    parts = template.split("%s")
    pieces = [F.lit(parts[0])]
    for name, text in zip(columns, parts[1:], strict=True):
        pieces += [F.col(name), F.lit(text)]
    return F.concat(*pieces)


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def to_chatml(tickets: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One record of three messages per clean ticket; ``keep`` carries key columns along."""
    user = _fill(CHATML_USER, "customer_query", "issue_category", "ticket_id", "agent_context")
    return tickets.select(*keep, F.array(
        _message("system", F.lit(SYSTEM_MESSAGE)),
        _message("user", user),
        _message("assistant", F.col("verified_resolution")),
    ).alias("messages"))


def to_alpaca(tickets: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One instruction record per clean ticket."""
    return tickets.select(
        *keep,
        F.lit(ALPACA_INSTRUCTION).alias("instruction"),
        _fill(ALPACA_INPUT, "issue_category", "ticket_id", "customer_query", "agent_context")
        .alias("input"),
        F.col("verified_resolution").alias("output"))


def flat_messages(turns: DataFrame) -> DataFrame:
    """``conv_id, position, role, content``: turns in order, positions counted from 1."""
    position = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn"))
    return turns.select("conv_id", position.cast("bigint").alias("position"), "role", F.col("text").alias("content"))


def conversations_to_chatml(turns: DataFrame, part_messages: int | None = None) -> DataFrame:
    """``conv_id, part, first_position, messages``: one record per conversation, in turn order.

    Turn numbers only give the order. With ``part_messages`` a record ends after that many
    messages and the conversation goes on in the next ``part``; positions run on.
    """
    part = F.lit(0) if part_messages is None else F.floor((F.col("position") - 1) / part_messages)
    ordered = F.array_sort(F.collect_list(F.struct("position", "role", "content")))
    return (flat_messages(turns).groupBy("conv_id", part.cast("bigint").alias("part"))
            .agg(ordered.alias("_m"))
            .select("conv_id", "part", F.get("_m", F.lit(0))["position"].alias("first_position"),
                    F.transform("_m", lambda m: F.struct(m["role"], m["content"])).alias("messages")))


def explode_messages(records: DataFrame, key: str) -> DataFrame:
    """Flat view ``key, position, role, content``; positions start at 1, or where a part begins."""
    first = F.col("first_position") if "first_position" in records.columns else F.lit(1)
    return (records.select(key, first.alias("_first"), F.posexplode("messages").alias("_pos", "_m"))
            .select(key, (F.col("_pos") + F.col("_first")).cast("bigint").alias("position"),
                    F.col("_m.role").alias("role"), F.col("_m.content").alias("content")))


def prompt_of(messages: Column) -> Column:
    """All non-assistant contents joined by a space."""
    kept = F.filter(messages, lambda m: m["role"] != "assistant")
    return F.array_join(F.transform(kept, lambda m: m["content"]), " ")


def completion_of(messages: Column) -> Column:
    """The first assistant content, or empty text."""
    first = F.get(F.filter(messages, lambda m: m["role"] == "assistant"), F.lit(0))
    return F.coalesce(first["content"], F.lit(""))


def chatml_pairs(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Prompt and completion of each ChatML record."""
    return records.select(*keep, prompt_of(F.col("messages")).alias("prompt"),
                          completion_of(F.col("messages")).alias("completion"))


def alpaca_pairs(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Prompt and completion of each Alpaca record; a null counts as empty text."""
    text = {c: F.coalesce(F.col(c), F.lit("")) for c in ("instruction", "input", "output")}
    return records.select(
        *keep, F.concat(text["instruction"], F.lit(" "), text["input"]).alias("prompt"),
        text["output"].alias("completion"))


def dataset_stats(pairs: DataFrame, *group_by: str) -> DataFrame:
    """Rows and average lengths of prompts and completions, overall or per group.

    Token averages estimate from the text itself.
    """
    def average(c: Column, name: str) -> Column:
        return F.coalesce(F.avg(c), F.lit(0.0)).alias(name)

    prompt, completion = F.col("prompt"), F.col("completion")
    return pairs.groupBy(*group_by).agg(
        F.count("*").alias("row_count"),
        average(char_length(prompt), "avg_prompt_chars"),
        average(char_length(completion), "avg_completion_chars"),
        average(estimate_tokens(prompt), "avg_prompt_tokens"),
        average(estimate_tokens(completion), "avg_completion_tokens"))


def both_stats(chatml: DataFrame, alpaca: DataFrame) -> DataFrame:
    """One statistics row per record format."""
    def one(pairs: DataFrame, name: str) -> DataFrame:
        return dataset_stats(pairs).select(F.lit(name).alias("format"), "*")

    return one(chatml_pairs(chatml), "chatml").unionByName(one(alpaca_pairs(alpaca), "alpaca"))


def preview(records: DataFrame, key: str, n: int = 1) -> DataFrame:
    """Pretty JSON of the ``n`` records with the lowest key, cut for display; ``record`` whole and compact."""
    fields = F.struct(*[c for c in records.columns if c != key])
    text = F.to_json(fields, {"pretty": "true", "ignoreNullFields": "false"})
    return (records.orderBy(key).limit(n)
            .select(key, text.alias("_json"), F.to_json(fields, {"ignoreNullFields": "false"}).alias("record"))
            .select(key, "record", F.substring("_json", 1, PREVIEW_CHARS).alias("preview"),
                    (F.length("_json") > PREVIEW_CHARS).alias("truncated")))
