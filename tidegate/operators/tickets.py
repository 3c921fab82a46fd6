"""Ticket validation and cleaning."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.text import is_blank, sanitise

# --- fixed values: the columns every ticket table must have --------------------------
REQUIRED_COLUMNS = [
    "ticket_id", "issue_category", "customer_query", "agent_context", "verified_resolution",
]
# --- end of fixed values -------------------------------------------------------------


def require_columns(found: list[str], required=REQUIRED_COLUMNS) -> None:
    """Raise before any row is read when a required column is missing; extras pass."""
    missing = sorted(set(required) - set(found))
    if missing:
        raise ValueError(f"missing required columns: {missing}. Found: {list(found)}")


def _valid(required) -> Column:
    return reduce(and_, [~is_blank(F.col(c)) for c in required])


def _cleaned(required) -> list[Column]:
    return [sanitise(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in required]


def clean_tickets(raw: DataFrame, required=REQUIRED_COLUMNS) -> DataFrame:
    """Rows whose required fields are all non-blank as read, then cleaned."""
    require_columns(raw.columns, required)
    return raw.filter(_valid(required)).select(*_cleaned(required))


def sanitise_fields(raw: DataFrame, required=REQUIRED_COLUMNS) -> DataFrame:
    """Every row with its required fields cleaned, valid or not."""
    require_columns(raw.columns, required)
    return raw.select(*_cleaned(required))


def rejected_tickets(raw: DataFrame, required=REQUIRED_COLUMNS) -> DataFrame:
    """The complement of :func:`clean_tickets`, as read, with the failing columns."""
    require_columns(raw.columns, required)
    failing = F.array_compact(F.array(*[F.when(is_blank(F.col(c)), F.lit(c)) for c in required]))
    return raw.filter(~_valid(required)).withColumn("failed_columns", failing)


def report_measures(required=REQUIRED_COLUMNS) -> list[Column]:
    """The aggregates of the validation report, also usable with ``DataFrame.observe``."""
    blank_pairs = reduce(lambda a, b: a + b, [is_blank(F.col(c)).cast("bigint") for c in required])
    rows = F.count(F.lit(1))
    valid = F.coalesce(F.sum(_valid(required).cast("bigint")), F.lit(0))
    return [
        rows.alias("total_rows"),
        valid.alias("valid_rows"),
        (rows - valid).alias("invalid_rows"),
        F.coalesce(F.sum(blank_pairs), F.lit(0)).alias("null_field_errors"),
        (rows * len(required)).alias("sanitised_fields"),
    ]


def validation_report(raw: DataFrame, required=REQUIRED_COLUMNS) -> DataFrame:
    """One row of counters.

    ``null_field_errors`` counts (row, column) pairs and ``sanitised_fields`` the cells
    visited; ``changed_fields`` beside it counts the non-null cells that cleaning changed.
    """
    require_columns(raw.columns, required)
    changed = reduce(lambda a, b: a + b, [
        F.coalesce((sanitise(F.col(c)) != F.col(c)).cast("bigint"), F.lit(0)) for c in required])
    return raw.agg(*report_measures(required),
                   F.coalesce(F.sum(changed), F.lit(0)).alias("changed_fields"))


def column_errors(raw: DataFrame, required=REQUIRED_COLUMNS) -> DataFrame:
    """Null or blank cells per column, only columns that have any."""
    require_columns(raw.columns, required)
    counts = raw.agg(*[F.count_if(is_blank(F.col(c))).alias(c) for c in required])
    return counts.unpivot([], list(required), "column_name", "n_errors").filter("n_errors > 0")


def in_ticket_order(tickets: DataFrame) -> DataFrame:
    """Total order by ticket id, for ordered exports only (range partitioned)."""
    return tickets.orderBy("ticket_id")
