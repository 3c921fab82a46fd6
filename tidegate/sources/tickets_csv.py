"""Ticket CSV scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.operators.tickets import require_columns

# --- fixed values: cell texts read as missing ----------------------------------------
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# --- end of fixed values -------------------------------------------------------------

_CORRUPT = "_corrupt"
# a quoted field: it opens at the start of the row or after a comma
_QUOTED_FIELD = r'(^|,)"(?:[^"]|"")*+"'


def null_na_tokens(df: DataFrame, columns=None) -> DataFrame:
    """Cells that equal a missing-value token become null."""
    columns = columns or df.columns
    return df.withColumns({c: F.when(~F.col(c).isin(NA_TOKENS), F.col(c)) for c in columns})


def read_tickets(spark: SparkSession, path, multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """Read ticket CSV files with a header: ``(tickets, overlong)``.

    Every column is a string bound by header name; a short row is padded with nulls; a
    row with more fields than the header goes to ``overlong`` as raw text. A multi-line
    CSV file is one task: give many files, or ``multi_line=False`` where no field holds
    a newline, so that files split.
    """
    options = dict(header=True, quote='"', escape='"', multiLine=multi_line)
    names = spark.read.options(**options).csv(path).columns
    require_columns(names)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*names, _CORRUPT)])
    rows = (spark.read.schema(schema)
            .options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT,
                     enforceSchema=False, columnPruning=False)
            .csv(path))
    # Spark refuses a scan of the corrupt column alone, so the test reads another one too
    first = F.coalesce(F.col(names[0]), F.lit(""))
    overlong = F.coalesce(_field_count(F.col(_CORRUPT)) > len(names), F.lit(False)) & (first >= "")
    return (null_na_tokens(rows.filter(~overlong).drop(_CORRUPT), names),
            rows.filter(overlong).select(F.col(_CORRUPT).alias("raw")))


def _field_count(raw: Column) -> Column:
    return F.size(F.split(F.regexp_replace(raw, _QUOTED_FIELD, "$1"), ","))
