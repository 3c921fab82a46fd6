"""Fine-tuning preparation: ticket files in, two training sets with reports out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from tidegate.operators.sft import both_stats, preview, to_alpaca, to_chatml
from tidegate.operators.tickets import clean_tickets, column_errors, rejected_tickets, report_measures
from tidegate.sources.jsonl import output_manifest, read_alpaca, read_chatml, write_jsonl
from tidegate.sources.tickets_csv import read_tickets


@dataclass(frozen=True)
class PreparedSet:
    report: dict            # validation counters
    records: dict           # records per data set
    stats: DataFrame        # one row per format
    manifest: DataFrame     # records, files and bytes per data set
    rejected: DataFrame     # rows with a blank required field, with the failing columns
    column_errors: DataFrame
    chatml_preview: DataFrame


def prepare_finetuning(spark: SparkSession, csv_path, out: str, multi_line: bool = True) -> PreparedSet:
    """Read tickets, keep and clean the valid ones, write ChatML and Alpaca JSON Lines.

    The raw rows are parsed once and stored; the job that writes the clean table also
    counts the validation report. Rejected rows are written beside it with their failing
    columns. Overlong rows are set aside, newlines and all, in a second pass over the CSV.
    """
    raw, overlong = read_tickets(spark, csv_path, multi_line)
    overlong.write.mode("overwrite").parquet(f"{out}/overlong")
    raw.write.mode("overwrite").parquet(f"{out}/raw")
    raw = spark.read.parquet(f"{out}/raw")
    rejected_tickets(raw).write.mode("overwrite").parquet(f"{out}/rejected")
    seen = Observation()
    clean_tickets(raw.observe(seen, *report_measures())).write.mode("overwrite").parquet(f"{out}/clean")
    clean = spark.read.parquet(f"{out}/clean")
    paths = {"chatml": f"{out}/chatml", "alpaca": f"{out}/alpaca"}
    records = {"chatml": write_jsonl(to_chatml(clean), paths["chatml"]),
               "alpaca": write_jsonl(to_alpaca(clean), paths["alpaca"])}
    chatml, alpaca = read_chatml(spark, paths["chatml"]), read_alpaca(spark, paths["alpaca"])
    return PreparedSet(dict(seen.get), records, both_stats(chatml, alpaca),
                       output_manifest(spark, paths, records),
                       spark.read.parquet(f"{out}/rejected"), column_errors(raw),
                       preview(to_chatml(clean, ("ticket_id",)), "ticket_id"))
