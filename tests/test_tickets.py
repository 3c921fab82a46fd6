import pytest
from pyspark.sql import functions as F

from tidegate.operators import tickets as K
from tidegate.plans.finetune import prepare_finetuning
from tidegate.sources.tickets_csv import NA_TOKENS, read_tickets

CSV = '''ticket_id,issue_category,customer_query,agent_context,verified_resolution,extra
T-1,Billing,"Charged twice, why?","line one
line two","He said ""sorry""",e
T-2,NA,query,context,resolution,e
T-3,Shipping,query
T-4,General,query,context,resolution,e,too,many
T-5,"Account, Access","a, ""b"", c",  padded  ,resolution,
T-6,\x01,query,context,resolution,e
'''


@pytest.fixture
def csv_path(tmp_path):
    path = tmp_path / "tickets.csv"
    path.write_text(CSV, encoding="utf-8")
    return str(path)


def test_csv_scan(spark, csv_path):
    tickets, overlong = read_tickets(spark, csv_path)
    rows = {r.ticket_id: r for r in tickets.collect()}
    assert sorted(rows) == ["T-1", "T-2", "T-3", "T-5", "T-6"]
    assert rows["T-1"].agent_context == "line one\nline two"
    assert rows["T-1"].verified_resolution == 'He said "sorry"'
    assert rows["T-2"].issue_category is None
    assert rows["T-3"].agent_context is None
    assert rows["T-5"].customer_query == 'a, "b", c' and rows["T-5"].extra is None
    assert [r.raw.split(",")[0] for r in overlong.collect()] == ["T-4"]


def test_na_tokens_become_null(spark, tmp_path):
    path = tmp_path / "na.csv"
    header = ",".join(K.REQUIRED_COLUMNS)
    path.write_text(header + "\n" + "".join(f"k,{t},q,c,r\n" for t in NA_TOKENS), encoding="utf-8")
    tickets, overlong = read_tickets(spark, str(path))
    assert tickets.filter("issue_category is null").count() == len(NA_TOKENS)
    assert overlong.isEmpty()


def test_missing_column_fails_before_reading(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("ticket_id,customer_query\nT-1,q\n")
    with pytest.raises(ValueError, match="agent_context"):
        read_tickets(spark, str(path))


def test_validation(spark, csv_path):
    raw, _ = read_tickets(spark, csv_path)
    report = K.validation_report(raw).first()
    assert (report.total_rows, report.valid_rows, report.invalid_rows) == (5, 3, 2)
    assert (report.null_field_errors, report.sanitised_fields) == (3, 25)
    assert report.changed_fields == 2       # the padded cell and the control character
    clean, rejected = K.clean_tickets(raw), K.rejected_tickets(raw)
    assert clean.columns == K.REQUIRED_COLUMNS
    assert clean.count() + rejected.count() == raw.count()
    assert {r.ticket_id: r.failed_columns for r in rejected.collect()} == {
        "T-2": ["issue_category"], "T-3": ["agent_context", "verified_resolution"]}
    kept = {r.ticket_id: r for r in clean.collect()}
    assert kept["T-6"].issue_category == ""     # tested as read, cleaned afterwards
    assert kept["T-5"].agent_context == "padded"
    errors = {r.column_name: r.n_errors for r in K.column_errors(raw).collect()}
    assert errors == {"issue_category": 1, "agent_context": 1, "verified_resolution": 1}
    assert [r.ticket_id for r in K.in_ticket_order(clean).collect()] == ["T-1", "T-5", "T-6"]


def test_empty_table_reports_zeros(spark):
    empty = spark.createDataFrame([], ", ".join(f"{c} string" for c in K.REQUIRED_COLUMNS))
    assert set(K.validation_report(empty).first()) == {0}
    assert K.column_errors(empty).isEmpty()


def test_preparation_end_to_end(spark, csv_path, tmp_path):
    done = prepare_finetuning(spark, csv_path, str(tmp_path / "out"))
    assert done.report == {"total_rows": 5, "valid_rows": 3, "invalid_rows": 2,
                           "null_field_errors": 3, "sanitised_fields": 25}
    assert done.records == {"chatml": 3, "alpaca": 3}
    assert {r.format: r.row_count for r in done.stats.collect()} == {"chatml": 3, "alpaca": 3}
    assert all(r.bytes > 0 and r.records == 3 for r in done.manifest.collect())
    assert done.rejected.count() == 2 and all(r.failed_columns for r in done.rejected.collect())
    assert sum(r.n_errors for r in done.column_errors.collect()) == 3
    assert "T-1" in done.chatml_preview.first().preview
    assert spark.read.parquet(str(tmp_path / "out/overlong")).count() == 1
    assert spark.read.parquet(str(tmp_path / "out/clean")).filter(F.col("ticket_id") == "T-5").count() == 1


@pytest.mark.parametrize("range_bytes", [64, 300, 1 << 20])
def test_split_csv_equals_the_multi_line_reader(spark, tmp_path, range_bytes):
    from tidegate.sources.split_csv import read_split_csv
    header = "ticket_id,issue_category,customer_query,agent_context,verified_resolution"
    for name, count in (("a.csv", 120), ("b.csv", 7)):
        rows = [header]
        for i in range(count):
            q = f'"one\nline ""two"" {i}\r\n\nthree"' if i % 3 == 0 else f"plain {i}"
            extra = ',"one, too many"' if i % 7 == 0 else ""
            short = i % 11 == 5
            rows.append(f'{name}-{i},{"NA" if i % 5 == 0 else "General"},{q}' + ("" if short else f',ctx {i},"sol,\n{i}"{extra}'))
        (tmp_path / name).write_text("\n".join(rows) + "\n\n")
    got, got_over = read_split_csv(spark, str(tmp_path), range_bytes)
    want, want_over = read_tickets(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert sorted(map(tuple, got_over.collect())) == sorted(map(tuple, want_over.collect()))
    assert got.count() > 100 and got_over.count() > 10


def test_row_numbers_over_parts_equal_one_window(spark):
    from pyspark.sql import Window

    from tidegate.operators.numbering import number_rows
    rows = [(i % 7 if i % 5 else None, f"t{i % 3}", i % 11) for i in range(500)] + [(1, "t1", 1)] * 200
    df = spark.createDataFrame(rows, "a long, b string, c long").repartition(6)
    order = [F.col("a").desc_nulls_last(), F.col("b").asc_nulls_first(), F.col("c").asc_nulls_first()]
    got = sorted((tuple(r) for r in number_rows(df, *order).collect()), key=repr)
    want = sorted((tuple(r) for r in df.withColumn("row_no", F.row_number().over(Window.orderBy(*order))).collect()), key=repr)
    assert got == want
    assert sorted(r.row_no for r in number_rows(df, *order).collect()) == list(range(1, 701))
    assert number_rows(df.limit(0), *order).count() == 0
