import json
from pathlib import Path

import pytest

from tidegate.operators import sft
from tidegate.sources.documents import read_documents
from tidegate.sources.jsonl import read_alpaca, read_chatml, write_jsonl


@pytest.fixture
def clean(spark):
    return spark.createDataFrame(
        [("T-1", "Billing", "Why?", "ctx", "Because."), ("T-2", "Été", "How — so?", "c2", "")],
        "ticket_id string, issue_category string, customer_query string, agent_context string, "
        "verified_resolution string")


def test_chatml_record(clean):
    messages = sft.to_chatml(clean).first().messages
    assert [m.role for m in messages] == ["system", "user", "assistant"]
    assert messages[0].content == sft.SYSTEM_MESSAGE
    assert messages[1].content == (
        "Why?\n\n[Support Context — Issue Category: Billing | Ticket: T-1 | Agent Notes: ctx]")
    assert messages[2].content == "Because."


def test_alpaca_record(clean):
    row = sft.to_alpaca(clean).first()
    assert row.instruction == sft.ALPACA_INSTRUCTION
    assert row.input == "Issue Category: Billing\nTicket ID: T-1\nCustomer Query: Why?\nAgent Context: ctx"
    assert row.output == "Because."


def test_statistics(spark, clean):
    chatml, alpaca = sft.to_chatml(clean), sft.to_alpaca(clean)
    prompts = [r.prompt for r in sft.chatml_pairs(chatml).collect()]
    assert all(p.startswith(sft.SYSTEM_MESSAGE + " ") for p in prompts)
    rows = {r.format: r for r in sft.both_stats(chatml, alpaca).collect()}
    assert rows["chatml"].avg_prompt_chars == sum(map(len, prompts)) / 2
    assert rows["chatml"].avg_prompt_tokens == sum(max(1, len(p) // 4) for p in prompts) / 2
    assert rows["alpaca"].avg_completion_chars == len("Because.") / 2
    assert rows["alpaca"].avg_completion_tokens == (2 + 1) / 2
    empty = sft.dataset_stats(sft.alpaca_pairs(alpaca.limit(0))).first()
    assert tuple(empty) == (0, 0.0, 0.0, 0.0, 0.0)


def test_completion_is_the_first_assistant_message(spark):
    records = spark.createDataFrame(
        [([("user", "a"), ("assistant", "b"), ("tool", "c"), ("assistant", "d")],), ([("user", "a")],)],
        "messages array<struct<role: string, content: string>>")
    got = [(r.prompt, r.completion) for r in sft.chatml_pairs(records).collect()]
    assert got == [("a c", "b"), ("a", "")]


def test_jsonl_round_trip(spark, clean, tmp_path):
    for name, records, read in (("chatml", sft.to_chatml(clean), read_chatml),
                                ("alpaca", sft.to_alpaca(clean), read_alpaca)):
        path = str(tmp_path / name)
        assert write_jsonl(records, path) == 2
        assert sorted(map(str, read(spark, path).collect())) == sorted(map(str, records.collect()))
        lines = [line for f in Path(path).glob("*.json") for line in f.read_text().splitlines()]
        assert len(lines) == 2 and any("—" in line for line in lines)


def test_nulls_are_written(spark, tmp_path):
    write_jsonl(spark.createDataFrame([(1, None)], "a int, b string"), str(tmp_path / "n"))
    lines = [line for f in (tmp_path / "n").glob("*.json") for line in f.read_text().splitlines()]
    assert [json.loads(line) for line in lines] == [{"a": 1, "b": None}]


def test_missing_fields_and_bad_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"instruction": "i"}\n{}\n')
    assert [tuple(r) for r in read_alpaca(spark, str(tmp_path / "a.json")).collect()] == [
        ("i", "", ""), ("", "", "")]
    assert [r.messages for r in read_chatml(spark, str(tmp_path / "a.json")).collect()] == [[], []]
    (tmp_path / "b.json").write_text("{broken\n")
    with pytest.raises(Exception):
        read_alpaca(spark, str(tmp_path / "b.json")).collect()


def test_multiturn_records(spark):
    turns = [(c, t * t * 60_000, "user" if t % 2 else "assistant", f"{c}.{t}") for c in (1, 2) for t in range(7 * c)]
    df = spark.createDataFrame(turns[::-1], "conv_id long, turn long, role string, text string")
    whole = {r.conv_id: [m.content for m in r.messages] for r in sft.conversations_to_chatml(df).collect()}
    assert whole == {c: [f"{c}.{t}" for t in range(7 * c)] for c in (1, 2)}
    parts = sft.conversations_to_chatml(df, part_messages=5).orderBy("conv_id", "part").collect()
    assert [(r.part, r.first_position, len(r.messages)) for r in parts] == [(0, 1, 5), (1, 6, 2), (0, 1, 5), (1, 6, 5), (2, 11, 4)]
    assert [m.content for r in parts for m in r.messages] == [t[3] for t in turns]
    for flat in (sft.flat_messages(df), sft.explode_messages(sft.conversations_to_chatml(df), "conv_id"),
                 sft.explode_messages(sft.conversations_to_chatml(df, 5), "conv_id")):
        rows = flat.orderBy("conv_id", "position").collect()
        assert [r.position for r in rows] == list(range(1, 8)) + list(range(1, 15))
        assert [r.content for r in rows] == [t[3] for t in turns]


def test_a_conversation_of_any_length_is_one_record(spark):
    df = spark.range(25_000).selectExpr("7L AS conv_id", "id AS turn", "'user' AS role", "CAST(id AS STRING) AS text")
    flat = sft.flat_messages(df)
    assert flat.agg({"position": "max"}).first()[0] == flat.select("conv_id", "position").distinct().count() == 25_000
    record, = sft.conversations_to_chatml(df).selectExpr("part", "size(messages) AS n").collect()
    assert (record.part, record.n) == (0, 25_000)


def test_preview(clean):
    long = clean.selectExpr("*").replace("Because.", "x" * 2000, "verified_resolution")
    row, = sft.preview(sft.to_chatml(long, ("ticket_id",)), "ticket_id").collect()
    assert row.ticket_id == "T-1" and row.truncated and len(row.preview) == 1200
    assert row.preview.startswith('{\n  "messages"')


def test_document_scan(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\n", encoding="utf-8")
    (tmp_path / "b.txt").write_text("été", encoding="utf-8")
    got = {r.doc_id.rsplit("/", 1)[-1]: r.text for r in read_documents(spark, str(tmp_path)).collect()}
    assert got == {"a.txt": "one\ntwo\n", "b.txt": "été"}
