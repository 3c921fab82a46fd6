"""Sharding and mixing: limits, deviation, order, odd rows; and that no Python runs in them."""

from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from prose import prose

from tidegate.llm.mixing import mix_sources
from tidegate.llm.sharding import shard


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_shards_fit_and_split_only_where_needed(make_docs):
    rows = [(i, prose(i, 5 + i % 40)) for i in range(400)]
    got = shard(make_docs(rows), 2000).collect()
    assert sorted(x.doc_id for x in got) == list(range(400))
    held = defaultdict(int)
    for x in got:
        assert x.n_bytes == len(rows[x.doc_id][1].encode())
        held[x.depth, x.prefix, x.page] += x.n_bytes
    assert max(held.values()) <= 2000 and {p for _, _, p in held} == {0}
    for x in got:
        assert held[x.depth, x.prefix, 0] == x.shard_bytes
        parent = sum(n for (d, p, _), n in held.items() if d >= x.depth and p >> (d - x.depth + 1) == x.prefix >> 1)
        assert parent > 2000  # it had to be split


def test_one_key_with_a_third_of_all_rows_fills_pages(make_docs):
    rows = [(7, "x" * 100)] * 300 + [(i, "y" * 100) for i in range(100, 700)] + [(9, "z" * 5000)]
    got = shard(make_docs(rows).repartition(5), 1000).collect()
    assert Counter(x.doc_id for x in got) == Counter(i for i, _ in rows)
    held = defaultdict(list)
    for x in got:
        held[x.depth, x.prefix, x.page].append(x.n_bytes)
    assert all(sum(v) <= 1000 or v == [5000] for v in held.values())
    assert len({x.page for x in got if x.doc_id == 7}) == 30


def test_repeated_ids_lose_no_row_when_the_directory_is_shuffled(spark, make_docs):
    """60,000 rows, 40 ids repeated among unique ones; no broadcast and small coalesced parts, as at scale."""
    rows = [(i, "v" * (i % 90)) for i in range(40, 40_000)] + [(i % 40, "w" * (10 + i % 7)) for i in range(20_040)]
    saved = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold",
                                              "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
    try:
        got = shard(make_docs(rows).repartition(7), 2000).collect()
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert Counter(x.doc_id for x in got) == Counter(i for i, _ in rows)
    held = defaultdict(list)
    for x in got:
        held[x.depth, x.prefix, x.page].append(x.n_bytes)
    assert all(sum(v) <= 2000 for v in held.values())


def test_shard_odd_and_empty(odd_docs):
    got = shard(odd_docs, 64).collect()
    assert len(got) == odd_docs.count() and sum(x.n_bytes == 0 for x in got) == 2
    assert shard(odd_docs.limit(0), 64).count() == 0


def test_everything_in_one_shard(make_docs):
    assert {(x.depth, x.prefix, x.page) for x in shard(make_docs([(1, "a"), (2, None)]), 10).collect()} == {(0, 0, 0)}


@pytest.fixture
def sources(spark):
    def make(sizes):
        rows = [(n, f"t{n}", s) for n, s in enumerate(s for s, k in sizes.items() for _ in range(k))]
        return spark.createDataFrame(rows, "doc_id long, text string, source string")
    return make


def blocks_in_order(rows):
    seen = {}
    for x in rows:
        assert seen.setdefault(x.mix_position, (x.source, x.mix_block)) == (x.source, x.mix_block)
    assert sorted(seen) == list(range(len(seen)))
    return [seen[p] for p in range(len(seen))]


@pytest.mark.parametrize("weights", [{"a": 5, "b": 3, "c": 2}, {"a": 1, "b": 1, "c": 1}, {"a": 97, "b": 2, "c": 1}])
def test_deviation_stays_below_one_block(sources, weights):
    sizes, block, cycle = {"a": 400, "b": 230, "c": 170}, 4, 10 if max(weights.values()) < 90 else 100
    got = mix_sources(sources(sizes), weights, block_rows=block, cycle=cycle).collect()
    assert Counter(x.source for x in got) == sizes
    order = blocks_in_order(got)
    assert [b for s, b in order if s == "a"] == list(range(100))
    total = sum(weights.values())
    per_cycle = {s: max(1, round(w / total * cycle)) for s, w in weights.items()}
    # while no source is in its last cycle, shares are exact and the lag is under one block
    full = min(sizes[s] // block // k for s, k in per_cycle.items()) * sum(per_cycle.values())
    done, slots = Counter(), sum(per_cycle.values())
    for t, (source, _) in enumerate(order[:full], 1):
        done[source] += 1
        for s, k in per_cycle.items():
            assert abs(done[s] - Fraction(k * t, slots)) < 1
    assert full > 0


def test_every_row_has_its_own_place(sources, spark):
    docs = sources({"a": 90, "b": 33, None: 20, "": 3}).withColumn("mix_block", spark.range(1).selectExpr("1 as x").first().x + 0 * __import__("pyspark").sql.functions.col("doc_id"))
    got = mix_sources(docs, block_rows=8).collect()
    assert len({(x.mix_position, x.mix_place) for x in got}) == len(got) == 146
    assert max(x.mix_place for x in got) == 7 and {x.source for x in got} == {"a", "b", None, ""}


def test_mixing_odd_and_empty(odd_docs):
    assert mix_sources(odd_docs).count() == odd_docs.count()
    assert mix_sources(odd_docs.limit(0)).count() == 0
    assert mix_sources(odd_docs, {}).count() == odd_docs.count()


def test_no_python_in_native_operators(make_docs):
    docs = make_docs([(i, "x" * 50) for i in range(50)])
    for df in (shard(docs, 200), mix_sources(docs)):
        assert not any(word in plan_of(df) for word in ("Python", "Arrow", "Pandas"))


@pytest.mark.parametrize(("sizes", "weights"), [
    ({"a": 1200, "b": 600}, {"a": 2, "b": 1}), ({"a": 1500, "b": 200, "c": 60, "d": 7}, None),
    ({"a": 2400, "b": 5}, {"a": 0.9996, "b": 0.0004}), ({"a": 300, "b": 400, "c": 500}, {"a": 7, "b": 2.5, "c": 1})])
def test_deviation_from_given_weights_over_many_cycles(sources, sizes, weights):
    got = mix_sources(sources(sizes), weights, block_rows=1, cycle=10).collect()
    order = blocks_in_order(got)
    assert Counter(s for s, _ in order) == sizes
    weights = weights or {s: n ** 0.5 for s, n in sizes.items()}
    done, served = Counter(), dict.fromkeys(sizes, 0.0)
    for source, block in order:
        assert block == done[source]
        done[source] += 1
        left = 1.0
        while left > 1e-12:  # one slot of the fluid mix, in parts where a source ends
            open_ = [s for s in sizes if served[s] < sizes[s] - 1e-9]
            total = sum(weights[s] for s in open_)
            part = min([left, *((sizes[s] - served[s]) * total / weights[s] for s in open_)]) if open_ else left
            for s in open_:
                served[s] += part * weights[s] / total
            left -= part
        assert all(abs(done[s] - served[s]) < 1 + 1e-5 for s in sizes)
