"""Operators 1, 4 and 10: against their SQL, and on hard tables."""

from __future__ import annotations

from hashlib import md5

import duckdb
import pytest
from plain import HARD_ROWS, PASSAGE, hard_documents, line_dedup

from adspend.llm import op01_quality, op04_lines, op10_mix, registry
from pyspark.sql import functions as F

SQL = ["op1_quality", "op4_lines", "op10_mix"]


def compare(df, sql, tables):
    con = duckdb.connect()
    for name, value in tables.items():
        con.register("loaded", value) if not isinstance(value, str) else None
        con.execute(f"create table {name} as select * from " + (f"'{value}'" if isinstance(value, str) else "loaded"))
    columns = sorted(df.columns)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    mine = sorted((tuple(r) for r in df.select(*columns).collect()), key=key)
    theirs = sorted(con.execute(f"select {', '.join(columns)} from ({sql})").fetchall(), key=key)
    assert mine == theirs


@pytest.mark.parametrize("name", SQL)
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, name, sf):
    path = f"/root/testdata/{sf}"
    compare(registry.QUERIES[name](spark, path), registry.ORACLE[name], {"documents": f"{path}/documents.parquet"})


def test_quality_on_hard_rows(spark, hard, empty):
    compare(op01_quality.quality(hard).select(*op01_quality.OUTPUT), op01_quality.oracle(), {"documents": hard.toArrow()})
    assert op01_quality.quality(empty).count() == 0


def test_repeated_windows(spark):
    def count(text):
        words = F.filter(F.split(F.lit(text), " "), lambda w: w != "")
        return spark.range(1).select(op01_quality.repeat_words(words).alias("n")).first().n

    assert count("a b c x a b c") == 6
    assert count("a a a a") == 4
    assert count("a b c d e f") == 0
    assert count("a b") == 0
    assert count("a b c d a b c d a b c d") == 12


def test_quality_rejects_junk_and_keeps_prose(spark):
    prose = " ".join(f"the river{k} of stones{k} and a hill{k}" for k in range(30))
    rows = [(1, prose), (2, prose.upper()), (3, " ".join(w + "###" for w in prose.split())), (4, "the of and " * 200), (5, "short text")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.kept for r in op01_quality.quality(df).collect()} == {1: True, 2: False, 3: False, 4: False, 5: False}


def test_line_dedup_on_hard_rows(spark, hard, empty):
    got = op04_lines.dedup_lines(hard, "counts_of_lines")
    assert got.columns == [*hard.columns, "counts_of_lines"]
    rows = sorted(((r[0], r[1]) for r in HARD_ROWS), key=lambda r: (r[0] is None, r[0] or 0, md5((r[1] or "").encode()).digest()))
    want = sorted(zip((i for i, _ in rows), line_dedup(rows)), key=str)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == want
    assert op04_lines.dedup_lines(empty, "counts_of_lines").count() == 0


def test_line_dedup_takes_repeats_in_the_order_of_its_sql(spark, hard):
    compare(op04_lines.dedup_lines(hard, "counts").select("doc_id", "counts.*", F.md5("text").alias("clean_md5")), op04_lines.ORACLE, {"documents": hard.toArrow()})
    rows = [(1, PASSAGE), (1, PASSAGE), *((2, f"{PASSAGE}\n{k}") for k in range(6)), (None, PASSAGE), (None, f"{PASSAGE}\n{PASSAGE}"), (3, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = op04_lines.dedup_lines(df).select("doc_id", "lines.*", F.md5("text").alias("clean_md5"))
    assert [r.n_removed for r in got.where("doc_id = 1").collect()] == [0, 0]
    compare(got, op04_lines.ORACLE, {"documents": df.toArrow()})
    apart = [(7, f"{PASSAGE}\n{k}") for k in range(6)]
    df = spark.createDataFrame(apart, "doc_id long, text string")
    got = op04_lines.dedup_lines(df).select("doc_id", "lines.*", F.md5("text").alias("clean_md5"))
    assert sum(r.n_removed == 0 for r in got.collect()) == 1
    compare(got, op04_lines.ORACLE, {"documents": df.toArrow()})


def test_line_dedup_merges_overlapping_windows(spark):
    block = "\n".join(f"line number {k}" for k in range(6))
    df = spark.createDataFrame([(1, f"a\n{block}\nb"), (2, f"c\n{block}\nd"), (3, f"{PASSAGE}\nx\ny")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in op04_lines.dedup_lines(df).collect()} == {1: f"a\n{block}\nb", 2: "c\nd", 3: f"{PASSAGE}\nx\ny"}


def test_mix_on_hard_rows(spark, hard, empty):
    got = op10_mix.mix(hard, name="placement", block_chars=1000)
    assert got.columns == [*hard.columns, "placement"] and got.count() == len(HARD_ROWS)
    placed = got.select("doc_id", "source", "placement.*")
    compare(placed, op10_mix.oracle(block_chars=1000), {"documents": hard.toArrow()})
    assert op10_mix.mix(empty, name="placement").count() == 0
    assert op10_mix.mixed(empty).count() == 0
    assert sorted(op10_mix.mixed(hard).select("doc_id", "text").collect(), key=str) == sorted(hard.select("doc_id", "text").collect(), key=str)


@pytest.mark.parametrize("weights", [{"a": 5, "b": 3, "c": 1}, {"a": 1, "b": 1, "c": 1}, {"a": 97, "b": 2}, None])
def test_schedule_deviates_by_less_than_a_block(spark, weights):
    chars = spark.createDataFrame([("a", 900), ("b", 90), ("c", 9), (None, 1)], "source string, chars long")
    slots = op10_mix.period(op10_mix.source_weights(chars, weights, units=50)).collect()
    length = slots[0].period
    assert sorted(r.slot for r in slots) == list(range(length))
    for source in {r.source for r in slots}:
        mine = sorted((r for r in slots if r.source == source), key=lambda r: r.slot)
        assert [r.k for r in mine] == list(range(mine[0].units))
        for k, r in enumerate(mine):
            assert k * length // r.units <= r.slot < -(-(k + 1) * length // r.units)
        for t in range(length + 1):
            run = sum(r.slot < t for r in mine)
            assert abs(run - t * mine[0].units / length) < 1


def test_mix_order_follows_the_weights(spark):
    rows = [(k, "x" * 100, None, "big" if k % 10 else "small", 100) for k in range(2000)]
    got = op10_mix.mix(hard_documents(spark, rows, clashes=False), {"big": 1, "small": 1}, block_chars=400)
    order = [r.source for r in got.orderBy("mix.slot", "mix.start").select("source").collect()]
    for n in range(1, 390):
        assert abs(order[:n].count("small") - n / 2) <= 5
