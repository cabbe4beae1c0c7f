"""Operator 12 against its SQL, which counts every phrase of every piece."""

from __future__ import annotations

import glob
import random
import time

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from plain import HARD_ROWS

from adspend.llm import op12_collocations as op12
from adspend.llm import registry


def by_sql(rows, **options):
    con = duckdb.connect()
    con.register("documents", pa.table({"text": pa.array([r[1] for r in rows], pa.string()), "lang": pa.array([r[2] for r in rows], pa.string())}))
    return sorted(con.sql(op12.oracle(**options)).fetchall())


def prose():
    rng = random.Random(4)
    words = ["alpha", "Beta", "gamma", "DELTA", "e", "é", "\x1codd", "日本", "x\x85y"]
    marks = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "; ", "\x0b", "! "]
    return [(k, "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randrange(120))), rng.choice(["en", "en", "de", None, ""]), None, None) for k in range(60)]


def check(spark, rows, **options):
    df = spark.createDataFrame([(r[1], r[2], 1, "x", 2) for r in rows], "text string, lang string, n long, phrase string, Size int").repartition(3)
    got = sorted(tuple(r) for r in op12.collocations(df, **options).collect())
    assert got == by_sql(rows, **options)
    return got


def test_collocations_query(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    got = sorted(tuple(r) for r in registry.QUERIES["op12_collocations"](spark, folder).collect())
    assert got == sorted(con.sql(registry.ORACLE["op12_collocations"]).fetchall()) and got


def test_collocations_on_hard_rows(spark):
    got = check(spark, [*HARD_ROWS, *prose()], least=3, top=50)
    assert {r[0] for r in got} >= {"en", "de", "und"}
    assert check(spark, [], least=3) == []


@pytest.mark.parametrize("bits, every", [(8, 2), (20, 1), (20, 5)])
def test_counts_do_not_rest_on_the_filter_or_the_cuts(spark, monkeypatch, bits, every):
    monkeypatch.setattr(op12, "FILTER_BITS", max(bits, 15))
    monkeypatch.setattr(op12, "CUT_EVERY", every)
    monkeypatch.setattr(op12, "CALL_BYTES", 2000)
    check(spark, prose(), least=2, share=90, top=30)


def test_a_full_filter_lets_all_through(spark, monkeypatch):
    rows = prose()
    want = by_sql(rows, least=2)
    full = spark.sparkContext.broadcast(b"\xff" * (1 << op12.FILTER_BITS - 3))
    monkeypatch.setattr(op12, "bitmap_of", lambda *_: full)
    assert check(spark, rows, least=2) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("aBcde \t.\n,é", max_size=90), max_size=5))
def test_chunks_hold_each_phrase_once(texts):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(op12, "CUT_EVERY", 3)
        once(texts)


def once(texts):
    plain: dict = {}
    for text in texts:
        for mark in ".,\n":
            text = text.replace(mark, "\n")
        for piece in text.replace("B", "b").split("\n"):
            words = piece.replace("\t", " ").split(" ")
            words = [w for w in words if w]
            for k in range(len(words)):
                for n in range(1, 6):
                    if k + n <= len(words):
                        phrase = " ".join(words[k:k + n])
                        plain[phrase] = plain.get(phrase, 0) + 1
    chunks, last, own, row = op12.chunks_of(pa.array(texts, pa.string()))
    found: dict = {}
    for chunk, end, n_own in zip(chunks.to_pylist(), last, own):
        pieces = [piece.split(" ") for piece in chunk.split("\n")]
        words = [(piece, k) for piece in pieces for k in range(len(piece))]
        assert n_own == len(words) - (0 if end else op12.OVERLAP)
        for piece, k in words[:n_own]:
            for n in range(1, 6):
                if k + n <= len(piece):
                    phrase = " ".join(piece[k:k + n])
                    found[phrase] = found.get(phrase, 0) + 1
    assert found == plain


def test_pairs_are_counted_by_hashes_before_their_strings():
    texts = ["a b a b c. a b", "c a b"]
    table = pa.table({"lang": ["en", "en"], "chunk": [op12.chunks_of(pa.array([t]))[0][0].as_py() for t in texts],
                      "last": [True, True], "times": [1, 3]})
    part = op12.Dictionary(table)
    every = np.ones(len(part.codes), bool)
    for n, most in ((1, 6), (2, 6)):
        codes, strings = part.hashed(n, every), part.exact(n, every)
        assert codes.column_names == ["code", "times"]
        assert sorted(codes.column("times").to_pylist()) == sorted(strings.column("times").to_pylist())
        assert max(codes.column("times").to_pylist()) == most
    assert part.hashed(2, ~every).num_rows == 0


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for f in glob.glob(f"{d.getPath()}/**/shuffle_*", recursive=True)}


def test_no_step_leaves_its_shuffle_files(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, before = spark.conf.get(name), shuffle_files(spark)
    docs = spark.createDataFrame([(r[1], r[2]) for r in prose()], "text string, lang string").repartition(3)
    known, totals = op12.frequent(docs, 3)
    ends = time.time() + 20  # they are removed in the background
    while shuffle_files(spark) - before and time.time() < ends:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(name) == setting
    assert known.count() and totals.count()


@pytest.mark.parametrize("held", [1 << 20, 40, 1])
def test_a_task_sends_its_sums_as_lists(monkeypatch, held):
    monkeypatch.setattr(op12, "HELD_ROWS", held)
    rng = random.Random(7)
    rows = [[(rng.randrange(5), rng.choice(["en", "de"]), rng.choice("abcdefgh") * 2, rng.randrange(1, 9)) for _ in range(60)] for _ in range(30)]
    tables = [pa.table([pa.array(c) for c in zip(*part)], ["bucket", "lang", "phrase", "times"]) for part in rows]
    sent = [op12.packed(t) for t in op12.summed_up(tables)]
    want: dict = {}
    for bucket, lang, phrase, times in (r for part in rows for r in part):
        want[bucket, lang, phrase] = want.get((bucket, lang, phrase), 0) + times
    got: dict = {}
    for table in sent:
        keys = list(zip(table.column("bucket").to_pylist(), table.column("lang").to_pylist()))
        assert len(set(keys)) == len(keys) == len(set((b, x) for b, x, _ in want))
        for k in range(table.num_rows):
            for r in op12.unpacked(table.slice(k, 1)).to_pylist():
                key = (keys[k][0], r["lang"], r["phrase"])
                got[key] = got.get(key, 0) + r["times"]
    assert got == want
    assert held < 1000 or len(sent) == 1
    assert list(op12.summed_up([])) == []
