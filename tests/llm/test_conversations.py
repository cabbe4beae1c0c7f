"""Operator 13 against every possible repair."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from plain import faults, repaired, repairs
from pyspark.sql import functions as F

from adspend.llm import op13_conversations as op13
from adspend.llm import registry

SCHEMA = "conv_id long, turn long, role string, text string"
CLASHES = ("kind", "copies", "part", "block", "codes", "rows", "first", "last", "late", "audit", "start", "final", "gaps")
ROLES = st.sampled_from(["system", "user", "assistant", "tool", "", "uncle", " "])
WORDS = st.sampled_from(["a.", "b!", "c", "", " \n", "d?"])


def rebuilt(rows, cut=None):
    """Cost, letters and lines by the operator's functions, in one block or in blocks cut at ``cut``."""
    kinds = faults(rows)
    codes = bytes(op13.GONE if k in ("blank", "duplicate") else op13.code(r[0][:1], k == "truncated") for r, k in zip(rows, kinds))
    if cut is None:
        audit, cost, lines = op13.rebuild(codes, rows, 0, op13.END, bool(codes))
        return cost, audit, tuple(lines)
    edges = [0, *cut, len(rows)]
    pieces = [slice(a, b) for a, b in zip(edges, edges[1:]) if a < b]
    states = op13.path([op13.block_step(codes[p]) for p in pieces], 0, op13.END)
    cost, audit, lines, at = 0, "", (), 0
    for k, p in enumerate(pieces):
        last = k == len(pieces) - 1
        a, c, more = op13.rebuild(codes[p], rows[p], at, op13.END if last else op13.from_state(states[k])[0], last)
        cost, audit, lines, at = cost + c, audit + a, lines + tuple(more), states[k]
    return cost, audit, lines


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(ROLES, WORDS), max_size=5), st.sets(st.integers(1, 4)))
def test_repair_is_the_least_of_all(rows, cuts):
    want = min(repairs(rows, faults(rows)))
    assert min(repairs(rows, faults(rows), every=False)) == want
    assert rebuilt(rows) == want
    assert rebuilt(rows, sorted(c for c in cuts if c < len(rows))) == want


def hard_rows():
    rng = random.Random(3)
    rows = [(1, None, None, None), (1, 0, "user", "Hello."), (1, 1, "assistant", None), (None, 3, "user", "no conversation."), (None, None, "user", "x"),
            (2, 5, "user", "same."), (2, 5, "user", "same."), (2, 5, "assistant", "same."), (2, -4, "system", "s."), (2, 900, "tool", "t!"),
            (3, 0, "", ""), (4, 0, "user", "long. " * 50_000), (4, 1, "assistant", "x" * 100_000)]
    rows += [(5 + k % 7, rng.choice([None, *range(6)]), rng.choice(["system", "user", "assistant", "bot"]), rng.choice(["a.", "b", "", "c!", "q?"])) for k in range(35)]
    return rows


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).select("*", *(F.lit("x").alias(c) for c in CLASHES))
    got = op13.repair(df).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == repaired(rows)
    assert len(got) == len({r[0] for r in rows})


def test_conversations_on_hard_rows(spark):
    check(spark, hard_rows())
    assert op13.repair(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("rows_of_a_block", [1, 3])
def test_conversations_in_blocks(spark, monkeypatch, rows_of_a_block):
    monkeypatch.setattr(op13, "BLOCK_ROWS", rows_of_a_block)
    check(spark, hard_rows())


def test_one_long_conversation_is_the_same_in_any_blocks(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(7, k if k % 50 else None, rng.choice(["user", "assistant", "assistant", "user", "system"]), rng.choice([f"t{k}.", f"t{k}", "same.", "", "no"])) for k in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = op13.repair(df).collect()
    monkeypatch.setattr(op13, "BLOCK_ROWS", 64)
    assert op13.repair(df.repartition(5)).collect() == want
    assert len(want) == 1 and len(want[0].audit) >= want[0].blank


def test_conversations_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in registry.QUERIES["op13_conversations"](spark, "/root/testdata/sf0.01").collect()}
    assert got == repaired(rows)
