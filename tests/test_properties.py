"""Whole-run properties on the driver tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import functions as F

from adspend.params import DEFAULT_PARAMS as P
from adspend.params import SCENARIO_ORDER
from adspend.plans import allocation as pl
from adspend.sources.fixtures import fixture_inputs

from support import SF_MID, SF_SMALL

KEY = ["publisher_id", "publisher_cpc", "camp_id"]


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_fused_arbitration_equals_sequential_loop(spark):
    """Brute force: stage by stage, insert a candidate unless an earlier stage wrote its key.

    Each stage's candidates are collected (a few hundred rows here) and the ladder
    runs as a literal Python loop with a fresh key snapshot per stage.
    """
    inputs = fixture_inputs(spark, SF_MID, P)
    cols = KEY + ["target_spend", "step_num"]
    ledger, keys = [], set()
    for step in SCENARIO_ORDER:
        rows = _rows(pl.scenario_candidates(inputs, P, step), cols)
        snapshot = set(keys)
        for r in rows:
            if r[:3] not in snapshot:
                ledger.append(r)
                keys.add(r[:3])
    fused = _rows(pl.scenario_ledger(inputs, P), cols)
    assert fused == sorted(ledger)
    assert len(fused) == 1499


def test_final_ledger_has_unique_keys_and_bounded_spend(spark):
    ledger = pl.allocate(fixture_inputs(spark, SF_MID, P), P).cache()
    assert ledger.count() == ledger.select(*KEY).distinct().count() == 3144
    bounded = ledger.filter(F.col("step_num").isin(0, 2, 3, 4, 41, 5, 6, 7, 8, 9))
    assert bounded.filter((F.col("target_spend") <= 0) | (F.col("target_spend") > 100)).count() == 0
    assert ledger.filter(F.col("date_date") != F.lit(P.target_date)).count() == 0
    ledger.unpersist()


def test_rerun_overwrites_the_date_partition(spark):
    inputs = fixture_inputs(spark, SF_SMALL, P)
    out = tempfile.mkdtemp(prefix="adspend-test-ledger-")
    pl.write_ledger(pl.allocate(inputs, P), out)
    first = _rows(spark.read.parquet(out), ["publisher_id", "publisher_cpc", "camp_id", "target_spend"])
    pl.write_ledger(pl.allocate(inputs, P), out)
    second = _rows(spark.read.parquet(out), ["publisher_id", "publisher_cpc", "camp_id", "target_spend"])
    assert first == second and len(first) > 0


def test_stage_counts_at_sf001(spark):
    """Counts of every phase on the sf0.01 mapping (FIXTURES.md section 3)."""
    inputs = fixture_inputs(spark, SF_MID, P)
    expected = {"stage_12": 96, "stage_13": 103, "stage_14": 116, "stage_15": 146, "stage_16": 191,
                "stage_10": 55, "stage_11": 152, "feed_ids": 2009, "active_flags": 956 + 418 + 337,
                "stage_601": 1135}
    for name, n in expected.items():
        assert pl.phase_rows(inputs, P, name).count() == n, name


def test_run_daily_writes_partition_and_reports(spark):
    from adspend.params import AllocParams
    inputs = fixture_inputs(spark, SF_SMALL, P)
    out = tempfile.mkdtemp(prefix="adspend-test-daily-")
    report = pl.run_daily(spark, inputs, P, out)
    expected = _rows(pl.stage_row_counts(inputs, P), ["phase", "rows"])
    assert sorted(report.items()) == expected and sum(report.values()) > 0
    ledger = pl.scenario_ledger(inputs, P)
    assert report["stage_07"] == ledger.filter("step_num = 7").count()
    # another day's run leaves this day's partition in place
    other = AllocParams(run_date=P.run_date.replace(day=20))
    pl.run_daily(spark, fixture_inputs(spark, SF_SMALL, other), other, out, checkpoint=False)
    days = {r.date_date for r in spark.read.parquet(out).select("date_date").distinct().collect()}
    assert P.target_date in days


def test_run_daily_stops_without_eligible_advertisers(make):
    b = make()
    b.rows["users"].append((1, 1, "Acme", "managed", "us", None, None, None))
    b.vertical(1, "NA")
    out = tempfile.mkdtemp(prefix="adspend-test-empty-")
    assert pl.run_daily(b.spark, b.build(), P, out) == {}


def test_salting_hot_accounts_keeps_results(spark):
    """Treat almost every account as hot (tiny threshold): the ledger is unchanged."""
    from dataclasses import replace
    inputs = fixture_inputs(spark, SF_MID, P)
    salted = replace(P, hot_account_campaigns=3, account_salt_buckets=5)
    cols = KEY + ["target_spend", "step_num", "job_export_feed_id", "active_flag"]
    assert _rows(pl.allocate(inputs, salted), cols) == _rows(pl.allocate(inputs, P), cols)


def test_empty_rerun_empties_the_day(spark, make):
    out = tempfile.mkdtemp(prefix="adspend-test-rerun-")
    full = make().user(1).campaign(1, 1, 50, 0, 0.5).build()
    pl.run_daily(spark, full, P, out)
    assert spark.read.parquet(out).count() == 2
    idle = make().user(1).campaign(1, 1, 50, 49, 0.5).build()    # nothing to spend
    report = pl.run_daily(spark, idle, P, out)
    assert spark.read.schema(full_schema()).parquet(out).count() == 0 and sum(report.values()) == 0
    # the guard leaves the day as it is
    pl.run_daily(spark, full, P, out)
    none = make()
    none.rows["users"].append((1, 1, "Acme", "managed", "us", None, None, None))
    none.vertical(1, "NA")
    assert pl.run_daily(spark, none.build(), P, out) == {}
    assert spark.read.parquet(out).count() == 2


def full_schema():
    from adspend.schemas import LEDGER
    return LEDGER


def test_stored_rows_close_their_keys_and_join_the_phases(spark, make):
    """Stage 0 does not look at stored keys; stages 1-9 do; updates reach all stored rows."""
    from adspend.sources.tables import read_ledger
    out = tempfile.mkdtemp(prefix="adspend-test-stored-")
    day = P.target_date
    rows = [(day, 30647, 0.11, 1, 7.0, 3, None, 0),      # stage 0 proposes the same key
            (day, 30647, 0.11, 2, 7.0, 3, None, 0),      # stage 3 would propose the same key
            (day, 30647, 0.25, 3, 9.0, 7, None, 0)]      # campaign of no eligible user
    pl.write_ledger(spark.createDataFrame(rows, full_schema()), out, target_date=day)
    other = [(day.replace(day=3), 30647, 0.11, 1, 1.0, 3, None, 0)]
    pl.write_ledger(spark.createDataFrame(other, full_schema()), out, target_date=day.replace(day=3))
    b = make().user(1).user(2, status=0).campaign(1, 1, 50, 0, 0.5).campaign(2, 1, 50, 10, 0.3).campaign(3, 2, 50, 0, 0.5)
    b.click(1, 2, main=False)
    inputs = b.build()
    existing = read_ledger(spark, out, day)
    assert existing.count() == 3
    report = pl.run_daily(spark, inputs, P, out, existing=existing)
    got = sorted(tuple(r)[1:] for r in read_ledger(spark, out, day).collect())
    assert (30647, 0.11, 1, 7.0, 3, 2, 1) in got and (30647, 0.11, 1, 11.0, 0, 2, 1) in got
    assert [r for r in got if r[2] == 2] == [(30647, 0.11, 2, 7.0, 3, 2, 1)]
    assert [r for r in got if r[2] == 3] == [(30647, 0.25, 3, 9.0, 7, 3, 1)]
    assert report["stage_00"] == 1 and report["stage_03"] == 0 and report["feed_ids"] == 4
    assert read_ledger(spark, out, day.replace(day=3)).count() == 1


def test_unknown_policy_rows_fail_the_run(spark, make):
    import pytest
    from adspend.sources.tables import check_inputs
    for row in (("exclude", "camp", 1, 0.33), ("exlcude", "user", 1, 0.11), ("include", "users", 1, 0.11),
                ("exclude", "user", 1, 0.2500001), ("include", "user", 1, None), ("premium_feed", "camp", 1, None)):
        inputs = make().user(1).campaign(1, 1, 50, 0, 0.5).policy(*row).build()
        with pytest.raises(Exception, match="unknown client_policy row"):
            pl.allocate(inputs, P).collect()
        with pytest.raises(ValueError, match="1 unknown rows in client_policy"):
            check_inputs(inputs)


def test_every_price_can_be_excluded_and_included(spark, make):
    b = make().user(1).policy("premium_feed", "user", 1).campaign(1, 1, None, 5, 0.6)
    b.policy("exclude", "user", 1, 0.41)
    b.user(2).campaign(2, 2, 50, 49, 0.6).policy("include", "user", 2, 0.41)
    rows = {(r.camp_id, r.publisher_cpc, r.target_spend, r.step_num) for r in pl.allocate(b.build(), P).collect()}
    assert (1, 0.41, 0.0, 10) in rows and (2, 0.41, 41.0, 11) in rows


def test_repeated_keys_are_found_on_load(spark, make):
    import pytest
    from adspend.sources.tables import check_inputs, duplicate_keys
    good = make().user(1).user(2).campaign(1, 1, 50, 0, 0.5)
    assert duplicate_keys(good.build()) == {}
    check_inputs(good.build())
    bad = make().user(1).user(1, vertical=False).campaign(1, 1, 50, 0, 0.5).campaign(1, 1, 50, 0, 0.5)
    assert duplicate_keys(bad.build()) == {"campaigns": 1, "users": 1}
    with pytest.raises(ValueError, match="1 repeated keys in campaigns"):
        check_inputs(bad.build())


def test_links_from_other_days_still_count(make):
    """A link belongs to its click, whatever the day of its batch and the order of the ids."""
    from adspend.operators import facts
    b = make().user(1).campaign(1, 1, 50, 10, 0.5).batch(21, 2, day=P.run_date.replace(day=1))
    b.click(500, 1, cost=0.2, batches=(21,)).click(3, 1, cost=0.2, batches=(21,))
    b.click(100, 1, cost=0.2, day=P.run_date.replace(day=14), batches=(21,))
    (row,) = facts.click_facts(b.build(), P).collect()
    assert row.rows_011 == 2 and row.clk_011 == 2
