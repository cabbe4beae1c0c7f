"""Plan checks: one pruned click scan, no cartesian products, no Python in the plan."""

from __future__ import annotations

import contextlib
import re
import tempfile
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from adspend.params import DEFAULT_PARAMS as P
from adspend.plans import allocation as pl
from adspend.plans.catalog import REGISTRY
from adspend.sources.fixtures import fixture_inputs
from adspend.sources.tables import read_parquet_inputs, write_parquet_inputs

from support import SF_SMALL


def _executed_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_allocation_plan_shape(spark):
    base = tempfile.mkdtemp(prefix="adspend-test-inputs-")
    write_parquet_inputs(fixture_inputs(spark, SF_SMALL, P), base)
    plan = _executed_plan(pl.allocate(read_parquet_inputs(spark, base), P))
    final = plan.split("Initial Plan")[0]
    scans = [line for line in final.splitlines() if "FileScan parquet" in line and "/ad_clicks" in line]
    # besides the one scan of the clicks, only the range of their ids is read (links_of)
    click_scans = [line for line in scans if "ReadSchema: struct<record_id:bigint>" not in line]
    assert len(click_scans) == 1, click_scans
    assert all("2024-01-15" in line for line in scans)
    assert "PartitionFilters: [isnotnull(date_date" in click_scans[0]
    assert "2024-01-15" in click_scans[0]
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, bad
    # stage logic adds no exchange: every exchange sits below the final projection
    top = plan.split("Exchange", 1)[0]
    assert "Generate explode" in top


def test_scenarios_need_no_window_exchange(spark):
    plan = _executed_plan(pl.scenario_ledger(fixture_inputs(spark, SF_SMALL, P), P))
    assert "Window" not in plan
    assert not re.search(r"Exchange hashpartitioning\(publisher_id", plan)


LARGE = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@contextlib.contextmanager
def _conf(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _rows_read(spark, df, folder: str) -> int:
    """Rows that the scans of a folder read, from the metrics of the plan that ran."""
    df.collect()
    jvm_plan = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if name.startswith("Scan") and folder in node.simpleString(2000):
            found.append(node.metrics().apply("numOutputRows").value())
        for kind in (node.children(), node.subqueries()):
            for i in range(kind.size()):
                walk(kind.apply(i))

    walk(jvm_plan)
    return sum(found)


def test_links_of_other_days_are_not_read(spark):
    """Links from elsewhere, without a day, in files sorted by click id (stored ones have a day:
    ``test_days.py``). The whole run, with broadcasts off and no bloom filter (its creation side
    counts as too large), reads the row groups of the range of the run date's clicks only."""
    base = tempfile.mkdtemp(prefix="adspend-test-links-")
    inputs = fixture_inputs(spark, SF_SMALL, P)
    # years of history: ids below those of the run date, as ids are given in order of time
    history = spark.range(1, 400_000).select((-F.col("id")).alias("click_id"), (F.col("id") % 10).alias("batch_id"))
    links = inputs.click_batches.unionByName(history.select("click_id", "batch_id"))
    write_parquet_inputs(replace(inputs, click_batches=links.limit(0)), base)
    elsewhere = f"{base}/elsewhere/click_batches"
    links.repartitionByRange(8, "click_id").sortWithinPartitions("click_id").write.parquet(elsewhere)
    no_bloom = {"spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1",
                "spark.sql.files.maxPartitionBytes": "1m"}
    with _conf(spark, LARGE | no_bloom):
        df = pl.allocate(replace(read_parquet_inputs(spark, base), click_batches=spark.read.parquet(elsewhere)), P)
        assert "might_contain" not in df._jdf.queryExecution().optimizedPlan().toString()
        read = _rows_read(spark, df, "/click_batches")
    mine = inputs.click_batches.count()
    assert mine <= read < mine + 200_000


def test_entries_are_worked_out_once(spark):
    """No test of the array's size is inferred below the final explode, and the claims of the
    scenarios are generated code."""
    with _conf(spark, {"spark.sql.debug.maxToStringFields": "2000"}):
        df = pl.allocate(fixture_inputs(spark, SF_SMALL, P), P)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert not re.search(r"Filter .*size\(", plan)
        assert len(re.findall(r"AS step_011#", plan)) == 1 and len(re.findall(r"AS step_025#", plan)) == 1
        executed = _executed_plan(pl.scenario_ledger(fixture_inputs(spark, SF_SMALL, P), P))
    claims = [line for line in executed.splitlines() if "AS step_011#" in line]
    assert claims and not any("lambda" in line.split("AS step_011#")[0].rsplit("[", 1)[-1] for line in claims)


@pytest.mark.parametrize("name", ["agg_paid_clicks", "agg_revenue", "agg_avg_click_cost", "agg_having", "agg_multi_key",
                                  "agg_by_alias", "join_total_vs_feed"])
def test_no_raw_clicks_are_shuffled_by_campaign(spark, name):
    with _conf(spark, LARGE):
        plan = _executed_plan(REGISTRY[name].run(spark, SF_SMALL))
    lines = plan.split("Initial Plan")[0].splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    for i, line in enumerate(lines):
        if "FileScan parquet" in line and "/lineitem" in line and "l_discount" in line:
            above, level = [], depth(line)
            for up in reversed(lines[:i]):
                if depth(up) < level:
                    above.append(up)
                    level = depth(up)
            by_camp = next((k for k, up in enumerate(above) if "Exchange hashpartitioning(camp_id" in up), len(above))
            assert any("HashAggregate" in up and "partial_" in up for up in above[:by_camp]), name


@pytest.mark.parametrize("name, most", [
    ("union_price_points", {"click_batches": 1, "export_campaign_stats": 1}),
    ("union_inclusions", {"campaigns": 2, "users": 1}),
    ("union_exclusions", {"click_batches": 1, "export_campaign_stats": 1}),
    ("keyed_update", {"click_batches": 1, "export_campaign_stats": 1}),
    ("anti_join_exported", {"export_campaign_stats": 1})])
def test_registry_plans_evaluate_their_inputs_once(spark, name, most):
    base = tempfile.mkdtemp(prefix="adspend-test-inputs-")
    write_parquet_inputs(fixture_inputs(spark, SF_SMALL, P), base)
    df = REGISTRY[name].build(read_parquet_inputs(spark, base), P)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    for table, n in most.items():
        scans = [line for line in plan.splitlines() if "FileScan parquet" in line and f"/{table}]" in line.replace(", ", "]")]
        assert len(scans) <= n, (name, table, len(scans))


def test_raw_clicks_are_pre_aggregated_before_any_campaign_shuffle(spark):
    """With broadcasts off (large sides), raw clicks move only by record_id; the only
    camp_id exchange on the click side carries partial aggregates, so a hot campaign
    sends one row per task."""
    base = tempfile.mkdtemp(prefix="adspend-test-inputs-")
    write_parquet_inputs(fixture_inputs(spark, SF_SMALL, P), base)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plan = _executed_plan(pl.allocate(read_parquet_inputs(spark, base), P))
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan parquet" in line and "/ad_clicks" in line)
    # walk up from the click scan: the first camp_id exchange must sit above a partial aggregate
    above = lines[:scan][::-1]
    first_camp_exchange = next(i for i, line in enumerate(above) if "Exchange hashpartitioning(camp_id" in line)
    assert any("partial_" in line for line in above[:first_camp_exchange])
    assert any("Exchange hashpartitioning(record_id" in line for line in above[:first_camp_exchange])
