"""Click rollups by load: adding them up equals the scan of all clicks, whatever arrives late."""

from __future__ import annotations

import datetime as dt
import random
import tempfile
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from adspend.functions.spend import exact_clicks
from adspend.operators import facts, rollups
from adspend.params import DEFAULT_PARAMS as P
from adspend.plans import allocation as pl
from adspend.sources.fixtures import fixture_inputs
from adspend.sources.tables import read_parquet_inputs, write_parquet_inputs
from support import RUN, SF_SMALL
from test_plan import _rows_read


def stored_loads(spark, inputs, loads, click_at, link_at, path):
    """Stores ``loads`` in order; ``click_at`` and ``link_at`` give the load in which a row arrives."""
    clicks, links = inputs.ad_clicks.withColumn("at", click_at), inputs.click_batches.withColumn("at", link_at)
    for k in range(loads):
        here, before = F.col("at") == k, F.col("at") < k
        sums = rollups.load_sums(clicks.filter(here), links.filter(here), inputs.export_batches, clicks.filter(before), links.filter(before))
        rollups.store_load(sums, f"h{k}", path)
    return rollups.read_rollups(spark, path)


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def loaded(spark):
    inputs = fixture_inputs(spark, SF_SMALL, P)
    path = tempfile.mkdtemp(prefix="adspend-test-loads-")
    read = stored_loads(spark, inputs, 4, F.pmod(F.xxhash64("record_id"), F.lit(4)), F.pmod(F.xxhash64("batch_id", "click_id"), F.lit(4)), path)
    return inputs, read, path


def test_added_loads_equal_the_full_scan(loaded):
    inputs, read, _ = loaded
    for day in (RUN, RUN - dt.timedelta(days=1)):
        params = replace(P, run_date=day)
        want = rows_of(facts.click_facts(inputs, params))
        assert want and rows_of(facts.click_facts(replace(inputs, click_rollups=read), params)) == want


def test_a_run_over_loads_reads_no_click(spark, loaded):
    inputs, read, _ = loaded
    base = tempfile.mkdtemp(prefix="adspend-test-loads-run-")
    write_parquet_inputs(replace(inputs, click_rollups=read), base)
    run = pl.allocate(replace(read_parquet_inputs(spark, base), click_rollups=read), P)
    assert rows_of(run) == rows_of(pl.allocate(inputs, P))
    plan = run._jdf.queryExecution().optimizedPlan().toString()
    assert "reason_code" not in plan and "click_id" not in plan
    campaigns_today = read.filter(F.col("date_date") == F.lit(RUN)).count()
    assert _rows_read(spark, facts.click_facts(replace(inputs, click_rollups=read), P), "adspend-test-loads") == campaigns_today


def test_a_load_stored_again_counts_once(spark, loaded):
    inputs, _, _ = loaded
    path = tempfile.mkdtemp(prefix="adspend-test-again-")
    at = F.pmod(F.xxhash64("record_id"), F.lit(2)), F.pmod(F.xxhash64("click_id"), F.lit(2))
    stored_loads(spark, inputs, 2, *at, path)
    read = stored_loads(spark, inputs, 2, *at, path)
    assert rows_of(facts.click_facts(replace(inputs, click_rollups=read), P)) == rows_of(facts.click_facts(inputs, P))


def test_links_before_and_after_their_click_repeats_and_nulls(spark, make):
    b = make().batch(1, 2).batch(2, 3).batch(3, 2).batch(4, None).batch(5, 7)
    b.click(10, 1, cost=0.3, batches=(1, 1, 2)).click(10, 1, cost=0.5).click(11, 1, main=False, batches=(1, 4))
    b.click(12, 2, billable=False, batches=(3,)).click(None, 2, batches=()).click(13, None, batches=(2, 5))
    b.click(14, 3, cost=None, batches=(2,))
    b.rows["click_batches"] += [(None, 1), (99, 2), (12, 77)]
    inputs = b.build()
    rng = random.Random(5)
    want = rows_of(facts.click_facts(inputs, P))
    for _ in range(3):
        seed = rng.randrange(10 ** 6)
        path = tempfile.mkdtemp(prefix="adspend-test-mixed-")
        read = stored_loads(spark, inputs, 3, F.pmod(F.xxhash64(F.lit(seed), "record_id", "click_cost"), F.lit(3)), F.pmod(F.xxhash64(F.lit(seed), "click_id", "batch_id"), F.lit(3)), path)
        assert rows_of(facts.click_facts(replace(inputs, click_rollups=read), P)) == want


def test_no_clicks(spark, make):
    inputs = make().batch(1, 2).build()
    sums = rollups.load_sums(inputs.ad_clicks, inputs.click_batches, inputs.export_batches, inputs.ad_clicks, inputs.click_batches)
    assert sums.count() == 0 and rollups.merge(sums).count() == 0


def test_exact_clicks_do_not_depend_on_the_order(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(1, 10 ** 6) / 100, rng.choice([0.11, 0.25, 0.41])) for _ in range(5000)] + [(None, 0.11), (5.0, None)]
    whole = sum(round(s * 100) * 11275 // round(p * 100) for s, p in rows if s and p)
    got = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        got.add(spark.createDataFrame(rows, "s double, p double").repartition(2 + seed).agg(exact_clicks(F.col("s"), F.col("p")).alias("n")).first().n)
    assert got == {whole * 100 / 1127500}
    with pytest.raises(Exception, match="not a price point"):
        spark.createDataFrame([(1.0, 0.5)], "s double, p double").agg(exact_clicks(F.col("s"), F.col("p"))).collect()


def test_a_large_day_of_a_load_is_written_by_several_tasks(spark):
    sums = spark.range(2000).select(F.lit(RUN).alias("date_date"), F.col("id").alias("camp_id"), *[F.lit(1).cast("long").alias(c) for c in facts.CLICK_SUMS])
    path = tempfile.mkdtemp(prefix="adspend-test-wide-")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    held = spark.conf.get(key)
    spark.conf.set(key, "false")  # as with a load that is too large for one task
    try:
        rollups.store_load(sums, "h0", path)
    finally:
        spark.conf.set(key, held)
    read = rollups.read_rollups(spark, path)
    assert read.count() == 2000 and len(read.inputFiles()) > 1
