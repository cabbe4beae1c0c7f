"""Stored days: a failing write changes nothing, a run reads its own day of links and exports only."""

from __future__ import annotations

import datetime as dt
import tempfile
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from adspend.operators import facts
from adspend.params import DEFAULT_PARAMS as P
from adspend.plans import allocation as pl
from adspend.plans.catalog import REGISTRY
from adspend.schemas import LEDGER
from adspend.sources.fixtures import fixture_inputs
from adspend.sources.tables import add_exports, add_links, read_ledger, read_parquet_inputs, write_parquet_inputs
from support import RUN, SF_SMALL
from test_plan import _rows_read

DAY = P.target_date


def rows_of(day, n):
    return [(day, 30647, 0.11, k, 7.0, 3, None, 0) for k in range(n)]


def test_a_failing_write_leaves_the_earlier_rows(spark):
    out = tempfile.mkdtemp(prefix="adspend-test-atomic-")
    for day, n in ((DAY, 5), (DAY.replace(day=3), 2)):
        pl.write_ledger(spark.createDataFrame(rows_of(day, n), LEDGER), out, target_date=day)
    late = spark.createDataFrame(rows_of(DAY, 40), LEDGER).repartition(8)
    broken = late.withColumn("target_spend", F.when(F.col("camp_id") == 39, F.raise_error(F.lit("a task fails")).cast("double")).otherwise(1.0))
    with pytest.raises(Exception, match="a task fails"):
        pl.write_ledger(broken, out, target_date=DAY)
    assert sorted(tuple(r) for r in read_ledger(spark, out, DAY).collect()) == rows_of(DAY, 5)
    pl.write_ledger(late, out, target_date=DAY)
    assert read_ledger(spark, out, DAY).count() == 40
    pl.write_ledger(spark.createDataFrame([], LEDGER), out, target_date=DAY)
    assert read_ledger(spark, out, DAY).count() == 0 and read_ledger(spark, out, DAY.replace(day=3)).count() == 2


def test_repeated_keys_stop_the_run_before_it_writes(spark, make):
    out = tempfile.mkdtemp(prefix="adspend-test-keys-")
    pl.run_daily(spark, make().user(1).campaign(1, 1, 50, 0, 0.5).build(), P, out)
    before = sorted(map(str, read_ledger(spark, out, DAY).collect()))
    assert before
    for again in (make().user(1).campaign(1, 1, 50, 0, 0.5).campaign(1, 1, 60, 0, 0.5), make().user(1).user(1).campaign(1, 1, 50, 0, 0.5)):
        with pytest.raises(ValueError, match="repeated keys"):
            pl.run_daily(spark, again.build(), P, out)
        assert sorted(map(str, read_ledger(spark, out, DAY).collect())) == before


@pytest.fixture(scope="module")
def stored(spark):
    """Inputs with ids that do not rise with time: years of links and exports around those of the run."""
    inputs = fixture_inputs(spark, SF_SMALL, P)
    mixed = lambda c: F.xxhash64(c)
    old_clicks = spark.range(1, 20_000).select(mixed("id").alias("record_id"), (F.col("id") % 50).alias("camp_id"), F.expr("date_add(DATE'2021-01-01', cast(id % 40 as int))").alias("date_date"),
                                               F.lit(30647).alias("partner_source"), F.lit(99).alias("reason_code"), F.lit(1).cast("decimal(12,4)").alias("click_cost"))
    old_batches = spark.range(1, 41).select((-F.col("id")).alias("id"), F.lit(2).alias("feed"), F.expr("date_add(DATE'2021-01-01', cast(id as int))").alias("date"), F.lit(30647).alias("publisher"))
    mine = replace(
        inputs,
        ad_clicks=inputs.ad_clicks.withColumn("record_id", mixed("record_id")).unionByName(old_clicks),
        click_batches=inputs.click_batches.withColumn("click_id", mixed("click_id")).unionByName(old_clicks.select(F.col("record_id").alias("click_id"), F.lit(-5).cast("long").alias("batch_id"))),
        export_batches=inputs.export_batches.unionByName(old_batches),
        export_campaign_stats=inputs.export_campaign_stats.unionByName(spark.range(1, 30_000).select((F.col("id") % 50).alias("camp_id"), (-(F.col("id") % 40) - 1).alias("batch_id"))))
    base = tempfile.mkdtemp(prefix="adspend-test-days-")
    write_parquet_inputs(mine, base)
    return inputs, mine, base


def test_a_run_reads_its_day_of_links_and_exports(spark, stored):
    plain, mine, base = stored
    inputs = read_parquet_inputs(spark, base)
    want = sorted(tuple(r) for r in pl.allocate(plain, P).collect())
    run = pl.allocate(inputs, P)
    assert sorted(tuple(r) for r in run.collect()) == want
    today = mine.clicks_of(P).select(F.col("record_id").alias("click_id")).distinct()
    links = mine.click_batches.join(today, "click_id").count()
    assert 0 < links < mine.click_batches.count() / 2
    for df in (run, REGISTRY["join_click_feed"].build(inputs, P)):
        assert _rows_read(spark, df, "/click_batches") == links
    exports = mine.export_campaign_stats.join(mine.export_batches.filter(F.to_date("date") == F.lit(RUN)), F.col("batch_id") == F.col("id")).count()
    assert _rows_read(spark, facts.exported_today(inputs, P), "/export_campaign_stats") == exports < mine.export_campaign_stats.count() / 2


def test_days_that_arrive_are_appended(spark, stored):
    plain, _, _ = stored
    base = tempfile.mkdtemp(prefix="adspend-test-arrive-")
    is_run = F.col("date_date") == F.lit(RUN)
    early = plain.ad_clicks.filter(~is_run).select("record_id")
    before = replace(plain, click_batches=plain.click_batches.join(early, F.col("click_id") == F.col("record_id"), "left_semi"),
                     export_campaign_stats=plain.export_campaign_stats.limit(0))
    write_parquet_inputs(before, base)
    late = plain.click_batches.join(plain.ad_clicks.filter(is_run), F.col("click_id") == F.col("record_id"), "left_semi")
    add_links(late, plain.ad_clicks.filter(is_run), base)
    add_exports(plain.export_campaign_stats, plain.export_batches, base)
    got = pl.allocate(read_parquet_inputs(spark, base), P)
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in pl.allocate(plain, P).collect())


def test_links_without_a_click_are_kept_apart(spark, make):
    base = tempfile.mkdtemp(prefix="adspend-test-lost-")
    b = make().user(1).campaign(1, 1, 50, 0, 0.5).batch(9, 2).click(1, 1, batches=(9,)).click(2, 1, day=dt.date(2024, 1, 14), batches=(9,))
    b.rows["click_batches"] += [(77, 9), (None, 9)]
    write_parquet_inputs(b.build(), base)
    read = read_parquet_inputs(spark, base)
    assert sorted((r.click_id or -1, str(r.click_date)) for r in read.click_batches.collect()) == [(-1, "None"), (1, "2024-01-15"), (2, "2024-01-14"), (77, "None")]
    assert facts.links_of(read, read.clicks_of(P), P).count() == 1
