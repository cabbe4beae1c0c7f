"""The filter of running campaigns: same facts, fewer clicks into the join with the links."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from adspend.operators import eligibility as elig
from adspend.operators.campaign_filter import campaign_bitmap, may_be_of
from adspend.operators.facts import click_facts
from adspend.params import DEFAULT_PARAMS as P
from adspend.sources.fixtures import fixture_inputs
from dataclasses import replace

from support import SF_MID
from test_plan import LARGE, _conf


@pytest.fixture(scope="module")
def inputs(spark):
    return fixture_inputs(spark, SF_MID, P)


def of_running(facts, inputs):
    running = inputs.campaigns.filter(elig.running_campaign(P)).select("camp_id")
    return sorted(map(str, facts.join(running, "camp_id", "left_semi").collect()))


@pytest.mark.parametrize("bits", [15, 23])
def test_facts_of_running_campaigns_stay(inputs, bits):
    running = inputs.campaigns.filter(elig.running_campaign(P))
    params = replace(P, campaign_filter_bits=bits)
    want = of_running(click_facts(inputs, P), inputs)
    assert want and of_running(click_facts(inputs, params, running), inputs) == want


def test_only_the_clicks_of_the_campaigns_pass(spark):
    campaigns = spark.range(0, 3000, 3).select(F.col("id").alias("camp_id")).unionByName(spark.sql("select cast(null as bigint) camp_id"))
    clicks = spark.range(-3000, 6000).select(F.col("id").alias("camp_id"), (F.col("id") * 2).alias("record_id"))
    clicks = clicks.unionByName(spark.sql("select cast(null as bigint) camp_id, 1L record_id")).unionByName(clicks.limit(5))
    passed = may_be_of(clicks, campaigns, 23)
    assert passed.columns == clicks.columns
    ids = [r.camp_id for r in passed.collect()]
    assert set(range(0, 3000, 3)) <= set(ids) and None not in ids
    assert len(ids) <= 1000 + 5 + 20
    # with few bits more pass, and none of the campaigns' own is lost
    few = [r.camp_id for r in may_be_of(clicks, campaigns, 15).collect()]
    assert set(range(0, 3000, 3)) <= set(few) and len(few) < 2000
    assert may_be_of(clicks, campaigns.limit(0), 23).count() == 0 and may_be_of(clicks.limit(0), campaigns, 23).count() == 0


def test_the_filter_has_a_fixed_size(spark):
    for n in (10, 200_000):
        bitmap = campaign_bitmap(spark.range(n).select(F.col("id").alias("camp_id")), 18)
        assert bitmap.count() <= 8 and {len(r.bitmap) for r in bitmap.collect()} == {4096}
    with pytest.raises(ValueError, match="15 to 27 bits"):
        campaign_bitmap(spark.range(1).select(F.col("id").alias("camp_id")), 40)


def test_fewer_clicks_meet_their_links(spark, inputs):
    """With large sides: the rows that are shuffled by record_id are those of the running campaigns, and their scan tests the bit."""
    running = inputs.campaigns.filter(elig.running_campaign(P))
    today = inputs.clicks_of(P)
    mine, every = today.join(running, "camp_id", "left_semi").count(), today.count()
    passed = may_be_of(today, running, P.campaign_filter_bits).count()
    assert mine <= passed <= mine + 0.01 * every and passed < every
    with _conf(spark, LARGE):
        df = click_facts(inputs, P, running)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    lines = plan.splitlines()
    shuffled = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(record_id" in line)
    below = lines[shuffled:]
    assert any("getbit" in line or "bit_get" in line for line in below[:8]) and any("BroadcastHashJoin" in line for line in below[:8])
