"""Derive the allocation inputs from the driver's TPC-H-like test tables.

The test tables hold no advertising data, so each input is computed from them
by integer arithmetic and DECIMAL casts. The oracle SQL states the same mapping
as CTEs, so both engines start from identical inputs.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import replace
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adspend.params import (
    DEFAULT_PARAMS, MAIN_PUBLISHER, PARTNER_PUBLISHER, POLICY_EXCLUDE, POLICY_INCLUDE,
    POLICY_PREMIUM_BOOST, POLICY_PREMIUM_FEED, PRICE_011, PRICE_025, PRICE_041, AllocParams,
)
from adspend.schemas import CREDIT, INPUT_SCHEMAS, LEDGER, MONEY, conform
from adspend.sources.tables import AdInputs

# Fixed values of the test mapping.
CAMPAIGN_START = _dt.date(2024, 1, 1)
CAMPAIGN_END = _dt.date(2024, 1, 31)
CAMPAIGN_END_EARLY = _dt.date(2024, 1, 10)
OTHER_PARTNER_SOURCE = 11111
NON_BILLABLE_REASON = 1
EXCLUDED_COMPANY_SUFFIX = " Excluded Co"
VERTICAL_BY_SEGMENT = {"MACHINERY": "Job Board", "FURNITURE": "OTHER", "HOUSEHOLD": "NA"}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _campaigns(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    budget = F.when(k % 3 == 0, F.lit(None)).otherwise((F.lit(10) + (k * 7) % 90).cast(MONEY))
    cost_today = (
        F.when(k % 4 == 0, F.lit(0).cast(MONEY))
        .when(k % 4 == 1, F.coalesce(budget, F.lit(14).cast(MONEY)) - 2)
        .when(k % 4 == 2, F.lit(5).cast(MONEY))
        .otherwise(F.coalesce(budget, F.lit(10).cast(MONEY)))
    )
    return orders.select(
        k.alias("camp_id"),
        F.col("o_custkey").alias("user_id"),
        F.concat(F.lit("camp-"), k.cast("string")).alias("camp_name"),
        F.when(k % 13 == 0, "xml").otherwise("pjl").alias("camp_type"),
        F.when(k % 17 == 0, "no").otherwise("yes").alias("status"),
        F.lit(CAMPAIGN_START).alias("camp_start"),
        F.when(k % 19 == 0, F.lit(CAMPAIGN_END_EARLY)).otherwise(F.lit(CAMPAIGN_END)).alias("camp_end"),
        budget.alias("system_daily_budget"),
        cost_today.cast(MONEY).alias("cost_today"),
        ((k % 100).cast(MONEY) * F.lit(Decimal("0.01"))).cast(MONEY).alias("cost_per_click"),
    )


def _users(customer: DataFrame, campaigns: DataFrame) -> DataFrame:
    spent = campaigns.groupBy("user_id").agg(
        F.sum("cost_today").alias("spent"), F.sum("system_daily_budget").alias("bud"))
    c = F.col("c_custkey")
    zero = F.lit(0).cast(MONEY)
    budget = (
        F.when(c % 4 == 0, F.lit(None))
        .when(c % 4 == 1, F.coalesce("spent", zero) + 2)
        .when(c % 4 == 2, F.coalesce("spent", zero) + F.coalesce("bud", zero) + 200)
        .otherwise(F.lit(1))
    )
    return customer.join(spent, c == spent.user_id, "left").select(
        c.alias("id"),
        F.when(c % 23 == 0, 0).otherwise(1).alias("status"),
        F.concat(F.col("c_name"), F.when(c % 29 == 0, EXCLUDED_COMPANY_SUFFIX).otherwise("")).alias("company"),
        F.when(c % 11 == 0, "selfserve").otherwise("managed").alias("product"),
        F.when(F.col("c_nationkey") == 3, "ca").otherwise("us").alias("country"),
        F.col("c_acctbal").cast(CREDIT).alias("total_credits"),
        F.lit(500).cast(CREDIT).alias("total_debits"),
        budget.cast(MONEY).alias("account_system_daily_budget"),
    )


def _record_id() -> F.Column:
    return F.col("l_orderkey") * 1000000 + F.col("l_partkey") * 10 + F.col("l_linenumber")


def _ad_clicks(lineitem: DataFrame, params: AllocParams) -> DataFrame:
    day_before = params.run_date - _dt.timedelta(days=1)
    return lineitem.select(
        _record_id().alias("record_id"),
        F.col("l_orderkey").alias("camp_id"),
        F.when(F.col("l_linenumber") == 7, F.lit(day_before)).otherwise(F.lit(params.run_date)).alias("date_date"),
        F.when(F.col("l_partkey") % 3 == 0, OTHER_PARTNER_SOURCE).otherwise(MAIN_PUBLISHER).alias("partner_source"),
        F.when(F.col("l_quantity") == 1, NON_BILLABLE_REASON).otherwise(99).alias("reason_code"),
        (F.lit(Decimal("0.05")) + (F.col("l_discount") * 5).cast(MONEY)).cast(MONEY).alias("click_cost"),
    )


def _export_batches(supplier: DataFrame, params: AllocParams) -> DataFrame:
    s = F.col("s_suppkey")
    day_before = params.run_date - _dt.timedelta(days=1)
    return supplier.select(
        s.alias("id"),
        (s % 5).cast("int").alias("feed"),
        F.when(s % 7 == 0, F.lit(day_before)).otherwise(F.lit(params.run_date)).alias("date"),
        F.when(s % 2 == 0, MAIN_PUBLISHER).otherwise(PARTNER_PUBLISHER).alias("publisher"),
    )


def _advertiser_vertical(customer: DataFrame) -> DataFrame:
    seg = F.col("c_mktsegment")
    vertical = seg
    for segment, vtype in reversed(list(VERTICAL_BY_SEGMENT.items())):
        vertical = F.when(seg == segment, vtype).otherwise(vertical)
    return customer.select(
        F.col("c_custkey").alias("advertiser_id"),
        vertical.alias("type"),
        F.when(F.col("c_custkey") % 2 == 0, "").otherwise("raa").alias("raa_name"),
    )


def _policy_rows(ids, key: str, entity: str, rules) -> DataFrame:
    """One scan of ``ids``: each id emits a policy row for every rule it matches."""
    k = F.col(key)
    matches = F.array(*[
        F.when(pred(k), F.struct(F.lit(policy).alias("policy"),
                                 F.lit(None if price is None else float(price)).cast("double").alias("price")))
        for pred, policy, price in rules])
    return (ids.select(k.alias("id"), F.explode(F.filter(matches, lambda x: x.isNotNull())).alias("p"))
            .select(F.col("p.policy").alias("policy"), F.lit(entity).alias("entity"), "id",
                    F.col("p.price").alias("publisher_cpc")))


# Fixed values of the test mapping: which ids each policy lists.
USER_RULES = (
    (lambda c: c % 6 == 1, POLICY_PREMIUM_FEED, None),
    (lambda c: c % 12 == 1, POLICY_PREMIUM_BOOST, None),
    (lambda c: c % 31 == 5, POLICY_EXCLUDE, PRICE_011),
    (lambda c: c % 31 == 5, POLICY_EXCLUDE, PRICE_025),
    (lambda c: c % 37 == 3, POLICY_INCLUDE, PRICE_011),
    (lambda c: c % 41 == 3, POLICY_INCLUDE, PRICE_025),
)
CAMPAIGN_RULES = (
    (lambda k: k % 101 == 7, POLICY_INCLUDE, PRICE_025),
    (lambda k: k % 97 == 5, POLICY_INCLUDE, PRICE_041),
)


def _client_policy(customer: DataFrame, orders: DataFrame) -> DataFrame:
    return (_policy_rows(customer, "c_custkey", "user", USER_RULES)
            .unionByName(_policy_rows(orders, "o_orderkey", "camp", CAMPAIGN_RULES)))


def fixture_inputs(spark: SparkSession, sf_dir: str, params: AllocParams = DEFAULT_PARAMS) -> AdInputs:
    """All eight inputs, derived lazily from ``<sf_dir>/*.parquet``."""
    orders = _table(spark, sf_dir, "orders")
    customer = _table(spark, sf_dir, "customer")
    lineitem = _table(spark, sf_dir, "lineitem")
    supplier = _table(spark, sf_dir, "supplier")

    campaigns = _campaigns(orders)
    ad_clicks = _ad_clicks(lineitem, params)
    click_batches = lineitem.select(_record_id().alias("click_id"),
                                    F.col("l_suppkey").alias("batch_id")).distinct()
    stats = (ad_clicks.filter(F.col("partner_source") == MAIN_PUBLISHER)
             .join(click_batches, F.col("record_id") == F.col("click_id"))
             .select("camp_id", "batch_id").distinct())
    inputs = AdInputs(
        advertiser_vertical=_advertiser_vertical(customer),
        campaigns=campaigns,
        users=_users(customer, campaigns),
        ad_clicks=ad_clicks,
        click_batches=click_batches,
        export_batches=_export_batches(supplier, params),
        export_campaign_stats=stats,
        client_policy=_client_policy(customer, orders),
    )
    return AdInputs(**{name: conform(getattr(inputs, name), schema, name)
                       for name, schema in INPUT_SCHEMAS.items()})


def stored_inputs(inputs: AdInputs) -> AdInputs:
    """The inputs of the runs over a stored ledger: more campaign-level excludes, and a
    user-level include at 0.41."""
    more_camps = (
        (lambda k: k % 5 == 1, POLICY_EXCLUDE, PRICE_011),
        (lambda k: k % 7 == 2, POLICY_EXCLUDE, PRICE_025),
        (lambda k: k % 11 == 6, POLICY_EXCLUDE, PRICE_041),
    )
    more_users = ((lambda c: c % 13 == 6, POLICY_INCLUDE, PRICE_041),)
    policy = (inputs.client_policy.unionByName(_policy_rows(inputs.campaigns, "camp_id", "camp", more_camps))
              .unionByName(_policy_rows(inputs.users, "id", "user", more_users)))
    return replace(inputs, client_policy=conform(policy, INPUT_SCHEMAS["client_policy"], "client_policy"))


def stored_ledger(inputs: AdInputs, params: AllocParams) -> DataFrame:
    """Ledger rows of the target date that another job left, for the same runs."""
    k = F.col("camp_id")
    rules = (
        (k % 9 == 4, MAIN_PUBLISHER, PRICE_011, 7.5, 3, None, 0),
        (k % 8 == 5, MAIN_PUBLISHER, PRICE_025, 12.0, 7, 3, 1),
        (k % 25 == 7, MAIN_PUBLISHER, PRICE_041, 20.5, 12, 4, 1),
        (k % 10 == 3, PARTNER_PUBLISHER, PRICE_025, 3.25, 601, None, 0),
    )
    rows = F.array(*[F.when(cond, F.struct(
        F.lit(pub).cast("long").alias("publisher_id"), F.lit(float(price)).alias("publisher_cpc"), F.lit(spend).alias("target_spend"),
        F.lit(step).alias("step_num"), F.lit(feed).cast("int").alias("job_export_feed_id"), F.lit(active).alias("active_flag")))
        for cond, pub, price, spend, step, feed, active in rules])
    return (inputs.campaigns.select("camp_id", F.explode(F.array_compact(rows)).alias("e"))
            .select(F.lit(params.target_date).alias("date_date"), "camp_id", "e.*").select(*LEDGER.fieldNames()))
