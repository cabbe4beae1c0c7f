"""Explicit schemas of the allocation inputs and of the output ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MONEY = T.DecimalType(12, 4)
CREDIT = T.DecimalType(12, 2)

ADVERTISER_VERTICAL = T.StructType([
    T.StructField("advertiser_id", T.LongType()),
    T.StructField("type", T.StringType()),
    T.StructField("raa_name", T.StringType()),
])

CAMPAIGNS = T.StructType([
    T.StructField("camp_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("camp_name", T.StringType()),
    T.StructField("camp_type", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("camp_start", T.DateType()),
    T.StructField("camp_end", T.DateType()),
    T.StructField("system_daily_budget", MONEY),
    T.StructField("cost_today", MONEY),
    T.StructField("cost_per_click", MONEY),
])

USERS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("company", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("total_credits", CREDIT),
    T.StructField("total_debits", CREDIT),
    T.StructField("account_system_daily_budget", MONEY),
])

AD_CLICKS = T.StructType([
    T.StructField("record_id", T.LongType()),
    T.StructField("camp_id", T.LongType()),
    T.StructField("date_date", T.DateType()),
    T.StructField("partner_source", T.IntegerType()),
    T.StructField("reason_code", T.IntegerType()),
    T.StructField("click_cost", MONEY),
])

CLICK_BATCHES = T.StructType([
    T.StructField("click_id", T.LongType()),
    T.StructField("batch_id", T.LongType()),
])

EXPORT_BATCHES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("feed", T.IntegerType()),
    T.StructField("date", T.DateType()),
    T.StructField("publisher", T.IntegerType()),
])

EXPORT_CAMPAIGN_STATS = T.StructType([
    T.StructField("camp_id", T.LongType()),
    T.StructField("batch_id", T.LongType()),
])

CLIENT_POLICY = T.StructType([
    T.StructField("policy", T.StringType()),
    T.StructField("entity", T.StringType()),
    T.StructField("id", T.LongType()),
    # price point the rule applies to; NULL for rules that are not per price
    T.StructField("publisher_cpc", T.DoubleType()),
])

LEDGER = T.StructType([
    T.StructField("date_date", T.DateType()),
    T.StructField("publisher_id", T.LongType()),
    T.StructField("publisher_cpc", T.DoubleType()),
    T.StructField("camp_id", T.LongType()),
    T.StructField("target_spend", T.DoubleType()),
    T.StructField("step_num", T.IntegerType()),
    T.StructField("job_export_feed_id", T.IntegerType()),
    T.StructField("active_flag", T.IntegerType()),
])

INPUT_SCHEMAS = {
    "advertiser_vertical": ADVERTISER_VERTICAL,
    "campaigns": CAMPAIGNS,
    "users": USERS,
    "ad_clicks": AD_CLICKS,
    "click_batches": CLICK_BATCHES,
    "export_batches": EXPORT_BATCHES,
    "export_campaign_stats": EXPORT_CAMPAIGN_STATS,
    "client_policy": CLIENT_POLICY,
}


def conform(df: DataFrame, schema: T.StructType, name: str = "input") -> DataFrame:
    """Select and cast the schema's columns, failing on a missing column.

    Casting is a projection, so column pruning and filter pushdown still reach
    the scan below it.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{name}: missing columns {missing}")
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
