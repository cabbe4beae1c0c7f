"""Eligibility: advertisers with a usable vertical (E0) and running campaigns (E1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adspend.functions.spend import run_date
from adspend.params import AllocParams
from adspend.sources.tables import AdInputs


def usable_vertical(params: AllocParams) -> F.Column:
    """``type NOT IN (..) AND NOT (type = 'Job Board' AND raa_name = '') AND type != ''``.

    Three-valued logic is kept: a NULL type or a Job Board row with NULL raa_name
    evaluates to NULL and is dropped, as in SQL.
    """
    t = F.col("type")
    return (~t.isin(*params.excluded_vertical_types)
            & ~((t == params.job_board_type) & (F.col("raa_name") == ""))
            & (t != ""))


def eligible_advertisers(inputs: AdInputs, params: AllocParams) -> DataFrame:
    """E0 as a frame of ``advertiser_id`` (may repeat; used as a semi-join side)."""
    return inputs.advertiser_vertical.filter(usable_vertical(params)).select("advertiser_id")


def live_campaign(params: AllocParams) -> F.Column:
    """Campaign status filter shared by every stage: status 'yes' and type 'pjl'."""
    return (F.col("camp_type") == params.campaign_type) & (F.col("status") == params.active_status)


def running_campaign(params: AllocParams) -> F.Column:
    """Campaign row filters of E1: live campaigns whose date range holds the run date."""
    d = run_date(params)
    return live_campaign(params) & (F.col("camp_start") <= d) & (F.col("camp_end") >= d)


def funded_user(params: AllocParams) -> F.Column:
    """User row filters of E1. The company pattern is matched case-insensitively."""
    return ((F.col("status") == params.user_active_status)
            & ~F.lower(F.col("company")).like(params.excluded_company_pattern.lower())
            & (F.col("product") != params.excluded_product)
            & (F.col("country") != params.excluded_country)
            & (F.col("total_credits") - F.col("total_debits") > 0))


def salted_user_join(rows: DataFrame, users: DataFrame, inputs: AdInputs, params: AllocParams, how: str = "inner") -> DataFrame:
    """Campaign rows joined to one row per user (``id``), with hot accounts salted.

    An account with more than ``params.hot_account_campaigns`` campaigns is hot and gets one
    salt for each such number of campaigns (``params.account_salt_buckets`` at least): its
    campaigns are dealt by ``camp_id`` over the salts, its user row is repeated once per salt,
    and the join runs on (user_id, salt). Other accounts have salt 0 and are not repeated.
    The hot accounts come from one count of campaigns by user; Spark decides by their size how
    they are joined. ``how`` is ``inner`` or ``left``.
    """
    threshold, least = params.hot_account_campaigns, params.account_salt_buckets
    hot = (inputs.campaigns.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > threshold)
           .select(F.col("user_id").alias("_hot_id"),
                   F.greatest(F.lit(least), F.ceil(F.col("_n") / threshold)).cast("int").alias("_salts")))
    salted_rows = (rows.join(hot, rows.user_id == F.col("_hot_id"), "left")
                   .withColumn("_salt", F.coalesce(F.pmod(F.col("camp_id"), F.col("_salts")), F.lit(0)).cast("int"))
                   .drop("_hot_id", "_salts"))
    salted_users = (users.join(hot, users.id == F.col("_hot_id"), "left")
                    .withColumn("_user_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)))
                    .drop("_hot_id", "_salts"))
    joined = salted_rows.join(salted_users, (F.col("user_id") == F.col("id")) & (F.col("_salt") == F.col("_user_salt")), how)
    return joined.drop("id", "_salt", "_user_salt")


def eligible_users(inputs: AdInputs, params: AllocParams) -> DataFrame:
    """Funded users in E0: ``id`` and their account budget, one row each."""
    e0 = eligible_advertisers(inputs, params)
    return (inputs.users.filter(funded_user(params)).select("id", "account_system_daily_budget")
            .join(e0, F.col("id") == e0.advertiser_id, "left_semi"))


def eligible_campaign_rows(inputs: AdInputs, params: AllocParams) -> DataFrame:
    """E1 before the DISTINCT: campaign columns plus the user's account budget.

    ``camp_id`` is the campaigns' primary key and ``id`` the users', so the rows
    are already distinct.
    """
    ic = inputs.campaigns.filter(running_campaign(params)).select(
        "camp_id", "user_id", "camp_name", "system_daily_budget", "cost_today", "cost_per_click")
    return salted_user_join(ic, eligible_users(inputs, params), inputs, params)


def eligible_campaigns(inputs: AdInputs, params: AllocParams) -> DataFrame:
    """E1: distinct ``camp_id`` of running campaigns of funded users in E0.

    The id set is never collected: later stages semi-join against this frame.
    """
    return eligible_campaign_rows(inputs, params).select("camp_id").distinct()
