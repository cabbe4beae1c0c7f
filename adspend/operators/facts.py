"""Shared facts: click rollups, account rollups, export and policy flags.

Today's clicks are scanned once. The per-feed rollup needs each click's export
batches. Instead of joining clicks to batches (which fans a click out per batch
and would distort the per-campaign totals), the batch side is first reduced to
one row per click: how many of its batches sit on each priced feed. A left join
then keeps one row per click. A single aggregation by ``camp_id`` yields both the
campaign totals and the per-feed totals, where "one joined row per batch" becomes
"multiply by the batch count". Partial aggregation runs map-side, so a campaign
holding a third of all clicks still sends one row per map task to the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adspend.functions.spend import (
    dec, feed_price, from_units, if_, is_billable, is_main_billable, money_units, ratio, run_date,
)
from adspend.operators.campaign_filter import may_be_of
from adspend.operators.eligibility import running_campaign
from adspend.params import (
    MAIN_PUBLISHER, POLICY_EXCLUDE, POLICY_INCLUDE, POLICY_PREMIUM_BOOST, POLICY_PREMIUM_FEED,
    PRICE_011, PRICE_025, PRICE_041, AllocParams,
)
from adspend.sources.tables import AdInputs

FEED_PRICES = (PRICE_011, PRICE_025)
PRICES = (PRICE_011, PRICE_025, PRICE_041)


def price_tag(price) -> str:
    """Column-name suffix of a price point: 0.11 -> '011'."""
    return f"{int(round(float(price) * 100)):03d}"


def links_of(inputs: AdInputs, clicks: DataFrame, params: AllocParams) -> DataFrame:
    """Click-to-batch links that can belong to ``clicks``, which are of the run date.

    Stored links (``sources.tables.write_parquet_inputs``) have the day of their click, and only
    the partition of the run date is read. Links from elsewhere have no day: of those the ones in
    the range of the record ids are taken. Nothing outside the least and the greatest record id
    can match, and Spark pushes the two values into the Parquet scan once the subquery has
    run. The range is exact whatever the size of a day.
    """
    if "click_date" in inputs.click_batches.columns:
        return inputs.click_batches.filter(F.col("click_date") == F.lit(params.run_date)).drop("click_date")
    # The two ends are asked for over different frames on purpose: Spark merges subqueries over
    # equal ones into a struct, and a struct's fields are not pushed into the scan.
    lo = clicks.agg(F.min("record_id").alias("lo")).scalar()
    hi = clicks.filter(F.col("record_id").isNotNull()).agg(F.max("record_id").alias("hi")).scalar()
    return inputs.click_batches.filter((F.col("click_id") >= lo) & (F.col("click_id") <= hi))


def batch_feed_counts(inputs: AdInputs, clicks: DataFrame, params: AllocParams) -> DataFrame:
    """Per ``click_id`` of the range of ``clicks``: number of its export batches on each priced feed."""
    return feed_counts(links_of(inputs, clicks, params), inputs.export_batches)


def feed_counts(links: DataFrame, export_batches: DataFrame) -> DataFrame:
    """Per ``click_id`` of ``links``: number of its export batches on each priced feed."""
    batches = (export_batches
               .select(F.col("id").alias("batch_id"), feed_price(F.col("feed")).alias("price"))
               .filter(F.col("price").isNotNull()))
    linked = links.join(batches, "batch_id")
    return linked.groupBy("click_id").agg(*[
        F.sum(if_(F.col("price") == dec(p), 1, 0)).alias(f"n_{price_tag(p)}") for p in FEED_PRICES])


def campaign_click_totals(clicks: DataFrame) -> DataFrame:
    """Per campaign: billable main-publisher clicks and revenue, average billable cost."""
    cost_units = money_units(F.col("click_cost"))
    return clicks.groupBy("camp_id").agg(
        F.sum(if_(is_main_billable(), 1, 0)).cast("long").alias("paid_clicks"),
        from_units(F.sum(if_(is_main_billable(), cost_units, 0))).alias("rev"),
        ratio(from_units(F.sum(if_(is_billable(), cost_units, 0))),
              F.sum(if_(is_billable(), 1, 0))).alias("avg_click_cost"))


def click_facts(inputs: AdInputs, params: AllocParams, campaigns: DataFrame | None = None) -> DataFrame:
    """One row per campaign with clicks on the run date.

    Columns: ``click_rows``, ``rev`` (main-publisher billable revenue),
    ``paid_cost`` / ``paid_n`` (billable cost and count over all publishers) and,
    per feed price ``p``, ``rows_p`` (joined click x batch rows), ``clk_p`` and ``rev_p``.
    Restrict the campaigns after this aggregation: raw clicks are never shuffled by campaign.
    ``campaigns`` narrows the clicks before they meet their links, to those that may be of these
    campaigns (``campaign_filter``); rows of other campaigns may be left.
    With ``inputs.click_rollups`` the sums of the stored loads are added up and no click is read.
    """
    if inputs.click_rollups is not None:
        loads = inputs.click_rollups.filter(F.col("date_date") == F.lit(params.run_date))
        return _with_money(loads.groupBy("camp_id").agg(*[F.sum(c).alias(c) for c in CLICK_SUMS]))
    clicks = inputs.clicks_of(params).select(
        "record_id", "camp_id", "partner_source", "reason_code", "click_cost")
    some = clicks if campaigns is None else may_be_of(clicks, campaigns, params.campaign_filter_bits)
    joined = some.join(batch_feed_counts(inputs, clicks, params), F.col("record_id") == F.col("click_id"), "left")
    return _with_money(click_sums(joined, ["camp_id"], F.lit(1)))


# What a day's clicks of a campaign add up to; the columns of ``_MONEY`` in units of ``money_units``.
CLICK_SUMS = ["click_rows", "rev", "paid_cost", "paid_n",
              *[f"{c}_{price_tag(p)}" for p in FEED_PRICES for c in ("rows", "clk", "rev")]]
_MONEY = ["rev", "paid_cost", *[f"rev_{price_tag(p)}" for p in FEED_PRICES]]


def _with_money(sums: DataFrame) -> DataFrame:
    return sums.select(*[from_units(F.col(c)).alias(c) if c in _MONEY else c for c in sums.columns])


def click_sums(joined: DataFrame, by: list[str], counted: F.Column) -> DataFrame:
    """``CLICK_SUMS`` of clicks with their ``feed_counts``; a click's own figures count ``counted`` times."""
    # money is summed as exact BIGINT units and turned back into DECIMAL once per campaign
    cost_units = money_units(F.col("click_cost"))
    main_units = if_(is_main_billable(), cost_units, 0)
    main_clk = if_(is_main_billable(), 1, 0)
    aggs = [
        F.sum(counted).alias("click_rows"),
        F.sum(main_units * counted).alias("rev"),
        F.sum(if_(is_billable(), cost_units, 0) * counted).alias("paid_cost"),
        F.sum(if_(is_billable(), 1, 0) * counted).alias("paid_n"),
    ]
    for p in FEED_PRICES:
        t = price_tag(p)
        n = F.coalesce(F.col(f"n_{t}"), F.lit(0))
        aggs += [F.sum(n).alias(f"rows_{t}"),
                 F.sum(main_clk * n).alias(f"clk_{t}"),
                 F.sum(main_units * n).alias(f"rev_{t}")]
    return joined.groupBy(*by).agg(*aggs)


def account_rollups(inputs: AdInputs, params: AllocParams) -> DataFrame:
    """Per ``user_id``: spend rollups over the user's campaigns.

    * over all campaigns: ``spent_all``, ``null_budget_all``;
    * over running 'pjl' campaigns only: ``spent_run``, ``nb_run`` (sum of set
      budgets), ``nn_run`` (campaigns without budget), ``n_run``.
    A rollup over no campaign is NULL, like a missing group in SQL. Partial
    aggregation bounds what an account with very many campaigns sends to the shuffle.
    """
    run = running_campaign(params)
    budget, cost = F.col("system_daily_budget"), money_units(F.col("cost_today"))
    rolled = inputs.campaigns.groupBy("user_id").agg(
        F.sum(cost).alias("spent_all"),
        F.sum(if_(budget.isNull(), 1, 0)).alias("null_budget_all"),
        F.sum(if_(run, cost, None)).alias("spent_run"),
        F.sum(if_(run, F.coalesce(money_units(budget), F.lit(0)), None)).alias("nb_run"),
        F.sum(if_(run & budget.isNull(), 1, 0)).alias("nn_run"),
        F.sum(if_(run, 1, 0)).alias("n_run"),
        F.count(F.lit(1)).alias("n_all"),
    )
    money = ("spent_all", "spent_run", "nb_run")
    return rolled.select(*[from_units(F.col(c)).alias(c) if c in money else c for c in rolled.columns])


def account_facts(inputs: AdInputs, params: AllocParams) -> DataFrame:
    """Per user (``id``): account budget and the rollups of ``account_rollups``."""
    per_user = account_rollups(inputs, params).withColumnRenamed("user_id", "id")
    return inputs.users.select("id", "account_system_daily_budget").join(per_user, "id")


def exported_today(inputs: AdInputs, params: AllocParams) -> DataFrame:
    """Campaigns exported on the run date to the main publisher (``camp_id``, may be NULL)."""
    # both uses of this set (membership, and whether it holds a NULL) share its one aggregation
    batches = inputs.export_batches.filter(
        (F.to_date("date") == run_date(params)) & (F.col("publisher") == MAIN_PUBLISHER))
    stats = inputs.export_campaign_stats
    if "batch_date" in stats.columns:  # stored by day: one partition is read
        stats = stats.filter(F.col("batch_date") == F.lit(params.run_date))
    return (stats
            .join(batches, F.col("batch_id") == F.col("id"), "left_semi")
            .select("camp_id").distinct())


def holds_null(exported: DataFrame):
    """Whether the set of ``exported_today`` holds a NULL, as a scalar subquery."""
    return F.coalesce(exported.agg(F.max(F.col("camp_id").isNull()).alias("n")).scalar(), F.lit(False))


def known_policy() -> F.Column:
    """Policy rows the run understands: premium lists of users, and excludes and includes of
    users or campaigns at one of the price points."""
    policy, entity, price = F.col("policy"), F.col("entity"), F.col("publisher_cpc")
    at_price = policy.isin(POLICY_EXCLUDE, POLICY_INCLUDE) & entity.isin("user", "camp") & price.isin(*map(float, PRICES))
    premium = policy.isin(POLICY_PREMIUM_FEED, POLICY_PREMIUM_BOOST) & (entity == "user")
    return F.coalesce(at_price | premium, F.lit(False))


def unknown_policy_rows(inputs: AdInputs) -> DataFrame:
    """Policy rows that no rule would read, counted by their values."""
    return inputs.client_policy.filter(~known_policy()).groupBy("policy", "entity", "publisher_cpc").count()


def _policy_flags(policy: DataFrame, entity: str) -> DataFrame:
    """Pivot policy rows of one entity kind into boolean columns per id.

    A row that no rule would read (unknown policy, entity or price) fails the run.
    """
    price = F.col("publisher_cpc")
    refused = F.raise_error(F.concat_ws(" ", F.lit("unknown client_policy row:"), "policy", "entity", F.col("id").cast("string"), price.cast("string")))
    rows = policy.filter(F.when(known_policy(), F.col("entity") == entity).otherwise(refused.cast("boolean")))
    flags = {
        "premium_feed": F.col("policy") == POLICY_PREMIUM_FEED,
        "premium_boost": F.col("policy") == POLICY_PREMIUM_BOOST,
    }
    for p in PRICES:
        flags[f"exclude_{price_tag(p)}"] = (F.col("policy") == POLICY_EXCLUDE) & (price == float(p))
        flags[f"include_{price_tag(p)}"] = (F.col("policy") == POLICY_INCLUDE) & (price == float(p))
    return rows.groupBy("id").agg(*[F.max(F.coalesce(c, F.lit(False))).alias(f"{entity}_{name}")
                                    for name, c in flags.items()])


def user_policy_flags(inputs: AdInputs) -> DataFrame:
    return _policy_flags(inputs.client_policy, "user")


def campaign_policy_flags(inputs: AdInputs) -> DataFrame:
    return _policy_flags(inputs.client_policy, "camp")
