"""Scenario stages 0-9 and 41 as candidate entries of a per-campaign frame.

Each stage of the ladder is a condition and a spend expression over one row of
the campaign frame (campaign, user, account rollups, click rollups). The frame is
built once, and every stage is a projection of it. No stage has its own join
tree or rescans the clicks.

Stage rules (B = campaign budget, C = cost today, P = cost per click,
AB = account budget, z = price point):

* 0  untouched, C = 0, B-3 >= C, P > 0.18: cap((B-C)/P*0.11) at 0.11
* 1  near exhausted, clicks today, P > 0.18, no main revenue: spend 0 at 0.11
* 2  near exhausted, per feed price with revenue: cap(clk*z*0.9)
* 3  underspent, C > 0, P > 0.18, no main revenue: cap((B-C)/avg*0.11*0.40)
* 4  underspent with revenue, per feed price: clicks plus a share of the rest
* 41 as 4, adds 0.25 where all revenue is on the 0.11 feed and P > 0.40
* 5  account near exhausted, B NULL, no revenue: spend 0 that its own > 0.5
     filter rejects, so the stage never writes
* 6  account near exhausted (margin 5), B NULL, per feed: cap(clk*z*0.9)
* 7  account underspent by 5, B NULL, per feed: share of the account rest
* 8  account underspent by 3, B NULL, not exported today: share at 0.11
* 9  unlimited account, B NULL, per feed: cap(clk*z, +10 below 50)
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adspend.functions.spend import capped, dbl, dec, near_exhausted, ratio, session_cached, underspent
from adspend.operators import eligibility as elig
from adspend.operators.facts import (
    FEED_PRICES, account_rollups, campaign_policy_flags, click_facts, exported_today, holds_null, price_tag,
    user_policy_flags,
)
from adspend.params import (
    ACCOUNT_MARGIN_NEAR, ACCOUNT_MARGIN_WIDE, CAMPAIGN_MARGIN, KEEP_ABOVE, MAIN_PUBLISHER, MIN_CPC,
    PRICE_011, PRICE_025, SCENARIO_ORDER, SPEND_CAP, TOPUP, TOPUP_BELOW, AllocParams,
)
from adspend.sources.tables import AdInputs


def B() -> Column:
    return F.col("system_daily_budget")


def C() -> Column:
    return F.col("cost_today")


def P() -> Column:
    return F.col("cost_per_click")


def AB() -> Column:
    return F.col("account_system_daily_budget")


@dataclass(frozen=True)
class Candidate:
    """One way a stage proposes a spend: a row condition, a price and a spend."""

    step: int
    price: Decimal
    when: Column
    spend: Column


def user_frame(inputs: AdInputs, params: AllocParams) -> DataFrame:
    """One row per funded user in E0 (``id``): account budget, spend rollups, policy flags.

    Everything keyed by user is joined here, among per-user tables, before any
    campaign row is touched.
    """
    return (elig.eligible_users(inputs, params)
            .join(account_rollups(inputs, params).withColumnRenamed("user_id", "id"), "id")
            .join(user_policy_flags(inputs), "id", "left"))


def campaign_frame(inputs: AdInputs, params: AllocParams,
                   eligible: DataFrame | None = None) -> DataFrame:
    """One row per eligible campaign with every fact a stage can test.

    Running campaigns meet the per-user frame in one salted join on ``user_id``
    (``salted_user_join``), so an account holding a third of all campaigns is spread
    over many tasks. Then come the click rollup, the export set and the campaign
    policies, keyed by ``camp_id``. The click rollup is joined after its aggregation: raw clicks are
    never shuffled by ``camp_id``, so a campaign with a third of all clicks is
    pre-aggregated map-side. Clicks of campaigns that do not run are left out in the scan. ``eligible`` optionally narrows the campaigns further.
    """
    rows = inputs.campaigns.filter(elig.running_campaign(params)).select(
        "camp_id", "user_id", "camp_name", "system_daily_budget", "cost_today", "cost_per_click")
    if eligible is not None:
        rows = rows.join(eligible.select("camp_id"), "camp_id", "left_semi")
    exported = exported_today(inputs, params)
    exported_ids = exported.select(F.col("camp_id").alias("exported_id"))
    frame = (elig.salted_user_join(rows, user_frame(inputs, params), inputs, params)
             .join(click_facts(inputs, params, rows), "camp_id", "left")
             .join(exported_ids, F.col("camp_id").eqNullSafe(F.col("exported_id")), "left")
             .join(campaign_policy_flags(inputs).withColumnRenamed("id", "camp_id"), "camp_id", "left"))
    flag_cols = [c for c in frame.columns
                 if c.startswith(("user_", "camp_")) and c not in ("user_id", "camp_id", "camp_name")]
    return frame.select(
        *[c for c in frame.columns if c not in flag_cols and c not in ("exported_id", "n_all")],
        *[F.coalesce(F.col(c), F.lit(False)).alias(c) for c in flag_cols],
        # NOT IN (subquery): false when listed, and never true if the list holds a NULL
        (F.col("exported_id").isNull() & ~holds_null(exported)).alias("not_exported"),
        F.lit(True).alias("eligible"),
    )


def _avg_click_cost() -> Column:
    return ratio(F.col("paid_cost"), F.col("paid_n"))


def _has_clicks() -> Column:
    return F.col("click_rows").isNotNull()


def _feed(p) -> tuple[Column, Column, Column]:
    t = price_tag(p)
    return F.col(f"rows_{t}"), F.col(f"clk_{t}"), F.col(f"rev_{t}")


def _keep(spend: Column) -> Column:
    return spend > KEEP_ABOVE


def budget_left() -> Column:
    return B() - C()


def untouched_spend() -> Column:
    """Spend of an untouched campaign: what is left, in clicks, at the 0.11 price."""
    return (F.when(P() > 0, ratio(budget_left(), P()) * dec(PRICE_011))
            .when(P() == 0, dbl(budget_left() * dec("0.40"))))


def untouched() -> Column:
    return (P() > MIN_CPC[PRICE_011]) & underspent(B(), C(), CAMPAIGN_MARGIN) & (C() == 0)


def whole_clicks_left() -> Column:
    """Clicks the campaign can still pay: ``floor((B - C) / P)``, an exact DECIMAL quotient."""
    return F.floor(F.when(P() != 0, budget_left() / P()))


def untouched_clicks() -> Column:
    """The click estimate that goes with ``untouched_spend``."""
    return F.when(P() > 0, whole_clicks_left()).cast("long")


def stage_0() -> list[Candidate]:
    raw = untouched_spend()
    return [Candidate(0, PRICE_011, untouched() & _keep(raw), capped(raw, SPEND_CAP))]


def stage_1() -> list[Candidate]:
    cond = (_has_clicks() & (P() > MIN_CPC[PRICE_011]) & near_exhausted(B(), C(), CAMPAIGN_MARGIN)
            & (F.col("rev") == 0))
    return [Candidate(1, PRICE_011, cond, F.lit(0.0))]


def stage_2() -> list[Candidate]:
    out = []
    for p in FEED_PRICES:
        rows, clk, rev = _feed(p)
        raw = clk * dec(p) * dec("0.9")
        cond = ((rows > 0) & (rev > 0) & (P() > MIN_CPC[p]) & near_exhausted(B(), C(), CAMPAIGN_MARGIN)
                & _keep(raw))
        out.append(Candidate(2, p, cond, capped(raw, SPEND_CAP)))
    return out


def no_revenue_spend() -> Column:
    """Spend of a campaign with clicks and no main revenue: 40% of what is left."""
    return ratio(budget_left(), _avg_click_cost()) * dec(PRICE_011) * dec("0.40")


def no_revenue() -> Column:
    return (_has_clicks() & (P() > MIN_CPC[PRICE_011]) & underspent(B(), C(), CAMPAIGN_MARGIN) & (C() > 0)
            & (F.col("rev") == 0))


def stage_3() -> list[Candidate]:
    raw = no_revenue_spend()
    return [Candidate(3, PRICE_011, no_revenue() & _keep(raw), capped(raw, SPEND_CAP))]


def _underspent_with_revenue() -> Column:
    return _has_clicks() & underspent(B(), C(), CAMPAIGN_MARGIN) & (C() > 0) & (F.col("rev") > 0)


def _uplift(price) -> tuple[Column, Column]:
    """For one feed price of an underspent campaign with revenue: whether it is priced at all,
    and the share of the rest it gets on top of its clicks (0.11 only if all revenue is its own)."""
    _, _, rev = _feed(price)
    total = F.col("rev")
    priced = (P() > MIN_CPC[price]) & (rev <= total)
    if price == PRICE_011:
        return priced, F.when(rev == total, dec("0.25"))
    return priced, dec("0.40")


def stage_4() -> list[Candidate]:
    out = []
    for p in FEED_PRICES:
        rows, clk, rev = _feed(p)
        clicks_value = dbl(clk * dec(p))
        priced, share = _uplift(p)
        raw = F.when(share.isNull(), clicks_value).otherwise(
            clicks_value + ratio(budget_left() * share, _avg_click_cost()) * dec(p))
        cond = _underspent_with_revenue() & (rows > 0) & (rev > 0) & priced & _keep(raw)
        out.append(Candidate(4, p, cond, capped(raw, SPEND_CAP)))
    return out


def revenue_clicks(price) -> Column:
    """The click estimate of stage 4: the feed's clicks plus whole clicks of the share; -1
    where the price does not apply."""
    _, clk, _ = _feed(price)
    priced, share = _uplift(price)
    extra = F.floor(ratio(budget_left() * share, _avg_click_cost()))
    return F.when(priced, F.when(share.isNull(), clk).otherwise(clk + extra)).otherwise(-1).cast("long")


def has_revenue_on(price) -> Column:
    rows, _, rev = _feed(price)
    return _underspent_with_revenue() & (rows > 0) & (rev > 0)


def stage_41() -> list[Candidate]:
    rows, _, rev = _feed(PRICE_011)
    raw = F.when((P() > MIN_CPC[PRICE_025]) & (rev == F.col("rev")),
                 ratio((B() - C()) * dec("0.15"), _avg_click_cost()) * dec(PRICE_025)).otherwise(F.lit(-1.0))
    cond = _underspent_with_revenue() & (rows > 0) & (rev > 0) & _keep(raw)
    return [Candidate(41, PRICE_025, cond, capped(raw, SPEND_CAP))]


def _account_near(margin: int) -> Column:
    spent = F.col("spent_all")
    return AB().isNotNull() & (AB() > 0) & (spent <= AB()) & (spent > AB() - margin)


def stage_5() -> list[Candidate]:
    spend = F.lit(0.0)
    cond = (_has_clicks() & (F.col("rev") == 0) & B().isNull() & _account_near(ACCOUNT_MARGIN_NEAR)
            & _keep(spend))
    return [Candidate(5, PRICE_011, cond, spend)]


def stage_6() -> list[Candidate]:
    out = []
    for p in FEED_PRICES:
        rows, clk, rev = _feed(p)
        raw = clk * dec(p) * dec("0.9")
        cond = ((rows > 0) & (rev > 0) & (P() > MIN_CPC[p]) & B().isNull()
                & _account_near(ACCOUNT_MARGIN_WIDE) & _keep(raw))
        out.append(Candidate(6, p, cond, capped(raw, SPEND_CAP)))
    return out


def _account_share(clicks: Column | None, price) -> Column:
    """Share of the account budget above the larger of spend and set budgets; NULL when the
    account is over it."""
    rest = AB() - F.greatest(F.col("spent_run"), F.col("nb_run"))
    share = ratio(rest * dec("0.40"), F.col("nn_run") * P())
    if clicks is not None:
        share = share + clicks
    return F.when(rest >= 0, share * dec(price))


def _account_run_ok(margin: int) -> Column:
    return B().isNull() & (F.col("n_run") > 0) & (AB() > 0) & (F.col("spent_run") <= AB() - margin)


def stage_7() -> list[Candidate]:
    out = []
    for p in FEED_PRICES:
        rows, clk, _ = _feed(p)
        raw = _account_share(clk, p)
        cond = ((rows > 0) & (P() > MIN_CPC[p]) & _account_run_ok(ACCOUNT_MARGIN_WIDE)
                & (AB() >= F.col("nb_run")) & _keep(raw))
        out.append(Candidate(7, p, cond, capped(raw, SPEND_CAP)))
    return out


def stage_8() -> list[Candidate]:
    raw = _account_share(None, PRICE_011)
    cond = _account_run_ok(ACCOUNT_MARGIN_NEAR) & F.col("not_exported") & _keep(raw)
    return [Candidate(8, PRICE_011, cond, capped(raw, SPEND_CAP))]


def unlimited(price) -> Column:
    rows, _, _ = _feed(price)
    return (rows > 0) & (P() > MIN_CPC[price]) & B().isNull() & AB().isNull()


def topup_clicks(price) -> Column:
    """The click estimate of stage 9: the feed's clicks, with the top-up's below the bound."""
    _, clk, _ = _feed(price)
    return F.when(clk * dec(price) < TOPUP_BELOW, F.floor(clk + F.lit(TOPUP) / dec(price))).otherwise(clk).cast("long")


def stage_9() -> list[Candidate]:
    out = []
    for p in FEED_PRICES:
        _, clk, _ = _feed(p)
        value = clk * dec(p)
        raw = F.when(value < TOPUP_BELOW, value + TOPUP).otherwise(value)
        out.append(Candidate(9, p, unlimited(p) & _keep(raw), capped(raw, SPEND_CAP)))
    return out


STAGES = {0: stage_0, 1: stage_1, 2: stage_2, 3: stage_3, 4: stage_4, 41: stage_41,
          5: stage_5, 6: stage_6, 7: stage_7, 8: stage_8, 9: stage_9}


def ledger_entry(publisher_id: int, price, spend: Column, step) -> Column:
    """A ledger entry struct (feed id unset, inactive); ``step`` is a number or a column."""
    return F.struct(
        F.lit(publisher_id).cast("long").alias("publisher_id"),
        F.lit(float(price)).alias("publisher_cpc"),
        dbl(spend).alias("target_spend"),
        (step if isinstance(step, Column) else F.lit(step)).alias("step_num"),
        F.lit(None).cast("int").alias("job_export_feed_id"),
        F.lit(0).alias("active_flag"),
    )


@session_cached
def candidate_array(steps=SCENARIO_ORDER) -> Column:
    """All candidates of the given stages of one campaign row, in run order."""
    parts = []
    for step in steps:
        for cand in STAGES[step]():
            parts.append(F.when(cand.when, ledger_entry(MAIN_PUBLISHER, cand.price, cand.spend, step)))
    return F.filter(F.array(*parts), lambda x: x.isNotNull())


# Stages that insert their rows without looking at the keys already in the ledger.
UNCHECKED_STAGES = (0,)


@session_cached
def claimed_step(price: Decimal) -> Column:
    """The first stage, in run order, that claims this price for the campaign (NULL: none).

    A stage has at most one candidate per price, so key exclusion between the stages is this
    choice. Prices that a stored ledger row of the campaign already has (``stored_prices``)
    are closed to all stages but ``UNCHECKED_STAGES``. Plain CASE: generated code, no lambda.
    """
    free = ~F.array_contains("stored_prices", float(price))
    out = None
    for step in SCENARIO_ORDER:
        for cand in STAGES[step]():
            if cand.price == price:
                cond = cand.when if step in UNCHECKED_STAGES else cand.when & free
                out = F.when(cond, F.lit(step)) if out is None else out.when(cond, F.lit(step))
    return F.when(F.col("eligible"), out)


@session_cached
def claimed_spend(price: Decimal, step: str) -> Column:
    """The spend of the stage that column ``step`` names for this price."""
    out = None
    for cand in (c for s in SCENARIO_ORDER for c in STAGES[s]() if c.price == price):
        cond = F.col(step) == cand.step
        out = F.when(cond, cand.spend) if out is None else out.when(cond, cand.spend)
    return out
