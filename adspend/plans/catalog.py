"""Registry of named queries: each pairs a Spark DataFrame with its oracle SQL.

Every query reads the driver's tables through the fixture mapping and runs over
all rows. The operator-level entries show one relational operator of the ladder
on its real input; ``stage_00`` to ``stage_41`` show what a scenario proposes, before key
exclusion; the later stage entries show the rows a phase inserts or changes; ``allocation``
is the whole run, and the ``_stored`` entries are runs that start from stored ledger rows. Column names and types match the SQL exactly (money leaves as
DOUBLE, counts as BIGINT, step numbers as INTEGER).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adspend.functions.spend import (
    capped, dbl, dec, exact_clicks, feed_id_of_price, feed_price, from_units, if_, is_main_billable, ledger_key_text, money_units,
    near_exhausted, next_day, ratio, round2, underspent,
)
from adspend.operators import candidates as cand
from adspend.operators import eligibility as elig
from adspend.operators import facts
from adspend.operators import ledger as ledger_ops
from adspend.operators import rollups
from adspend.operators.arbitration import arbitrate
from adspend.params import (
    ACCOUNT_MARGIN_NEAR, ACCOUNT_MARGIN_WIDE, CAMPAIGN_MARGIN, DEFAULT_PARAMS, FEED_ID_BY_PRICE,
    INCLUDE_SPEND, MAIN_PUBLISHER, MIN_CPC, POLICY_PREMIUM_FEED, PREMIUM_MIN_CPC, PRICE_011,
    PRICE_025, SCENARIO_ORDER, SPEND_CAP, AllocParams,
)
from adspend.plans import oracle as O
from adspend.plans import allocation as pl
from adspend.session import ensure_checkpoint_dir
from adspend.sources.fixtures import fixture_inputs, stored_inputs, stored_ledger
from adspend.sources.ledger_store import store_ledger, update_stored
from adspend.sources.tables import AdInputs, read_ledger

Builder = Callable[[AdInputs, AllocParams], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None  # body over the mapped relations; None: no SQL form
    stored: bool = False  # a run that starts from stored ledger rows

    def run(self, spark: SparkSession, sf_dir: str, params: AllocParams = DEFAULT_PARAMS) -> DataFrame:
        inputs = _inputs(spark, sf_dir, params)
        if self.stored:
            return self.build(stored_inputs(inputs), params, stored_ledger(inputs, params))
        return self.build(inputs, params)

    def oracle(self) -> str | None:
        return O.with_ctes(self.sql, self.stored) if self.sql is not None else None


REGISTRY: dict[str, Query] = {}
_INPUTS: dict = {}


def _inputs(spark: SparkSession, sf_dir: str, params: AllocParams) -> AdInputs:
    """The mapped inputs of one table folder; the lazy frames are shared by all queries."""
    try:
        sc = spark.sparkContext
        owner = (sc.applicationId, sc.startTime)
    except Exception:  # a Spark Connect session has no SparkContext on the client
        owner = (id(spark),)
    key = (*owner, sf_dir, params)
    if key not in _INPUTS:
        _INPUTS[key] = fixture_inputs(spark, sf_dir, params)
    return _INPUTS[key]


def query(name: str, sql: str | None, stored: bool = False):
    def wrap(fn: Builder) -> Builder:
        REGISTRY[name] = Query(name, fn, sql, stored)
        return fn
    return wrap


def _money(*names: str) -> list:
    return [dbl(F.col(n)).alias(n) for n in names]


LEDGER_OUT = ["date_date", "publisher_id", "publisher_cpc", "camp_id", "target_spend", "step_num",
              "job_export_feed_id", "active_flag"]
CAND_OUT = LEDGER_OUT[:6]


# ---------------------------------------------------------------- sources / sinks

@query("scan_advertiser_vertical", "SELECT advertiser_id, type, raa_name FROM advertiser_vertical")
def _scan_av(inp, p):
    return inp.advertiser_vertical


@query("scan_campaigns", """SELECT camp_id, user_id, camp_name, camp_type, status, camp_start, camp_end,
  CAST(system_daily_budget AS DOUBLE) AS system_daily_budget, CAST(cost_today AS DOUBLE) AS cost_today,
  CAST(cost_per_click AS DOUBLE) AS cost_per_click FROM campaigns""")
def _scan_campaigns(inp, p):
    return inp.campaigns.select("camp_id", "user_id", "camp_name", "camp_type", "status", "camp_start",
                                "camp_end", *_money("system_daily_budget", "cost_today", "cost_per_click"))


@query("scan_users", """SELECT id, status, company, product, country, CAST(total_credits AS DOUBLE) AS total_credits,
  CAST(total_debits AS DOUBLE) AS total_debits,
  CAST(account_system_daily_budget AS DOUBLE) AS account_system_daily_budget FROM users""")
def _scan_users(inp, p):
    return inp.users.select("id", "status", "company", "product", "country",
                            *_money("total_credits", "total_debits", "account_system_daily_budget"))


@query("scan_clicks_today", f"""SELECT record_id, camp_id, date_date, partner_source, reason_code,
  CAST(click_cost AS DOUBLE) AS click_cost FROM ad_clicks WHERE date_date = {O.RUN_DATE}""")
def _scan_clicks(inp, p):
    return inp.clicks_of(p).select("record_id", "camp_id", "date_date", "partner_source", "reason_code",
                                   *_money("click_cost"))


@query("scan_click_feeds", """SELECT cb.click_id, cb.batch_id, eb.feed, eb.date, eb.publisher
  FROM click_batches cb JOIN export_batches eb ON cb.batch_id = eb.id""")
def _scan_click_feeds(inp, p):
    return (inp.click_batches.join(inp.export_batches, F.col("batch_id") == F.col("id"))
            .select("click_id", "batch_id", "feed", "date", "publisher"))


@query("scan_exported_campaigns", "SELECT camp_id, batch_id FROM export_campaign_stats")
def _scan_exported(inp, p):
    return inp.export_campaign_stats


@query("scan_ledger", f"SELECT {O.LEDGER_COLS} FROM lca")
def _scan_ledger(inp, p):
    """The day's rows read back from a stored ledger, written by a run to the shared folder."""
    spark = inp.campaigns.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/ledger-{uuid.uuid4().hex}"
    pl.write_ledger(pl.allocate(inp, p), path, target_date=p.target_date)
    return read_ledger(spark, path, p.target_date)


@query("ledger_rows", f"SELECT {O.LEDGER_COLS} FROM l0")
def _ledger_rows(inp, p):
    return pl.scenario_ledger(inp, p)


@query("update_ledger", f"""SELECT {O.LEDGER_COLS.replace('CAST(feed_id AS INTEGER)',
  'CAST(CASE WHEN price = 0.11 THEN 2 WHEN price = 0.25 THEN 3 WHEN price = 0.41 THEN 4 END AS INTEGER)')} FROM l0""")
def _update_ledger(inp, p):
    rows = pl.scenario_ledger(inp, p)
    priced = F.col("publisher_cpc").isin(*[float(x) for x in FEED_ID_BY_PRICE])
    return ledger_ops.update_rows(rows, priced, job_export_feed_id=feed_id_of_price(F.col("publisher_cpc")))


KEYED_UPDATE = f"""SELECT {O.LEDGER_COLS} FROM (
  SELECT camp_id, pub, price, CASE WHEN hit THEN 0.0 ELSE spend END AS spend,
         CASE WHEN hit THEN 10 ELSE step END AS step, feed_id, active
  FROM (SELECT l.*, EXISTS (
          SELECT 1 FROM l0 k JOIN campaigns c ON c.camp_id = k.camp_id
          JOIN client_policy cp ON cp.entity = 'user' AND cp.policy = 'exclude' AND cp.id = c.user_id
               AND cp.publisher_cpc = CAST(k.price AS DOUBLE)
          WHERE k.camp_id = l.camp_id AND k.price = l.price) AS hit
        FROM l0 l))"""


@query("keyed_update", KEYED_UPDATE)
def _keyed_update(inp, p):
    return ledger_ops.keyed_update(pl.scenario_ledger(inp, p), _keys_of_excluded_users(inp, p), ["camp_id", "publisher_cpc"], target_spend=0.0, step_num=10)


def _keys_of_excluded_users(inp, p):
    """Keys (campaign, price) that a policy of the campaign's user excludes; hot users are salted."""
    camps = elig.salted_user_join(inp.campaigns.select("camp_id", "user_id"), facts.user_policy_flags(inp), inp, p)
    arms = [F.when(F.col(f"user_exclude_{facts.price_tag(x)}"), F.lit(float(x))) for x in facts.PRICES]
    return (camps.select("camp_id", F.explode_outer(F.array_compact(F.array(*arms))).alias("publisher_cpc"))
            .filter(F.col("publisher_cpc").isNotNull()))


@query("keyed_update_stored", KEYED_UPDATE)
def _keyed_update_stored(inp, p):
    """The same update on a stored ledger: only the buckets that hold a key are written again."""
    spark = inp.campaigns.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/ledger-{uuid.uuid4().hex}"
    store_ledger(pl.scenario_ledger(inp, p), path, p.target_date, first=True)
    update_stored(spark, path, p.target_date, _keys_of_excluded_users(inp, p), ["camp_id", "publisher_cpc"], target_spend=0.0, step_num=10)
    return read_ledger(spark, path, p.target_date)


@query("stage_row_counts", O.REPORT)
def _stage_row_counts(inp, p):
    return pl.stage_row_counts(inp, p)


# ---------------------------------------------------------------- filters / projections

@query("filter_not_in_list", "SELECT advertiser_id, type FROM advertiser_vertical WHERE type NOT IN ('NA', 'OTHER')")
def _f_not_in(inp, p):
    return inp.advertiser_vertical.filter(~F.col("type").isin(*p.excluded_vertical_types)).select(
        "advertiser_id", "type")


@query("filter_negated_and", "SELECT advertiser_id, type, raa_name FROM advertiser_vertical "
                             "WHERE NOT (type = 'Job Board' AND raa_name = '')")
def _f_neg_and(inp, p):
    t = F.col("type")
    return inp.advertiser_vertical.filter(~((t == p.job_board_type) & (F.col("raa_name") == "")))


@query("filter_equality", "SELECT id FROM users WHERE status = 1 AND product <> 'selfserve' AND country <> 'ca'")
def _f_eq(inp, p):
    return inp.users.filter((F.col("status") == p.user_active_status) & (F.col("product") != p.excluded_product)
                            & (F.col("country") != p.excluded_country)).select("id")


@query("filter_not_like", "SELECT id, company FROM users WHERE lower(company) NOT LIKE '%excluded co%'")
def _f_not_like(inp, p):
    return inp.users.filter(~F.lower("company").like(p.excluded_company_pattern.lower())).select("id", "company")


@query("filter_active_range", f"SELECT camp_id FROM campaigns WHERE camp_start <= {O.RUN_DATE} AND camp_end >= {O.RUN_DATE}")
def _f_range(inp, p):
    d = F.lit(p.run_date)
    return inp.campaigns.filter((F.col("camp_start") <= d) & (F.col("camp_end") >= d)).select("camp_id")


@query("filter_remaining_credit", "SELECT id, CAST(total_credits - total_debits AS DOUBLE) AS remaining "
                                  "FROM users WHERE total_credits - total_debits > 0")
def _f_credit(inp, p):
    rest = F.col("total_credits") - F.col("total_debits")
    return inp.users.filter(rest > 0).select("id", dbl(rest).alias("remaining"))


@query("filter_null_budget", "SELECT camp_id, user_id FROM campaigns WHERE system_daily_budget IS NULL")
def _f_null(inp, p):
    return inp.campaigns.filter(F.col("system_daily_budget").isNull()).select("camp_id", "user_id")


@query("filter_near_exhausted", "SELECT camp_id FROM live WHERE system_daily_budget > 0 "
       "AND cost_today <= system_daily_budget AND system_daily_budget - 3 < cost_today")
def _f_near(inp, p):
    return (inp.campaigns.filter(elig.live_campaign(p))
            .filter(near_exhausted(cand.B(), cand.C(), CAMPAIGN_MARGIN)).select("camp_id"))


@query("filter_underspent", "SELECT camp_id, cost_today = 0 AS untouched FROM live "
                            "WHERE system_daily_budget - 3 >= cost_today")
def _f_under(inp, p):
    return (inp.campaigns.filter(elig.live_campaign(p))
            .filter(underspent(cand.B(), cand.C(), CAMPAIGN_MARGIN))
            .select("camp_id", (cand.C() == 0).alias("untouched")))


@query("filter_account_bands", """SELECT a.id,
  a.ab > 0 AND a.spent <= a.ab AND a.spent > a.ab - 3 AS near_3,
  a.ab > 0 AND a.spent <= a.ab AND a.spent > a.ab - 5 AS near_5,
  a.ab > 0 AND r.spent <= a.ab - 3 AS under_3,
  a.ab > 0 AND r.spent <= a.ab - 5 AS under_5
  FROM acct_all a LEFT JOIN acct_run r ON r.id = a.id WHERE a.ab IS NOT NULL""")
def _f_bands(inp, p):
    a = facts.account_facts(inp, p).filter(cand.AB().isNotNull())
    ab, spent = cand.AB(), F.col("spent_all")
    run = F.when(F.col("n_run") > 0, F.col("spent_run"))
    return a.select("id",
                    ((ab > 0) & (spent <= ab) & (spent > ab - ACCOUNT_MARGIN_NEAR)).alias("near_3"),
                    ((ab > 0) & (spent <= ab) & (spent > ab - ACCOUNT_MARGIN_WIDE)).alias("near_5"),
                    ((ab > 0) & (run <= ab - ACCOUNT_MARGIN_NEAR)).alias("under_3"),
                    ((ab > 0) & (run <= ab - ACCOUNT_MARGIN_WIDE)).alias("under_5"))


@query("filter_feed_offset", "SELECT id, feed FROM export_batches WHERE feed - 1 > 0")
def _f_feed(inp, p):
    return inp.export_batches.filter(F.col("feed") - 1 > 0).select("id", "feed")


@query("filter_policy_list", f"SELECT camp_id, user_id FROM campaigns WHERE user_id IN {O.PREMIUM}")
def _f_policy(inp, p):
    premium = inp.client_policy.filter((F.col("policy") == POLICY_PREMIUM_FEED) & (F.col("entity") == "user"))
    return inp.campaigns.join(premium, F.col("user_id") == premium.id, "left_semi").select("camp_id", "user_id")


@query("filter_kept_spend", f"""SELECT camp_id, raw AS raw_spend FROM s0 WHERE raw > 0.5""")
def _f_kept(inp, p):
    raw = cand.untouched_spend()
    live = inp.campaigns.filter(elig.live_campaign(p)).join(inp.users.select("id"), F.col("user_id") == F.col("id"))
    return live.filter(cand.untouched() & cand._keep(raw)).select("camp_id", raw.alias("raw_spend"))


@query("project_constants", f"SELECT {O.TARGET_DATE} AS date_date, CAST(30647 AS BIGINT) AS publisher_id, "
                            "CAST(0.11 AS DOUBLE) AS publisher_cpc, camp_id FROM e1")
def _project_constants(inp, p):
    return elig.eligible_campaigns(inp, p).select(
        next_day(p.run_date).alias("date_date"), F.lit(MAIN_PUBLISHER).cast("long").alias("publisher_id"),
        F.lit(float(PRICE_011)).alias("publisher_cpc"), "camp_id")


@query("target_clicks_estimate", f"""SELECT camp_id,
  CAST({O.FLOORDIV4('system_daily_budget - cost_today', 'cost_per_click')} AS BIGINT) AS target_clicks
  FROM live WHERE cost_per_click > 0.18 AND system_daily_budget - 3 >= cost_today AND cost_today = 0""")
def _target_clicks(inp, p):
    rows = inp.campaigns.filter(elig.live_campaign(p)).filter(cand.untouched())
    return rows.select("camp_id", cand.untouched_clicks().alias("target_clicks"))


def _per_price(frame: DataFrame, cond, clicks) -> DataFrame:
    """One row for each feed price whose condition holds, from one pass over the frame."""
    rows = F.array(*[F.when(cond(x), F.struct(F.lit(float(x)).alias("publisher_cpc"), clicks(x).alias("target_clicks")))
                     for x in facts.FEED_PRICES])
    return (frame.select("camp_id", F.explode_outer(F.array_compact(rows)).alias("x")).filter(F.col("x").isNotNull())
            .select("camp_id", "x.publisher_cpc", "x.target_clicks"))


@query("target_clicks_revenue", f"""SELECT camp_id, CAST(price AS DOUBLE) AS publisher_cpc, CAST(CASE
    WHEN s.cpc <= r.min_cpc OR f.rev > s.total THEN -1
    WHEN r.own_only AND f.rev < s.total THEN f.clk
    ELSE f.clk + floor({O.DIV("s.rest * r.uplift", "s.avg_cost")}) END AS BIGINT) AS target_clicks
  FROM feed_clicks f JOIN spenders s USING (camp_id) JOIN price_rules r USING (price)
  WHERE f.rev > 0 AND camp_id IN (SELECT camp_id FROM e1)""")
def _revenue_clicks(inp, p):
    return _per_price(cand.campaign_frame(inp, p), cand.has_revenue_on, cand.revenue_clicks)


@query("target_clicks_topup", """SELECT camp_id, CAST(price AS DOUBLE) AS publisher_cpc,
  CAST(CASE WHEN f.clk * price < 50 THEN floor(f.clk + 10 / CAST(price AS DOUBLE)) ELSE f.clk END AS BIGINT) AS target_clicks
  FROM live c JOIN acct_null a ON a.id = c.user_id JOIN feed_clicks f USING (camp_id) JOIN price_rules r USING (price)
  WHERE c.cost_per_click > r.min_cpc AND c.system_daily_budget IS NULL AND camp_id IN (SELECT camp_id FROM e1)""")
def _topup_clicks(inp, p):
    return _per_price(cand.campaign_frame(inp, p), cand.unlimited, cand.topup_clicks)


# ---------------------------------------------------------------- joins

@query("join_campaign_user", "SELECT ic.camp_id, ic.user_id, iu.company FROM campaigns ic JOIN users iu ON ic.user_id = iu.id")
def _j_cu(inp, p):
    return inp.campaigns.join(inp.users, F.col("user_id") == F.col("id")).select("camp_id", "user_id", "company")


@query("join_click_campaign", "SELECT t.record_id, t.camp_id, CAST(c.cost_per_click AS DOUBLE) AS cost_per_click "
                              "FROM today t JOIN campaigns c ON c.camp_id = t.camp_id")
def _j_cc(inp, p):
    return (inp.clicks_of(p).join(inp.campaigns, "camp_id")
            .select("record_id", "camp_id", dbl(F.col("cost_per_click")).alias("cost_per_click")))


@query("join_click_feed", "SELECT record_id, camp_id, batch_id, feed FROM feed_rows")
def _j_cf(inp, p):
    today = inp.clicks_of(p)
    clicks = today.join(inp.campaigns.select("camp_id"), "camp_id")
    return (clicks.join(facts.links_of(inp, today, p), F.col("record_id") == F.col("click_id"))
            .join(inp.export_batches, F.col("batch_id") == F.col("id"))
            .select("record_id", "camp_id", "batch_id", "feed"))


@query("join_account_rollup", """SELECT c.camp_id, c.user_id, CAST(a.ab AS DOUBLE) AS account_budget,
  CAST(a.spent AS DOUBLE) AS user_spent, a.camps_num FROM campaigns c JOIN acct_all a ON a.id = c.user_id
  WHERE c.camp_id IN (SELECT camp_id FROM e1)""")
def _j_acct(inp, p):
    running = inp.campaigns.filter(elig.running_campaign(p)).select("camp_id", "user_id")
    accounts = elig.eligible_users(inp, p).join(
        facts.account_rollups(inp, p).withColumnRenamed("user_id", "id"), "id")
    return elig.salted_user_join(running, accounts, inp, p).select(
        "camp_id", "user_id", dbl(cand.AB()).alias("account_budget"),
        dbl(F.col("spent_all")).alias("user_spent"), F.col("null_budget_all").cast("long").alias("camps_num"))


@query("join_click_rollup", """SELECT cc.camp_id, CAST(cc.rev AS DOUBLE) AS rev, cc.avg_cost AS avg_click_cost
  FROM camp_clicks cc JOIN campaigns c ON c.camp_id = cc.camp_id WHERE c.camp_id IN (SELECT camp_id FROM e1)""")
def _j_click_rollup(inp, p):
    fr = cand.campaign_frame(inp, p)
    return fr.filter(F.col("click_rows").isNotNull()).select(
        "camp_id", dbl(F.col("rev")).alias("rev"), ratio(F.col("paid_cost"), F.col("paid_n")).alias("avg_click_cost"))


def _feed_long(frame: DataFrame, *keep: str) -> DataFrame:
    """Wide per-price click facts -> one row per (campaign, price) with clicks on that feed."""
    rows = [F.when(F.col(f"rows_{t}") > 0, F.struct(F.lit(float(price)).alias("publisher_cpc"), F.col(f"rev_{t}").alias("feed_rev"),
                                                    F.col(f"clk_{t}").cast("long").alias("clk")))
            for price, t in ((x, facts.price_tag(x)) for x in facts.FEED_PRICES)]
    return (frame.select("camp_id", "rev", *keep, F.explode_outer(F.array_compact(F.array(*rows))).alias("x"))
            .filter(F.col("x").isNotNull()).select("camp_id", "rev", *keep, "x.publisher_cpc", "x.feed_rev", "x.clk"))


@query("join_total_vs_feed", """SELECT d.camp_id, CAST(e.price AS DOUBLE) AS publisher_cpc, CAST(d.rev AS DOUBLE) AS rev,
  CAST(e.rev AS DOUBLE) AS feed_rev, e.clk FROM camp_clicks d JOIN feed_clicks e ON d.camp_id = e.camp_id
  WHERE e.price IS NOT NULL AND d.camp_id IN (SELECT camp_id FROM e1)""")
def _j_total_feed(inp, p):
    f = facts.click_facts(inp, p).join(elig.eligible_campaigns(inp, p), "camp_id", "left_semi")
    return _feed_long(f).select("camp_id", "publisher_cpc", dbl(F.col("rev")).alias("rev"),
                                dbl(F.col("feed_rev")).alias("feed_rev"), "clk")


@query("semi_join_eligible", "SELECT camp_id, user_id FROM campaigns WHERE camp_id IN (SELECT camp_id FROM e1)")
def _semi_e(inp, p):
    return inp.campaigns.join(elig.eligible_campaigns(inp, p), "camp_id", "left_semi").select("camp_id", "user_id")


@query("semi_join_ledger", "SELECT camp_id, user_id FROM campaigns WHERE camp_id IN (SELECT camp_id FROM l0)")
def _semi_ledger(inp, p):
    return inp.campaigns.join(pl.scenario_ledger(inp, p), "camp_id", "left_semi").select("camp_id", "user_id")


@query("anti_join_exported", "SELECT camp_id FROM e1 WHERE camp_id NOT IN (SELECT camp_id FROM exported)")
def _anti_exported(inp, p):
    exported = facts.exported_today(inp, p)
    ids = exported.select(F.col("camp_id").alias("exported_id"))
    return (elig.eligible_campaigns(inp, p)
            .join(ids, F.col("camp_id").eqNullSafe(F.col("exported_id")), "left_anti")
            .filter(~facts.holds_null(exported)).select("camp_id"))


@query("anti_join_exported_null", """SELECT camp_id FROM e1 WHERE camp_id NOT IN (
  SELECT camp_id FROM exported UNION ALL SELECT NULL FROM export_batches WHERE id % 2 = 0 AND publisher = 30647)""")
def _anti_exported_null(inp, p):
    """The same over exports of which some have no campaign: NOT IN is then never true."""
    lost = inp.export_batches.filter(F.col("id") % 2 == 0).select(F.lit(None).cast("long").alias("camp_id"), F.col("id").alias("batch_id"))
    return _anti_exported(replace(inp, export_campaign_stats=inp.export_campaign_stats.select("camp_id", "batch_id").unionByName(lost)), p)


@query("join_ledger_campaign", """SELECT l.camp_id, CAST(l.price AS DOUBLE) AS publisher_cpc, CAST(l.spend AS DOUBLE) AS target_spend,
  CAST(c.cost_per_click AS DOUBLE) AS cost_per_click, c.user_id FROM l0 l JOIN campaigns c ON c.camp_id = l.camp_id""")
def _j_ledger_campaign(inp, p):
    return (pl.scenario_ledger(inp, p).join(inp.campaigns, "camp_id")
            .select("camp_id", "publisher_cpc", "target_spend", dbl(cand.P()).alias("cost_per_click"), "user_id"))


@query("anti_join_existing_keys", f"SELECT {O.CAND_COLS} FROM l0")
def _anti_keys(inp, p):
    """Key exclusion in long form: all stage 0-9 candidates, window ``min`` of stage rank per key."""
    frame = cand.campaign_frame(inp, p)
    long = pl.entries_to_rows(frame.select("camp_id", cand.candidate_array(SCENARIO_ORDER).alias("c")), "c", p)
    return arbitrate(long).select(*CAND_OUT)


@query("update_join", f"""SELECT {O.LEDGER_COLS} FROM (
  SELECT camp_id, pub, price, CASE WHEN hit THEN 0.0 ELSE spend END AS spend,
         CASE WHEN hit THEN 13 ELSE step END AS step, feed_id, active
  FROM (SELECT *, price IN (0.11, 0.25) AND camp_id IN (SELECT camp_id FROM premium_gate) AS hit FROM l0))""")
def _update_join(inp, p):
    rows = pl.scenario_ledger(inp, p)
    premium = inp.client_policy.filter((F.col("policy") == POLICY_PREMIUM_FEED) & (F.col("entity") == "user"))
    gate = (inp.campaigns.filter((cand.C() < 20) & (cand.P() >= PREMIUM_MIN_CPC))
            .join(premium, F.col("user_id") == premium.id, "left_semi").select("camp_id"))
    flagged = rows.join(gate.withColumn("_gate", F.lit(True)), "camp_id", "left")
    hit = F.col("publisher_cpc").isin(float(PRICE_011), float(PRICE_025)) & F.coalesce(F.col("_gate"), F.lit(False))
    return ledger_ops.update_rows(flagged, hit, target_spend=0.0, step_num=13).select(*LEDGER_OUT)


# ---------------------------------------------------------------- aggregations

def _known(rows, inp):
    """Rows of campaigns that exist. Filter after aggregating: raw clicks of a campaign are
    never shuffled to one task."""
    return rows.join(inp.campaigns.select("camp_id"), "camp_id", "left_semi")


@query("agg_paid_clicks", "SELECT camp_id, paid_clicks FROM camp_clicks")
def _g_paid(inp, p):
    return _known(facts.campaign_click_totals(inp.clicks_of(p)), inp).select("camp_id", "paid_clicks")


@query("agg_revenue", "SELECT camp_id, CAST(rev AS DOUBLE) AS rev FROM camp_clicks")
def _g_rev(inp, p):
    return _known(facts.campaign_click_totals(inp.clicks_of(p)), inp).select("camp_id", dbl(F.col("rev")).alias("rev"))


@query("agg_avg_click_cost", "SELECT camp_id, avg_cost AS avg_click_cost FROM camp_clicks")
def _g_avg(inp, p):
    return _known(facts.campaign_click_totals(inp.clicks_of(p)), inp).select("camp_id", "avg_click_cost")


@query("agg_account_spend", "SELECT id, CAST(spent AS DOUBLE) AS user_spent FROM acct_all")
def _g_spend(inp, p):
    return facts.account_facts(inp, p).select("id", dbl(F.col("spent_all")).alias("user_spent"))


@query("agg_account_budgets", "SELECT id, CAST(nb AS DOUBLE) AS capped_budget, nn AS uncapped_campaigns FROM acct_run")
def _g_budgets(inp, p):
    a = facts.account_facts(inp, p).filter(cand.AB().isNotNull() & (F.col("n_run") > 0))
    return a.select("id", dbl(F.col("nb_run")).alias("capped_budget"),
                    F.col("nn_run").cast("long").alias("uncapped_campaigns"))


@query("agg_ledger_clicks", """SELECT camp_id,
  CAST(SUM(CAST(ROUND(spend * 10000) AS BIGINT) * (11275 // CAST(ROUND(price * 100) AS BIGINT))) AS DOUBLE) / 1127500 AS clicks
  FROM l0 GROUP BY camp_id""")
def _g_ledger_clicks(inp, p):
    return pl.scenario_ledger(inp, p).groupBy("camp_id").agg(
        exact_clicks(F.col("target_spend"), F.col("publisher_cpc")).alias("clicks"))


@query("agg_click_loads", """SELECT cc.camp_id, CAST(cc.rev AS DOUBLE) AS rev, cc.avg_cost AS avg_click_cost,
  COALESCE(a.n_rows, 0) AS rows_011, COALESCE(a.clk, 0) AS clk_011, CAST(COALESCE(a.rev, 0) AS DOUBLE) AS rev_011,
  COALESCE(b.n_rows, 0) AS rows_025, COALESCE(b.clk, 0) AS clk_025, CAST(COALESCE(b.rev, 0) AS DOUBLE) AS rev_025
  FROM camp_clicks cc LEFT JOIN feed_clicks a ON a.camp_id = cc.camp_id AND a.price = 0.11
  LEFT JOIN feed_clicks b ON b.camp_id = cc.camp_id AND b.price = 0.25""")
def _g_loads(inp, p):
    """Click rollups of three loads, stored as they arrive and added up. A click arrives in the load of its
    id's hash, a link in that of its own: before its click, with it, or after it."""
    spark = inp.campaigns.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/rollups-{uuid.uuid4().hex}"
    clicks = inp.clicks_of(p).withColumn("at", F.pmod(F.xxhash64("record_id"), F.lit(3)))
    links = facts.links_of(inp, inp.clicks_of(p), p).withColumn("at", F.pmod(F.xxhash64("click_id", "batch_id"), F.lit(3)))
    for load in range(3):
        sums = rollups.load_sums(clicks.filter(F.col("at") == load), links.filter(F.col("at") == load), inp.export_batches,
                                 clicks.filter(F.col("at") < load), links.filter(F.col("at") < load))
        rollups.store_load(sums, f"load-{load}", path)
    merged = facts.click_facts(replace(inp, click_rollups=rollups.read_rollups(spark, path)), p)
    return _known(merged, inp).select(
        "camp_id", dbl(F.col("rev")).alias("rev"), ratio(F.col("paid_cost"), F.col("paid_n")).alias("avg_click_cost"),
        *[c for t in ("011", "025") for c in (f"rows_{t}", f"clk_{t}", dbl(F.col(f"rev_{t}")).alias(f"rev_{t}"))])


@query("agg_multi_key", """SELECT camp_id, feed, CAST(COUNT(*) AS BIGINT) AS rows,
  CAST(SUM(CASE WHEN partner_source = 30647 AND reason_code = 99 THEN click_cost ELSE 0 END) AS DOUBLE) AS rev
  FROM feed_rows GROUP BY camp_id, feed""")
def _g_multi(inp, p):
    units = if_(is_main_billable(), money_units(F.col("click_cost")), 0)
    rolled = _linked_clicks(inp, p).groupBy("camp_id", "feed").agg(
        F.count(F.lit(1)).cast("long").alias("rows"), dbl(from_units(F.sum(units))).alias("rev"))
    return _known(rolled, inp)


def _linked_clicks(inp, p):
    clicks = inp.clicks_of(p)
    return (clicks.join(facts.links_of(inp, clicks, p), F.col("record_id") == F.col("click_id"))
            .join(inp.export_batches, F.col("batch_id") == F.col("id")))


@query("agg_by_alias", "SELECT camp_id, CAST(price AS DOUBLE) AS publisher_cpc, clk FROM feed_clicks")
def _g_alias(inp, p):
    rows = (_linked_clicks(inp, p).filter(F.col("feed") - 1 > 0)
            .withColumn("publisher_cpc", dbl(feed_price(F.col("feed")))))
    return _known(rows.groupBy("camp_id", "publisher_cpc").agg(
        F.sum(if_(is_main_billable(), 1, 0)).cast("long").alias("clk")), inp)


@query("agg_having", "SELECT camp_id FROM camp_clicks WHERE rev = 0")
def _g_having(inp, p):
    return _known(facts.campaign_click_totals(inp.clicks_of(p)).filter(F.col("rev") == 0), inp).select("camp_id")


@query("distinct_eligible", "SELECT DISTINCT c.user_id FROM campaigns c WHERE c.camp_id IN (SELECT camp_id FROM e1)")
def _distinct_e(inp, p):
    return inp.campaigns.join(elig.eligible_campaigns(inp, p), "camp_id", "left_semi").select("user_id").distinct()


# ---------------------------------------------------------------- set operations

@query("union_price_points", """SELECT f.camp_id, CAST(f.price AS DOUBLE) AS publisher_cpc, f.clk, CAST(f.rev AS DOUBLE) AS rev
  FROM feed_clicks f JOIN live c ON c.camp_id = f.camp_id
  WHERE f.camp_id IN (SELECT camp_id FROM e1) AND f.price = 0.11 AND c.cost_per_click > 0.18 AND f.rev > 0
  UNION SELECT f.camp_id, CAST(f.price AS DOUBLE), f.clk, CAST(f.rev AS DOUBLE)
  FROM feed_clicks f JOIN live c ON c.camp_id = f.camp_id
  WHERE f.camp_id IN (SELECT camp_id FROM e1) AND f.price = 0.25 AND c.cost_per_click > 0.40 AND f.rev > 0""")
def _u_price(inp, p):
    smallest = F.when(F.col("publisher_cpc") == float(PRICE_011), dec(MIN_CPC[PRICE_011])).otherwise(dec(MIN_CPC[PRICE_025]))
    rows = _feed_long(cand.campaign_frame(inp, p), "cost_per_click")
    return (rows.filter((F.col("feed_rev") > 0) & (cand.P() > smallest))
            .select("camp_id", "publisher_cpc", "clk", dbl(F.col("feed_rev")).alias("rev")).distinct())


@query("union_exclusions", "SELECT CAST(camp_id AS BIGINT) AS camp_id, CAST(price AS DOUBLE) AS publisher_cpc FROM excluded_keys")
def _u_excl(inp, p):
    return _excluded_keys(pl.entries_to_rows(pl.run_phases(pl.scenario_frame(inp, p), upto="stage_16"), "entries", p, "user_id"), inp)


def _excluded_keys(rows, inp):
    """Keys of ledger rows whose campaign or user is excluded at their price: each row meets
    the policies under both names, in one join."""
    names = F.array(*[F.struct(F.lit(entity).alias("entity"), F.col(key).alias("id")) for entity, key in (("user", "user_id"), ("camp", "camp_id"))])
    named = rows.select("camp_id", "publisher_cpc", F.explode(names).alias("who")).select("camp_id", "publisher_cpc", "who.*")
    excluded = inp.client_policy.filter(F.col("policy") == "exclude").select("entity", "id", "publisher_cpc")
    return named.join(excluded, ["entity", "id", "publisher_cpc"], "left_semi").select("camp_id", "publisher_cpc").distinct()


@query("union_exclusions_stored", "SELECT CAST(camp_id AS BIGINT) AS camp_id, CAST(price AS DOUBLE) AS publisher_cpc FROM excluded_keys", stored=True)
def _u_excl_stored(inp, p, existing):
    frame = pl.run_phases(pl.scenario_frame(inp, p, existing=existing), upto="stage_16")
    return _excluded_keys(pl.entries_to_rows(frame, "entries", p, "user_id"), inp)


@query("union_inclusions", "SELECT camp_id, CAST(price AS DOUBLE) AS publisher_cpc, CAST(include_spend AS DOUBLE) AS target_spend FROM included")
def _u_incl(inp, p):
    users = elig.eligible_users(inp, p).join(facts.user_policy_flags(inp), "id", "left")
    running = inp.campaigns.filter(elig.running_campaign(p)).select("camp_id", "user_id", "cost_per_click")
    camps = (elig.salted_user_join(running, users, inp, p)
             .join(facts.campaign_policy_flags(inp).withColumnRenamed("id", "camp_id"), "camp_id", "left"))
    arms = []
    for price in facts.PRICES:
        t = facts.price_tag(price)
        listed = F.coalesce(F.col(f"user_include_{t}"), F.lit(False)) | F.coalesce(F.col(f"camp_include_{t}"), F.lit(False))
        arms.append(F.when(listed & (cand.P() > MIN_CPC[price]), F.struct(
            F.lit(float(price)).alias("publisher_cpc"), F.lit(float(INCLUDE_SPEND[price])).alias("target_spend"))))
    return (camps.select("camp_id", F.explode_outer(F.array_compact(F.array(*arms))).alias("x")).filter(F.col("x").isNotNull())
            .select("camp_id", "x.publisher_cpc", "x.target_spend"))


# ---------------------------------------------------------------- scalar functions

@query("fn_searched_case", f"""SELECT camp_id,
  CASE WHEN cost_per_click > 0 THEN {O.DIV('system_daily_budget - cost_today', 'cost_per_click')} * 0.11
       WHEN cost_per_click = 0 THEN CAST((system_daily_budget - cost_today) * 0.40 AS DOUBLE) END AS raw_spend
  FROM live""")
def _x_case(inp, p):
    live = inp.campaigns.filter(elig.live_campaign(p))
    return live.select("camp_id", cand.untouched_spend().alias("raw_spend"))


@query("fn_feed_price", "SELECT id, feed, CAST(CASE feed - 1 WHEN 1 THEN 0.11 WHEN 2 THEN 0.25 END AS DOUBLE) AS publisher_cpc "
                        "FROM export_batches")
def _x_feed_price(inp, p):
    return inp.export_batches.select("id", "feed", dbl(feed_price(F.col("feed"))).alias("publisher_cpc"))


@query("fn_if", """SELECT record_id, camp_id,
  CAST(CASE WHEN partner_source = 30647 THEN CASE WHEN reason_code = 99 THEN click_cost ELSE 0 END ELSE 0 END AS DOUBLE) AS main_cost,
  CASE WHEN partner_source = 30647 THEN CASE WHEN reason_code = 99 THEN 1 ELSE 0 END ELSE 0 END AS main_click
  FROM ad_clicks WHERE date_date = DATE '2024-01-15'""")
def _x_if(inp, p):
    main = F.col("partner_source") == MAIN_PUBLISHER
    billable = F.col("reason_code") == 99
    return inp.clicks_of(p).select(
        "record_id", "camp_id", dbl(if_(main, if_(billable, F.col("click_cost"), 0), 0)).alias("main_cost"),
        if_(main, if_(billable, 1, 0), 0).alias("main_click"))


@query("fn_capped_spend", f"SELECT camp_id, {O.CAP('raw')} AS target_spend FROM s0")
def _x_capped(inp, p):
    frame = inp.campaigns.filter(elig.live_campaign(p)).join(inp.users.select("id"), F.col("user_id") == F.col("id"))
    return frame.filter(cand.untouched()).select("camp_id", capped(cand.untouched_spend(), SPEND_CAP).alias("target_spend"))


@query("fn_round_spend", f"SELECT camp_id, {O.R2('raw')} AS rounded FROM s3 WHERE camp_id IN (SELECT camp_id FROM e1)")
def _x_round(inp, p):
    rows = cand.campaign_frame(inp, p).filter(cand.no_revenue())
    return rows.select("camp_id", round2(cand.no_revenue_spend()).alias("rounded"))


@query("fn_floor_clicks", f"""SELECT camp_id,
  CAST({O.FLOORDIV4('system_daily_budget - cost_today', 'cost_per_click')} AS BIGINT) AS clicks_left
  FROM campaigns WHERE system_daily_budget IS NOT NULL AND cost_per_click >= 0.55""")
def _x_floor(inp, p):
    rows = inp.campaigns.filter(cand.B().isNotNull() & (cand.P() >= PREMIUM_MIN_CPC))
    return rows.select("camp_id", cand.whole_clicks_left().cast("long").alias("clicks_left"))


@query("fn_next_day", "SELECT camp_id, CAST(camp_end + INTERVAL 1 DAY AS DATE) AS day_after_end FROM campaigns")
def _x_next_day(inp, p):
    return inp.campaigns.select("camp_id", next_day(F.col("camp_end")).alias("day_after_end"))


@query("fn_run_date", f"SELECT date_date, date_date = {O.RUN_DATE} AS is_run_date, CAST(COUNT(*) AS BIGINT) AS rows "
                      "FROM ad_clicks GROUP BY date_date")
def _x_run_date(inp, p):
    return inp.ad_clicks.groupBy("date_date").agg(
        (F.col("date_date") == F.lit(p.run_date)).alias("is_run_date"), F.count(F.lit(1)).cast("long").alias("rows"))


@query("fn_arithmetic", f"""SELECT camp_id, CAST(system_daily_budget - cost_today AS DOUBLE) AS budget_left,
  {O.DIV('system_daily_budget - cost_today', 'cost_per_click')} AS clicks_left,
  CAST((system_daily_budget - cost_today) * 0.40 AS DOUBLE) AS share FROM live""")
def _x_arith(inp, p):
    live = inp.campaigns.filter(elig.live_campaign(p))
    left = cand.B() - cand.C()
    return live.select("camp_id", dbl(left).alias("budget_left"), ratio(left, cand.P()).alias("clicks_left"),
                       dbl(left * dec("0.40")).alias("share"))


@query("fn_composite_key", """SELECT DISTINCT CAST(pub AS BIGINT) AS publisher_id, CAST(price AS DOUBLE) AS publisher_cpc,
  CAST(camp_id AS BIGINT) AS camp_id,
  CAST(pub AS VARCHAR) || ':' || CAST(CAST(price AS DECIMAL(4,2)) AS VARCHAR) || ':' || CAST(camp_id AS VARCHAR) AS ledger_key
  FROM lca""")
def _x_key(inp, p):
    rows = pl.allocate(inp, p)
    key = ledger_key_text(F.col("publisher_id"), F.col("publisher_cpc"), F.col("camp_id"))
    return rows.select("publisher_id", "publisher_cpc", "camp_id", key.alias("ledger_key")).distinct()


# ---------------------------------------------------------------- business stages

@query("eligible_advertisers", "SELECT DISTINCT advertiser_id FROM e0")
def _e0(inp, p):
    return elig.eligible_advertisers(inp, p).distinct()


@query("eligible_campaigns", "SELECT camp_id FROM e1")
def _e1(inp, p):
    return elig.eligible_campaigns(inp, p)


@query("existing_keys", "SELECT DISTINCT CAST(pub AS BIGINT) AS publisher_id, CAST(price AS DOUBLE) AS publisher_cpc, "
                        "CAST(camp_id AS BIGINT) AS camp_id FROM l0")
def _keys(inp, p):
    return pl.scenario_ledger(inp, p).select("publisher_id", "publisher_cpc", "camp_id").distinct()


def _stage_query(step: int):
    sql = f"SELECT {O.CAND_COLS} FROM cand_e WHERE step = {step}"

    @query(f"stage_{step:02d}", sql)
    def _stage(inp, p):
        return pl.scenario_candidates(inp, p, step)
    return _stage


for _step in SCENARIO_ORDER:
    _stage_query(_step)

_PHASE_SQL = {
    "stage_12": "SELECT {cols} FROM t12",
    "stage_13": "SELECT {cols} FROM l13 WHERE step = 13",
    "stage_14": "SELECT {cols} FROM t14",
    "stage_15": "SELECT {cols} FROM t15",
    "stage_16": "SELECT {cols} FROM l16 WHERE step = 16",
    "stage_10": "SELECT {cols} FROM l10 WHERE step = 10",
    "stage_11": "SELECT {cols} FROM t11",
    "feed_ids": "SELECT {cols} FROM lfd WHERE feed_id IS NOT NULL",
    "active_flags": "SELECT {cols} FROM lac WHERE active = 1",
    "stage_601": "SELECT {cols} FROM t601",
    "partner_feed_ids": "SELECT {cols} FROM lcf WHERE pub = 68927 AND feed_id IS NOT NULL",
    "partner_active_flags": "SELECT {cols} FROM lca WHERE pub = 68927 AND active = 1",
}


def _phase_query(name: str):
    @query(name, _PHASE_SQL[name].format(cols=O.LEDGER_COLS))
    def _phase(inp, p):
        return pl.phase_rows(inp, p, name)
    return _phase


for _name in pl.PHASE_NAMES:
    _phase_query(_name)


@query("allocation", f"SELECT {O.LEDGER_COLS} FROM lca")
def _allocation(inp, p):
    return pl.allocate(inp, p)


# ---------------------------------------------------------------- runs over a stored ledger

@query("allocation_stored", f"SELECT {O.LEDGER_COLS} FROM lca", stored=True)
def _allocation_stored(inp, p, existing):
    return pl.allocate(inp, p, existing)


@query("stage_row_counts_stored", O.REPORT, stored=True)
def _stage_row_counts_stored(inp, p, existing):
    return pl.stage_row_counts(inp, p, existing)


@query("stage_10_stored", f"SELECT {O.LEDGER_COLS} FROM l10 WHERE step = 10", stored=True)
def _stage_10_stored(inp, p, existing):
    return pl.phase_rows(inp, p, "stage_10", existing)


@query("stage_11_stored", f"SELECT {O.LEDGER_COLS} FROM t11", stored=True)
def _stage_11_stored(inp, p, existing):
    return pl.phase_rows(inp, p, "stage_11", existing).filter(F.col("step_num") == 11)
