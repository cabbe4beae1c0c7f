"""Ledger phases after the scenarios: premium feed (12-16), exclusions (10), inclusions (11).

A campaign's ledger rows for the target date are kept as an array of entry
structs on the campaign row. Every phase is a pure ``array -> array`` column
expression: an UPDATE becomes ``transform`` with a condition, and an INSERT
becomes ``concat`` of a conditional entry. All keys of a campaign live in its own
array, so "is the campaign (at this price) already in the ledger" is an
``exists`` over that array, with no anti-join and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adspend.functions.spend import capped_no_round, dec, round2
from adspend.operators.candidates import B, C, P, ledger_entry, whole_clicks_left
from adspend.operators.facts import PRICES, price_tag
from adspend.params import (
    BOOST_SPEND, INCLUDE_SPEND, KEEP_ABOVE, MAIN_PUBLISHER, MIN_CPC, PREMIUM_CAP,
    PREMIUM_MAX_COST_TODAY, PREMIUM_MIN_CPC, PREMIUM_UNCAPPED_SPEND, PRICE_011, PRICE_025,
    PRICE_041,
)


def append_if(entries: Column, cond: Column, entry: Column) -> Column:
    """INSERT of at most one entry."""
    return F.when(cond, F.concat(entries, F.array(entry))).otherwise(entries)


def update_where(entries: Column, pred, **changes) -> Column:
    """UPDATE ... SET field = value WHERE pred(entry); a value may be a function of the entry."""
    def apply(x: Column) -> Column:
        out = x
        for name, value in changes.items():
            if callable(value):
                value = value(x)
            out = out.withField(name, value if isinstance(value, Column) else F.lit(value))
        return F.when(pred(x), out).otherwise(x)
    return F.transform(entries, apply)


def has_price(entries: Column, price) -> Column:
    return F.exists(entries, lambda x: x.publisher_cpc == float(price))


def spend_in_clicks(entries: Column) -> Column:
    """``sum(target_spend / publisher_cpc)`` over entries, added in key order."""
    return F.aggregate(F.array_sort(entries), F.lit(0.0),
                       lambda acc, x: acc + x.target_spend / x.publisher_cpc)


def _premium_gate() -> Column:
    return (F.col("user_premium_feed") & (C() < PREMIUM_MAX_COST_TODAY) & (P() >= PREMIUM_MIN_CPC))


def premium_rollup(entries: Column) -> Column:
    """Step 12: premium users' campaigns already in the ledger get a 0.41 entry worth
    the same clicks. Spend 0 is possible (step 1 rows); no key exclusion."""
    spend = round2(spend_in_clicks(entries) * dec(PRICE_041))
    return append_if(entries, _premium_gate() & (F.size(entries) > 0),
                     ledger_entry(MAIN_PUBLISHER, PRICE_041, spend, 12))


def is_premium_zero(x: Column) -> Column:
    return x.publisher_cpc.isin(float(PRICE_011), float(PRICE_025)) & _premium_gate()


def premium_zero(entries: Column) -> Column:
    """Step 13: those campaigns' 0.11 / 0.25 entries are set to spend 0."""
    return update_where(entries, is_premium_zero, target_spend=0.0, step_num=13)


def _premium_new() -> Column:
    return F.col("eligible") & F.col("user_premium_feed") & (P() >= PREMIUM_MIN_CPC)


def premium_uncapped(entries: Column) -> Column:
    """Step 14: premium campaign without budget and not in the ledger: 0.41 at 41."""
    cond = _premium_new() & B().isNull() & (F.size(entries) == 0)
    return append_if(entries, cond, ledger_entry(MAIN_PUBLISHER, PRICE_041,
                                                 F.lit(PREMIUM_UNCAPPED_SPEND), 14))


def premium_capped(entries: Column) -> Column:
    """Step 15: with a budget: floor((B-C)/P)*0.41 capped at 600, no lower bound
    (0 and negative spends are written). Exact DECIMAL quotient before the floor."""
    spend = capped_no_round(whole_clicks_left() * dec(PRICE_041), PREMIUM_CAP)
    cond = _premium_new() & B().isNotNull() & (F.size(entries) == 0)
    return append_if(entries, cond, ledger_entry(MAIN_PUBLISHER, PRICE_041, spend, 15))


def is_boosted(x: Column) -> Column:
    return (x.publisher_cpc == float(PRICE_041)) & F.col("user_premium_boost")


def premium_boost(entries: Column) -> Column:
    """Step 16: every 0.41 entry of a boosted user is set to 1000."""
    return update_where(entries, is_boosted, target_spend=float(BOOST_SPEND), step_num=16)


def _flag(kind: str, price) -> Column:
    t = price_tag(price)
    return F.col(f"user_{kind}_{t}") | F.col(f"camp_{kind}_{t}")


def is_excluded(x: Column) -> Column:
    at = [(x.publisher_cpc == float(price)) & _flag("exclude", price) for price in PRICES]
    return at[0] | at[1] | at[2]


def exclusions(entries: Column) -> Column:
    """Step 10: excluded users / campaigns: entries at the excluded price get spend 0
    (any publisher)."""
    return update_where(entries, is_excluded, target_spend=0.0, step_num=10)


def inclusions(entries: Column) -> Column:
    """Step 11: included users / campaigns get a fixed spend at each listed price
    where the campaign has no entry yet. All arms test the same snapshot."""
    new = []
    for price in PRICES:
        spend = F.lit(float(INCLUDE_SPEND[price]))
        cond = (F.col("eligible") & _flag("include", price) & (P() > MIN_CPC[price]) & ~has_price(entries, price)
                & (spend > KEEP_ABOVE))
        new.append(F.when(cond, ledger_entry(MAIN_PUBLISHER, price, spend, 11)))
    return F.concat(entries, F.filter(F.array(*new), lambda x: x.isNotNull()))


# --- long-form ledger updates (a ledger as rows, e.g. read back from storage) ---

def update_rows(ledger_rows, cond: Column, **changes):
    """``UPDATE ledger SET col = value WHERE cond`` as a projection of the rows."""
    out = ledger_rows
    for name, value in changes.items():
        value = value if isinstance(value, Column) else F.lit(value)
        out = out.withColumn(name, F.when(cond, value).otherwise(F.col(name)).cast(
            ledger_rows.schema[name].dataType))
    return out


def keyed_update(ledger_rows, keys, on: list[str], **changes):
    """``UPDATE ... WHERE (k1, k2) IN keys``: a left join to the distinct keys, then a
    conditional projection. The key set is not collected, and each row is updated once."""
    flagged = keys.select(*on).distinct().withColumn("_hit", F.lit(True))
    joined = ledger_rows.join(flagged, on, "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    return update_rows(joined, hit, **changes).drop("_hit").select(*ledger_rows.columns)
