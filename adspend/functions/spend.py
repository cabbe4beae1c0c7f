"""Column expressions shared by the stages (all JVM-side built-ins, no UDFs).

Numeric policy: money stays DECIMAL through sums, differences and products,
which are exact. A quotient is taken in DOUBLE (``ratio``), and any later
factor applies to that double. Spend leaves every stage as DOUBLE.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from adspend.params import (
    BILLABLE_REASON, CLICK_FEED_PRICE, FEED_ID_BY_PRICE, MAIN_PUBLISHER, AllocParams,
)


def dec(value) -> Column:
    """An exact DECIMAL literal (``0.11`` stays 0.11, not a binary double)."""
    return F.lit(Decimal(str(value)))


MONEY_SCALE = 4
MONEY_TOTAL = "decimal(18,4)"


def money_units(c: Column) -> Column:
    """A DECIMAL(12,4) amount as a whole number of 1/10000 units (exact, BIGINT).

    Sums of DECIMAL(12,4) widen past 18 digits, which Spark computes with
    java.math.BigDecimal. Summing units as BIGINT is exact and runs on longs.
    """
    return (c * dec(10 ** MONEY_SCALE)).cast("long")


def from_units(c: Column) -> Column:
    """Inverse of ``money_units`` for a summed total: exact DECIMAL(18,4)."""
    return (c.cast("decimal(18,0)") / dec(10 ** MONEY_SCALE)).cast(MONEY_TOTAL)


def dbl(c: Column) -> Column:
    return c.cast("double")


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` in DOUBLE; NULL when ``den`` is 0 or NULL (MySQL's x/0)."""
    return F.when(den != 0, dbl(num) / dbl(den))


# 11 x 25 x 41: every price point in cents divides it, so spend / price is a whole number of its parts
CLICK_PARTS = 11_275


def exact_clicks(spend: Column, price: Column) -> Column:
    """``sum(spend / price)`` for prices of the price list and spend of at most four decimals.

    The terms are added as whole numbers over one denominator, so the sum does not depend on the
    order of the rows; one division comes last. Another price fails the job.
    """
    cents = F.round(price * 100).cast("long")
    refused = F.raise_error(F.concat(F.lit("not a price point: "), price.cast("string"))).cast("long")
    parts = F.when(cents.isin([round(100 * p) for p in FEED_ID_BY_PRICE]), F.expr(str(CLICK_PARTS)) / cents).when(price.isNotNull(), refused)
    units = F.round(spend * 10 ** MONEY_SCALE).cast("long")
    return dbl(F.sum(units * parts.cast("long"))) / (CLICK_PARTS * 10 ** (MONEY_SCALE - 2))


def capped(x: Column, cap: int) -> Column:
    """``case when x > cap then cap else round(x, 2) end`` as DOUBLE."""
    return dbl(F.when(x > cap, F.lit(cap)).otherwise(F.round(x, 2)))


def capped_no_round(x: Column, cap: int) -> Column:
    """``case when x > cap then cap else x end`` as DOUBLE."""
    return dbl(F.when(x > cap, F.lit(cap)).otherwise(x))


def round2(x: Column) -> Column:
    return dbl(F.round(x, 2))


def if_(cond: Column, then, otherwise) -> Column:
    """MySQL ``IF(cond, a, b)``: a NULL condition takes the ELSE branch."""
    return F.when(cond, then).otherwise(otherwise)


def is_billable() -> Column:
    return F.col("reason_code") == BILLABLE_REASON


def is_main_billable() -> Column:
    """Billable click bought on the main publisher."""
    return (F.col("partner_source") == MAIN_PUBLISHER) & is_billable()


def feed_price(feed: Column) -> Column:
    """Simple CASE on ``feed - 1``: the price point a click feed is sold at, else NULL."""
    out = None
    for feed_id, price in CLICK_FEED_PRICE.items():
        out = (F.when(feed - 1 == feed_id - 1, dec(price)) if out is None
               else out.when(feed - 1 == feed_id - 1, dec(price)))
    return out


def feed_id_of_price(price: Column) -> Column:
    """Searched CASE price -> job export feed id; NULL for other prices."""
    out = None
    for p, feed_id in FEED_ID_BY_PRICE.items():
        cond = price == float(p)
        out = F.when(cond, F.lit(feed_id)) if out is None else out.when(cond, F.lit(feed_id))
    return out


def run_date(params: AllocParams) -> Column:
    return F.lit(params.run_date)


def next_day(d: Column | _dt.date) -> Column:
    """``DATE_ADD(d, INTERVAL 1 DAY)``."""
    return F.date_add(F.lit(d) if isinstance(d, _dt.date) else d, 1)


def near_exhausted(budget: Column, spent: Column, margin: int) -> Column:
    """Budget set and almost used: ``B > 0 and C <= B and B - m < C``."""
    return (budget > 0) & (spent <= budget) & (budget - margin < spent)


def underspent(budget: Column, spent: Column, margin: int) -> Column:
    """At least ``margin`` left: ``B - m >= C``."""
    return budget - margin >= spent


def ledger_key_text(publisher_id: Column, publisher_cpc: Column, camp_id: Column) -> Column:
    """The ledger key as text, ``publisher:price:campaign`` with the price at two
    decimals. Separators keep distinct keys distinct."""
    return F.concat_ws(":", publisher_id.cast("string"), publisher_cpc.cast("decimal(4,2)").cast("string"),
                       camp_id.cast("string"))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    ``body`` may use its argument many times. The optimizer can then merge
    consecutive projections without copying ``value`` into every use, so plan
    size and per-row work grow linearly with the number of chained steps.
    """
    return F.transform(F.array(value), lambda v: body(v)).getItem(0)


def _session_key() -> tuple:
    session = SparkSession.getActiveSession()
    try:
        return session.sparkContext.applicationId, session.sparkContext.startTime
    except Exception:  # no session yet, or a Spark Connect session without a context on the client
        return (id(session),)


def session_cached(fn):
    """Cache a Column builder per Spark application.

    Column expressions only name columns, so one built Column can serve every
    DataFrame of the session. Building the large stage expressions once saves
    thousands of driver-to-JVM calls per query.
    """
    cache: dict = {}

    def wrapper(*args):
        key = (_session_key(), args)
        if key not in cache:
            cache[key] = fn(*args)
        return cache[key]

    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper
