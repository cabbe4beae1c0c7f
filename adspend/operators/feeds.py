"""Feed ids, active flags and the partner-publisher feed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adspend.functions.spend import dec, feed_id_of_price, round2
from adspend.operators.candidates import P, ledger_entry
from adspend.operators.ledger import append_if, spend_in_clicks, update_where
from adspend.params import (
    FEED_ID_BY_PRICE, PARTNER_FEED_ID, PARTNER_KEEP_ABOVE, PARTNER_MIN_CPC, PARTNER_PUBLISHER,
    PARTNER_SOURCE_STEPS, PRICE_025,
)

PRICED = tuple(float(p) for p in FEED_ID_BY_PRICE)


def is_priced(x: Column) -> Column:
    return x.publisher_cpc.isin(*PRICED)


def feed_ids(entries: Column) -> Column:
    """Entries at a known price get its job export feed id."""
    return update_where(entries, is_priced,
                        job_export_feed_id=lambda x: feed_id_of_price(x.publisher_cpc))


def is_live_on(*feed_ids_to_activate: int):
    return lambda x: (x.target_spend > 0) & x.job_export_feed_id.isin(*feed_ids_to_activate)


def active_flags(entries: Column, feed_ids_to_activate=tuple(FEED_ID_BY_PRICE.values())) -> Column:
    """``active_flag = 1`` where spend > 0 on each of the given feeds."""
    return update_where(entries, is_live_on(*feed_ids_to_activate), active_flag=1)


def partner_source(entries: Column) -> Column:
    """Active, positive entries of the steps the partner feed is built from."""
    return F.filter(entries, lambda x: x.step_num.isin(*PARTNER_SOURCE_STEPS)
                    & (x.target_spend > 0) & (x.active_flag == 1))


def partner_rollup(entries: Column) -> Column:
    """Step 601: the partner publisher gets, at 0.25, the same clicks as the active
    main-publisher entries, if worth more than 0.45 and the key is new."""
    src = partner_source(entries)
    value = spend_in_clicks(src) * dec(PRICE_025)
    taken = F.exists(entries, lambda x: (x.publisher_id == PARTNER_PUBLISHER)
                     & (x.publisher_cpc == float(PRICE_025)))
    cond = F.col("eligible") & (P() > PARTNER_MIN_CPC) & (F.size(src) > 0) & (value > PARTNER_KEEP_ABOVE) & ~taken
    return append_if(entries, cond, ledger_entry(PARTNER_PUBLISHER, PRICE_025, round2(value), 601))


def is_partner(x: Column) -> Column:
    return (x.publisher_id == PARTNER_PUBLISHER) & (x.publisher_cpc == float(PRICE_025))


def partner_feed_ids(entries: Column) -> Column:
    return update_where(entries, is_partner, job_export_feed_id=PARTNER_FEED_ID)


def is_live_partner(x: Column) -> Column:
    return ((x.publisher_id == PARTNER_PUBLISHER) & (x.target_spend > 0)
            & (x.job_export_feed_id == PARTNER_FEED_ID))


def partner_active_flags(entries: Column) -> Column:
    return update_where(entries, is_live_partner, active_flag=1)
