"""Run parameters of the daily allocation.

Every business constant lives in one frozen dataclass so that a run is fully
described by ``(inputs, AllocParams)``; nothing reads the wall clock.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from decimal import Decimal

# ---------------------------------------------------------------------------
# Fixed values. These must equal the allocation rules being reproduced; they
# are stated here once, in natural order, and referenced by name elsewhere.
#
#   main publisher id ........................ 30647
#   partner publisher id ..................... 68927
#   billable click reason code ............... 99
#   price points (price -> feed id) .......... 0.11 -> 2, 0.25 -> 3, 0.41 -> 4
#   partner price point (feed id) ............ 0.25 (5)
#   click feed -> price ...................... feed 2 -> 0.11, feed 3 -> 0.25
#   minimum cost per click ................... > 0.18 for 0.11, > 0.40 for 0.25,
#                                              > 0.55 for 0.41 inclusion,
#                                              >= 0.55 premium feed,
#                                              > 0.45 partner
#   spend bounds ............................. keep > 0.5, cap 100,
#                                              premium cap 600, partner keep > 0.45
#   near-exhausted margins ................... campaign 3, account 3 and 5
#   fixed spends ............................. inclusion 5 (0.41: 41),
#                                              premium uncapped 41, boost 1000
#   premium feed spend gate .................. cost today < 20
#   S9 top-up ................................ +10 below 50
#   partner source steps ..................... 0, 3, 4, 41, 7, 8, 9, 11, 12, 14, 15, 16
#   scenario run order ....................... 0, 1, 2, 3, 4, 41, 5, 6, 7, 8, 9
# ---------------------------------------------------------------------------

MAIN_PUBLISHER = 30647
PARTNER_PUBLISHER = 68927
BILLABLE_REASON = 99

PRICE_011 = Decimal("0.11")
PRICE_025 = Decimal("0.25")
PRICE_041 = Decimal("0.41")

FEED_ID_BY_PRICE = {PRICE_011: 2, PRICE_025: 3, PRICE_041: 4}
PARTNER_FEED_ID = 5
CLICK_FEED_PRICE = {2: PRICE_011, 3: PRICE_025}

MIN_CPC = {PRICE_011: Decimal("0.18"), PRICE_025: Decimal("0.40"), PRICE_041: Decimal("0.55")}
PREMIUM_MIN_CPC = Decimal("0.55")
PARTNER_MIN_CPC = Decimal("0.45")

KEEP_ABOVE = 0.5
SPEND_CAP = 100
PREMIUM_CAP = 600
PARTNER_KEEP_ABOVE = 0.45

CAMPAIGN_MARGIN = 3
ACCOUNT_MARGIN_NEAR = 3
ACCOUNT_MARGIN_WIDE = 5

INCLUDE_SPEND = {PRICE_011: 5, PRICE_025: 5, PRICE_041: 41}
PREMIUM_UNCAPPED_SPEND = 41
BOOST_SPEND = 1000
PREMIUM_MAX_COST_TODAY = 20
TOPUP_BELOW = 50
TOPUP = 10

PARTNER_SOURCE_STEPS = (0, 3, 4, 41, 7, 8, 9, 11, 12, 14, 15, 16)
SCENARIO_ORDER = (0, 1, 2, 3, 4, 41, 5, 6, 7, 8, 9)

# Policy names used in the ``client_policy`` input (rows instead of id lists).
POLICY_PREMIUM_FEED = "premium_feed"
POLICY_PREMIUM_BOOST = "premium_boost"
POLICY_EXCLUDE = "exclude"
POLICY_INCLUDE = "include"


@dataclass(frozen=True)
class AllocParams:
    """Everything a run depends on besides its input tables."""

    run_date: _dt.date = _dt.date(2024, 1, 15)
    # Case-insensitive LIKE pattern of companies whose campaigns are never eligible.
    excluded_company_pattern: str = "%excluded co%"
    excluded_vertical_types: tuple[str, ...] = ("NA", "OTHER")
    job_board_type: str = "Job Board"
    campaign_type: str = "pjl"
    active_status: str = "yes"
    user_active_status: int = 1
    excluded_product: str = "selfserve"
    excluded_country: str = "ca"
    # Skew: an account with more campaigns than this is spread over at least
    # ``account_salt_buckets`` join partitions (operators.eligibility.salted_user_join).
    hot_account_campaigns: int = 100_000
    account_salt_buckets: int = 64
    # Bits of the filter of running campaigns, as a power of two: 23 is 1 MB (operators.campaign_filter).
    campaign_filter_bits: int = 23

    @property
    def target_date(self) -> _dt.date:
        """The ledger date the run writes: the day after the run date."""
        return self.run_date + _dt.timedelta(days=1)


DEFAULT_PARAMS = AllocParams()
