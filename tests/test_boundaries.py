"""Hand-written boundary rows for the stage rules (edges of every band and cap)."""

from __future__ import annotations

from adspend.operators.eligibility import eligible_advertisers, eligible_campaigns
from adspend.params import DEFAULT_PARAMS as P
from adspend.plans import allocation as pl


def _cands(inputs, step):
    return sorted((r.camp_id, r.publisher_cpc, r.target_spend)
                  for r in pl.scenario_candidates(inputs, P, step).collect())


def _phase(inputs, name):
    return sorted((r.camp_id, r.publisher_cpc, r.target_spend, r.step_num)
                  for r in pl.phase_rows(inputs, P, name).collect())


def test_vertical_filter_three_valued(make):
    b = make()
    b.vertical(1, "", "raa").vertical(2, "NA", "raa").vertical(3, "OTHER", "raa")
    b.vertical(4, "Job Board", "").vertical(5, "Job Board", None).vertical(6, None, "raa")
    b.vertical(7, "Job Board", "raa").vertical(8, "BUILDING", "")
    got = sorted(r.advertiser_id for r in eligible_advertisers(b.build(), P).collect())
    assert got == [7, 8]


def test_eligibility_user_and_campaign_filters(make):
    b = make()
    b.user(1).user(2, status=0).user(3, company="Big EXCLUDED Co").user(4, product="selfserve")
    b.user(5, country="ca").user(6, credits=500, debits=500)
    for uid in range(1, 7):
        b.campaign(uid * 10, uid, 50, 0, 0.3)
    b.campaign(11, 1, 50, 0, 0.3, camp_type="xml").campaign(12, 1, 50, 0, 0.3, status="no")
    import datetime as dt
    b.campaign(13, 1, 50, 0, 0.3, end=dt.date(2024, 1, 14))
    got = sorted(r.camp_id for r in eligible_campaigns(b.build(), P).collect())
    assert got == [10]


def test_near_exhausted_band_edges(make):
    # budget - cost = 3 (out), 2.99 (in), 0 (in), -0.01 (out); clicks without main revenue
    b = make().user(1)
    for camp, (budget, cost) in {1: (10, 7), 2: (10, 7.01), 3: (10, 10), 4: (10, 10.01)}.items():
        b.campaign(camp, 1, budget, cost, 0.3).click(100 + camp, camp, main=False)
    assert [c[0] for c in _cands(b.build(), 1)] == [2, 3]


def test_underspent_band_and_spend_formula(make):
    # budget - cost = 3 exactly is underspent; spend = (B - C) / P * 0.11, rounded
    b = make().user(1).campaign(1, 1, 3, 0, 0.19).campaign(2, 1, 2.99, 0, 0.19)
    assert _cands(b.build(), 0) == [(1, 0.11, 1.74)]


def test_price_point_minimum_is_strict(make):
    b = make().user(1).campaign(1, 1, 50, 0, 0.18).campaign(2, 1, 50, 0, 0.181)
    assert [c[0] for c in _cands(b.build(), 0)] == [2]


def test_stage2_keep_round_and_cap(make):
    # spend = clicks * 0.25 * 0.9: 2 -> 0.45 dropped, 3 -> 0.675 -> 0.68, 445 -> 100.125 -> 100
    b = make().user(1).batch(7, 3)
    rid = 0
    for camp, clicks in {1: 2, 2: 3, 3: 445}.items():
        b.campaign(camp, 1, 10, 8, 0.5)
        for _ in range(clicks):
            rid += 1
            b.click(rid, camp, batches=(7,))
    assert _cands(b.build(), 2) == [(2, 0.25, 0.68), (3, 0.25, 100.0)]


def test_no_billable_click_gives_no_average(make):
    b = make().user(1).campaign(1, 1, 50, 10, 0.3).click(1, 1, billable=False, main=False)
    b.campaign(2, 1, 50, 10, 0.3).click(2, 2, main=False)
    # campaign 1: average cost NULL -> no row; campaign 2: billable on another publisher
    assert [c[0] for c in _cands(b.build(), 3)] == [2]


def test_stage4_branches(make):
    b = make().user(1).batch(2, 2).batch(3, 3).batch(4, 4)
    b.campaign(1, 1, 50, 10, 0.5).click(1, 1, cost=0.2, batches=(2,))          # all on feed 2
    b.campaign(2, 1, 50, 10, 0.5).click(2, 2, cost=0.2, batches=(2,)).click(3, 2, cost=0.2, batches=(3,))
    b.campaign(3, 1, 50, 10, 0.5).click(4, 3, cost=0.2, batches=(4,))          # feed 4: no price
    got = _cands(b.build(), 4)
    # 1: 1*0.11 + 40*0.25/0.2*0.11 = 5.61; 2 at 0.11: 0.11 (dropped); 2 at 0.25: 0.25 + 40*0.40/0.2*0.25
    assert got == [(1, 0.11, 5.61), (2, 0.25, 20.25)]


def test_key_exclusion_first_stage_wins(make):
    # Account with room (AB=100, spent 5, one uncapped campaign at 0.5) and one click on
    # the 0.11 feed: stage 7 and stage 8 both propose (30647, 0.11, 1); stage 7 runs first.
    b = make().user(1, account_budget=100).batch(2, 2)
    b.campaign(1, 1, None, 5, 0.5).click(1, 1, cost=0.2, batches=(2,))
    inputs = b.build()
    assert _cands(inputs, 7) == [(1, 0.11, 8.47)]   # ((95*0.40/0.5) + 1) * 0.11
    assert _cands(inputs, 8) == [(1, 0.11, 8.36)]   # (95*0.40/0.5) * 0.11
    ledger = sorted((r.camp_id, r.publisher_cpc, r.target_spend, r.step_num)
                    for r in pl.scenario_ledger(inputs, P).collect())
    assert ledger == [(1, 0.11, 8.47, 7)]


def test_not_in_with_null_exported_id_empties_stage8(make):
    b = make().user(1, account_budget=100).campaign(1, 1, None, 10, 0.5).batch(9, 2)
    assert [c[0] for c in _cands(b.build(), 8)] == [1]
    b.exported(None, 9)
    assert _cands(b.build(), 8) == []


def test_stage8_share_of_account(make):
    # AB=100, running spend 10, no capped budgets, 2 uncapped campaigns at 0.5:
    # (100-10)*0.40/(2*0.5)*0.11 = 3.96
    b = make().user(1, account_budget=100).campaign(1, 1, None, 5, 0.5).campaign(2, 1, None, 5, 0.5)
    assert _cands(b.build(), 8) == [(1, 0.11, 3.96), (2, 0.11, 3.96)]


def test_stage9_topup_below_50(make):
    b = make().user(1).batch(3, 3)
    rid = 0
    for camp, clicks in {1: 199, 2: 200}.items():
        b.campaign(camp, 1, None, 5, 0.5)
        for _ in range(clicks):
            rid += 1
            b.click(rid, camp, batches=(3,))
    assert _cands(b.build(), 9) == [(1, 0.25, 59.75), (2, 0.25, 50.0)]


def test_stage15_writes_negative_spend(make):
    b = make().user(1).policy("premium_feed", "user", 1)
    b.campaign(1, 1, 10, 12, 0.55)  # floor(-2 / 0.55) = -4 -> -1.64
    assert _phase(b.build(), "stage_15") == [(1, 0.41, -1.64, 15)]


def test_stage14_premium_minimum_is_inclusive(make):
    b = make().user(1).policy("premium_feed", "user", 1)
    b.campaign(1, 1, None, 5, 0.55).campaign(2, 1, None, 5, 0.549)
    assert _phase(b.build(), "stage_14") == [(1, 0.41, 41.0, 14)]


def test_include_list_duplicates_give_one_row(make):
    b = make().user(1).policy("include", "user", 1, 0.11).policy("include", "user", 1, 0.11)
    b.policy("include", "camp", 1, 0.11)
    b.campaign(1, 1, 50, 49, 0.3)  # no stage 0-9 row (not underspent, no clicks)
    assert _phase(b.build(), "stage_11") == [(1, 0.11, 5.0, 11)]


def test_partner_rollup_and_flags(make):
    b = make().user(1).campaign(1, 1, 50, 0, 0.5)   # stage 0: 50/0.5*0.11 = 11
    rows = sorted((r.publisher_id, r.publisher_cpc, r.target_spend, r.step_num, r.job_export_feed_id,
                   r.active_flag) for r in pl.allocate(b.build(), P).collect())
    assert rows == [(30647, 0.11, 11.0, 0, 2, 1), (68927, 0.25, 25.0, 601, 5, 1)]
