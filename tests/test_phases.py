"""Later phases on hand-written rows: premium feed, boost, exclusions, partner feed."""

from __future__ import annotations

from adspend.params import DEFAULT_PARAMS as P
from adspend.plans import allocation as pl


def _ledger(inputs):
    return sorted((r.camp_id, r.publisher_id, r.publisher_cpc, r.target_spend, r.step_num,
                   r.job_export_feed_id, r.active_flag) for r in pl.allocate(inputs, P).collect())


def test_premium_rollup_zeroes_the_source_rows(make):
    # stage 0 row at 0.11 (spend 50/0.55*0.11 = 10), premium user with cost today 0 < 20:
    # step 12 adds 0.41 worth the same clicks (10/0.11*0.41 = 37.27), step 13 zeroes the 0.11 row
    b = make().user(1).policy("premium_feed", "user", 1).campaign(1, 1, 50, 0, 0.55)
    rows = _ledger(b.build())
    assert rows == [
        (1, 30647, 0.11, 0.0, 13, 2, 0),
        (1, 30647, 0.41, 37.27, 12, 4, 1),
        (1, 68927, 0.25, 22.73, 601, 5, 1),  # 37.27/0.41*0.25
    ]


def test_boost_sets_premium_entries_to_1000(make):
    b = make().user(1).policy("premium_feed", "user", 1).policy("premium_boost", "user", 1)
    b.campaign(1, 1, None, 5, 0.6)   # no budget, not in ledger: step 14 at 41, then boosted
    rows = _ledger(b.build())
    assert rows[0] == (1, 30647, 0.41, 1000.0, 16, 4, 1)
    assert rows[1][:5] == (1, 68927, 0.25, 609.76, 601)  # 1000/0.41*0.25


def test_exclusions_by_user_and_by_campaign(make):
    b = make().user(1).user(2).campaign(1, 1, 50, 0, 0.5).campaign(2, 2, 50, 0, 0.5)
    b.policy("exclude", "user", 1, 0.11).policy("exclude", "camp", 2, 0.25)
    rows = _ledger(b.build())
    # campaign 1: excluded at 0.11 -> spend 0, step 10, inactive, so no partner row
    assert (1, 30647, 0.11, 0.0, 10, 2, 0) in rows
    assert not any(r[0] == 1 and r[1] == 68927 for r in rows)
    # campaign 2: excluded at 0.25 only, its 0.11 row stays and feeds the partner
    assert (2, 30647, 0.11, 11.0, 0, 2, 1) in rows
    assert any(r[0] == 2 and r[1] == 68927 for r in rows)


def test_partner_uses_only_listed_active_steps(make):
    # step 1 row (spend 0) never feeds the partner; a step 0 row does
    b = make().user(1).campaign(1, 1, 10, 9, 0.5).click(1, 1, main=False)   # near exhausted -> step 1
    b.campaign(2, 1, 50, 0, 0.5)                                            # step 0
    rows = _ledger(b.build())
    assert (1, 30647, 0.11, 0.0, 1, 2, 0) in rows
    assert [r[0] for r in rows if r[1] == 68927] == [2]
