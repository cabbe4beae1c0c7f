"""Click and account rollups: fan-out semantics of the fused aggregation."""

from __future__ import annotations

from decimal import Decimal

from adspend.operators import facts
from adspend.params import DEFAULT_PARAMS as P

from support import RUN


def _by_camp(df):
    return {r.camp_id: r.asDict() for r in df.collect()}


def test_batch_fanout_counts_in_feed_totals_only(make):
    b = make().user(1).campaign(1, 1, 50, 10, 0.5)
    b.batch(21, 2).batch(22, 2).batch(31, 3).batch(41, 4)
    b.click(1, 1, cost=0.2, batches=(21, 22))         # two feed-2 batches: counted twice per feed
    b.click(2, 1, cost=0.3, batches=(31, 41))         # feed 3 and an unpriced feed
    b.click(3, 1, cost=0.4, main=False, batches=(21,))  # other publisher: rows, no revenue
    b.click(4, 1, cost=0.5, day=RUN.replace(day=14), batches=(21,))  # another day: ignored
    f = _by_camp(facts.click_facts(b.build(), P))[1]
    assert f["click_rows"] == 3
    assert f["rev"] == Decimal("0.5")                  # 0.2 + 0.3, each click once
    assert f["paid_n"] == 3 and f["paid_cost"] == Decimal("0.9")
    assert (f["rows_011"], f["clk_011"], f["rev_011"]) == (3, 2, Decimal("0.4"))
    assert (f["rows_025"], f["clk_025"], f["rev_025"]) == (1, 1, Decimal("0.3"))


def test_click_without_batch_keeps_campaign_totals(make):
    b = make().user(1).campaign(1, 1, 50, 10, 0.5).click(1, 1, cost=0.2)
    f = _by_camp(facts.click_facts(b.build(), P))[1]
    assert f["rev"] == Decimal("0.2") and f["rows_011"] == 0 and f["rows_025"] == 0


def test_account_rollups_split_running_and_all(make):
    import datetime as dt
    b = make().user(1, account_budget=100)
    b.campaign(1, 1, 20, 5, 0.5).campaign(2, 1, None, 7, 0.5)
    b.campaign(3, 1, 30, 11, 0.5, status="no")                      # not running
    b.campaign(4, 1, None, 13, 0.5, end=dt.date(2024, 1, 1))        # ended
    r = facts.account_rollups(b.build(), P).collect()[0].asDict()
    assert r["spent_all"] == Decimal("36") and r["null_budget_all"] == 2
    assert r["spent_run"] == Decimal("12") and r["nb_run"] == Decimal("20")
    assert r["nn_run"] == 1 and r["n_run"] == 2


def test_hot_campaign_totals_are_exact(make):
    """One campaign with most of the clicks: totals equal a brute-force sum."""
    b = make().user(1).campaign(1, 1, 50, 10, 0.5).campaign(2, 1, 50, 10, 0.5).batch(21, 2)
    costs = [Decimal("0.05") + Decimal(i % 11) / 100 for i in range(3000)]
    for i, c in enumerate(costs):
        b.click(i, 1, cost=c, batches=(21,) if i % 3 == 0 else ())
    b.click(99999, 2, cost=0.3)
    f = _by_camp(facts.click_facts(b.build(), P))
    assert f[1]["click_rows"] == 3000 and f[2]["click_rows"] == 1
    assert f[1]["rev"] == sum(costs)
    assert f[1]["rev_011"] == sum(c for i, c in enumerate(costs) if i % 3 == 0)
    assert f[1]["clk_011"] == 1000
