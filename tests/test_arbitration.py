"""Key exclusion: per-row array form == window form == brute-force sequential loop."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adspend.functions.spend import let
from adspend.operators.arbitration import arbitrate, arbitrate_entries
from adspend.params import SCENARIO_ORDER

candidate = st.tuples(st.integers(1, 4),                       # camp_id
                      st.sampled_from([0.11, 0.25]),           # price
                      st.sampled_from(SCENARIO_ORDER),         # step
                      st.integers(0, 3).map(float))            # spend (ties allowed)


def brute_force(cands):
    kept, keys = [], set()
    for step in SCENARIO_ORDER:
        snapshot = set(keys)
        for camp, price, s, spend in cands:
            if s == step and (camp, price) not in snapshot:
                kept.append((camp, price, s, spend))
                keys.add((camp, price))
    return sorted(kept)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(candidate, min_size=0, max_size=14))
def test_array_and_window_forms_equal_sequential_loop(spark, cands):
    expected = brute_force(cands)
    long_rows = [(camp, 30647, price, spend, step) for camp, price, step, spend in cands]
    long = spark.createDataFrame(long_rows, "camp_id long, publisher_id long, publisher_cpc double, "
                                            "target_spend double, step_num int")
    window = sorted((r.camp_id, r.publisher_cpc, r.step_num, r.target_spend) for r in arbitrate(long).collect())
    assert window == expected

    grouped = long.groupBy("camp_id").agg(F.collect_list(F.struct(
        "publisher_id", "publisher_cpc", "target_spend", "step_num")).alias("cands"))
    kept = grouped.select("camp_id", F.explode(let(F.col("cands"), arbitrate_entries)).alias("e"))
    array = sorted((r.camp_id, r.e.publisher_cpc, r.e.step_num, r.e.target_spend) for r in kept.collect())
    assert array == expected
