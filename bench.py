"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

  derive_inputs - map the driver tables to the eight inputs and store them as
                  Parquet (clicks partitioned by day); the runs below read them
  facts       - today's click rollups (campaign totals and per-feed totals)
  scenarios   - candidates of stages 0-9 plus key exclusion
  allocation  - the whole run, written as the target date's partition
  and a few operator queries of the registry. Each query is forced with the
  ``noop`` sink (full execution, no collect) except ``allocation``, which writes
  Parquet. Timings are wall-clock seconds, best of three runs for the headline
  queries and of two for the others (the first run of a plan also pays code
  generation; the input derivation runs once).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from adspend.operators.facts import click_facts  # noqa: E402
from adspend.params import DEFAULT_PARAMS  # noqa: E402
from adspend.plans import allocation as pl  # noqa: E402
from adspend.plans.catalog import REGISTRY  # noqa: E402
from adspend.session import local_session  # noqa: E402
from adspend.sources.fixtures import fixture_inputs  # noqa: E402
from adspend.sources.tables import read_parquet_inputs, write_parquet_inputs  # noqa: E402

OPERATOR_QUERIES = ("eligible_campaigns", "join_total_vs_feed", "anti_join_existing_keys", "stage_601")


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="adspend-bench")
    params = DEFAULT_PARAMS
    out_dir = os.environ.get("BENCH_OUT") or tempfile.mkdtemp(prefix="adspend-bench-")

    _noop(REGISTRY["eligible_advertisers"].run(spark, sf_dir))  # warm-up (JVM, file listing)

    timings: dict[str, float] = {}

    def timed(name, fn, runs=2):
        best = None
        for _ in range(runs):
            t = time.perf_counter()
            fn()
            elapsed = time.perf_counter() - t
            best = elapsed if best is None else min(best, elapsed)
        timings[name] = round(best, 3)

    timed("derive_inputs", lambda: write_parquet_inputs(fixture_inputs(spark, sf_dir, params),
                                                        f"{out_dir}/inputs"), runs=1)
    inputs = read_parquet_inputs(spark, f"{out_dir}/inputs")

    timed("facts", lambda: _noop(click_facts(inputs, params)), runs=3)
    timed("scenarios", lambda: _noop(pl.scenario_ledger(inputs, params)), runs=3)
    timed("allocation", lambda: pl.write_ledger(pl.allocate(inputs, params), f"{out_dir}/ledger"), runs=3)
    for name in OPERATOR_QUERIES:
        timed(name, lambda n=name: _noop(REGISTRY[n].run(spark, sf_dir)))

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "adspend_total_wall", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
