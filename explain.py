"""Print the formatted physical plan of the whole run over stored inputs.

Usage: python explain.py [sf_dir] [--large]
  --large  turns broadcasts off to show the plan Spark picks when every side is
           big (record_id / camp_id exchanges, partial aggregation, salted join)
The inputs are derived from the test tables and stored once in a scratch folder
(clicks partitioned by day), so the plan shows partition pruning as in production.
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from adspend.params import DEFAULT_PARAMS  # noqa: E402
from adspend.plans.allocation import allocate  # noqa: E402
from adspend.session import local_session  # noqa: E402
from adspend.sources.fixtures import fixture_inputs  # noqa: E402
from adspend.sources.tables import read_parquet_inputs, write_parquet_inputs  # noqa: E402


def main(argv: list[str]) -> None:
    sf_dir = next((a for a in argv[1:] if not a.startswith("--")), "/root/testdata/sf0.01")
    spark = local_session(8)
    if "--large" in argv:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    base = os.environ.get("EXPLAIN_OUT") or tempfile.mkdtemp(prefix="adspend-explain-")
    write_parquet_inputs(fixture_inputs(spark, sf_dir, DEFAULT_PARAMS), base)
    allocate(read_parquet_inputs(spark, base), DEFAULT_PARAMS).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
