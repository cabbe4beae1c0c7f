"""Ledger in buckets: an update writes only the buckets that hold a key."""

from __future__ import annotations

import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from adspend.operators.ledger import keyed_update
from adspend.params import DEFAULT_PARAMS as P
from adspend.schemas import LEDGER
from adspend.sources.ledger_store import store_ledger, update_stored
from adspend.sources.tables import read_ledger

DAY = P.target_date
KEYS = "camp_id long, publisher_cpc double"
ON = ["camp_id", "publisher_cpc"]


def ledger(spark, camps, day=DAY):
    rows = [(day, 30647, price, c, 7.0, 3, None, 0) for c in camps for price in (0.11, 0.25)]
    rows += rows[:2]  # stored rows may repeat a key
    return spark.createDataFrame(rows, LEDGER)


def files(path):
    found = glob.glob(f"{path}/**/part-*", recursive=True)
    return {os.path.relpath(f, path): os.stat(f).st_mtime_ns for f in found}


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def stored(spark):
    path = tempfile.mkdtemp(prefix="adspend-test-buckets-")
    store_ledger(ledger(spark, range(200)), path, DAY, buckets=16, first=True)
    store_ledger(ledger(spark, range(50), DAY.replace(day=3)), path, DAY.replace(day=3), buckets=16)
    return path


def test_files_without_a_key_keep_their_names(spark, stored):
    before, earlier, other = files(stored), read_ledger(spark, stored, DAY), rows_of(read_ledger(spark, stored, DAY.replace(day=3)))
    keys = spark.createDataFrame([(0, 0.11), (0, 0.11), (7, 0.25), (7, 0.41), (5000, 0.11), (None, 0.11)], KEYS)
    want = rows_of(keyed_update(earlier, keys, ON, target_spend=0.0, step_num=10).select(*LEDGER.fieldNames()))
    touched = update_stored(spark, stored, DAY, keys, ON, target_spend=0.0, step_num=10)
    after = files(stored)
    kept = {f for f in before if before[f] == after.get(f)}
    assert 1 <= touched <= 2 and len(before) - len(kept) == touched and len(after) == len(before)
    assert rows_of(read_ledger(spark, stored, DAY)) == want
    assert sum("target_spend=0.0" in r for r in want) == 3  # (0, 0.11) is stored twice
    assert rows_of(read_ledger(spark, stored, DAY.replace(day=3))) == other


def test_keys_without_rows_write_nothing(spark, stored):
    before = files(stored)
    for rows in ([], [(5000, 0.11), (None, None)]):
        assert update_stored(spark, stored, DAY, spark.createDataFrame(rows, KEYS), ON, target_spend=0.0) == 0
    assert files(stored) == before


def test_a_failing_update_leaves_the_rows(spark, stored):
    before = files(stored)
    keys = spark.createDataFrame([(c, 0.11) for c in range(200)], KEYS)
    broken = F.when(F.col("camp_id") == 150, F.raise_error(F.lit("a task fails")).cast("double")).otherwise(0.0)
    with pytest.raises(Exception, match="a task fails"):
        update_stored(spark, stored, DAY, keys, ON, target_spend=broken)
    assert files(stored) == before


def test_storing_a_day_again_leaves_no_earlier_row(spark, stored):
    again = ledger(spark, range(3))
    store_ledger(again, stored, DAY, buckets=16)
    assert rows_of(read_ledger(spark, stored, DAY)) == rows_of(again)
    store_ledger(again.limit(0), stored, DAY, buckets=16)
    assert read_ledger(spark, stored, DAY).count() == 0
    assert read_ledger(spark, stored, DAY.replace(day=3)).count() == 102
