"""Sources and sinks: stored inputs round-trip, schema checks, day partitions."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adspend import schemas
from adspend.params import DEFAULT_PARAMS as P
from adspend.sources.fixtures import fixture_inputs
from adspend.sources.tables import DAY_COLUMNS, read_parquet_inputs, write_parquet_inputs

from support import SF_SMALL


def test_stored_inputs_round_trip_with_schemas(spark):
    base = tempfile.mkdtemp(prefix="adspend-test-inputs-")
    derived = fixture_inputs(spark, SF_SMALL, P)
    write_parquet_inputs(derived, base)
    stored = read_parquet_inputs(spark, base)
    for name, schema in schemas.INPUT_SCHEMAS.items():
        df = getattr(stored, name)
        want = [(f.name, f.dataType) for f in schema.fields]
        if name in DAY_COLUMNS and DAY_COLUMNS[name] not in schema.fieldNames():
            want.append((DAY_COLUMNS[name], T.DateType()))  # links and exports get their day when they are stored
        assert [(f.name, f.dataType) for f in df.schema.fields] == want
        assert df.count() == getattr(derived, name).count(), name
    # clicks are stored one folder per day
    days = sorted(d for d in os.listdir(f"{base}/ad_clicks") if d.startswith("date_date="))
    assert days == ["date_date=2024-01-14", "date_date=2024-01-15"]
    assert stored.clicks_of(P).filter(F.col("date_date") != F.lit(P.run_date)).count() == 0


def test_conform_rejects_missing_columns(spark):
    df = spark.createDataFrame([(1, "x")], "camp_id long, camp_name string")
    with pytest.raises(ValueError, match="missing columns"):
        schemas.conform(df, schemas.CAMPAIGNS, "campaigns")


class Reader:
    """Stands for spark.read: notes the options and returns empty frames."""

    def __init__(self, spark):
        self.spark, self.seen, self.now = spark, {}, {}

    @property
    def read(self):
        self.now = {}
        return self

    def format(self, kind):
        self.now["format"] = kind
        return self

    def option(self, key, value):
        self.now[key] = value
        return self

    def load(self):
        self.seen[self.now["dbtable"]] = self.now
        name = next(k for k in schemas.INPUT_SCHEMAS if f"db.{k}" == self.now["dbtable"])
        return self.spark.createDataFrame([], schemas.INPUT_SCHEMAS[name])


def test_jdbc_reader_passes_its_options(spark):
    from adspend.sources.tables import read_jdbc_inputs
    fake = Reader(spark)
    split = {"column": "record_id", "lowerBound": 0, "upperBound": 100, "numPartitions": 8}
    inputs = read_jdbc_inputs(fake, "jdbc:x://host/db", {k: f"db.{k}" for k in schemas.INPUT_SCHEMAS},
                              {"user": "u", "fetchsize": "1000"}, {"ad_clicks": split})
    assert set(fake.seen) == {f"db.{k}" for k in schemas.INPUT_SCHEMAS}
    for table, options in fake.seen.items():
        assert options["format"] == "jdbc" and options["url"] == "jdbc:x://host/db"
        assert options["user"] == "u" and options["fetchsize"] == "1000"
        assert ({k: options[k] for k in split} if table == "db.ad_clicks" else {}) == (
            {k: str(v) for k, v in split.items()} if table == "db.ad_clicks" else {})
    assert inputs.ad_clicks.count() == 0


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, master, folder=None, conf=None):
        self.sparkContext, self.conf = Context(master, folder), conf or {}


def test_checkpoint_folder_rule():
    """The folder already set; else the configured one; else a scratch folder, but only locally."""
    from adspend.session import ensure_checkpoint_dir
    assert ensure_checkpoint_dir(Session("yarn", "hdfs:/set")) == "hdfs:/set"
    assert ensure_checkpoint_dir(Session("yarn", None, {"spark.checkpoint.dir": "hdfs:/conf"})) == "hdfs:/conf"
    assert os.path.isdir(ensure_checkpoint_dir(Session("local[4]")))
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(Session(master))
