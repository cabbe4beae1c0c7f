"""Input tables of a run and the readers for stored inputs (Parquet, JDBC)."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, fields

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adspend.params import AllocParams
from adspend.schemas import INPUT_SCHEMAS, LEDGER, conform


@dataclass(frozen=True)
class AdInputs:
    """The eight relations one allocation run reads. With ``click_rollups`` (``operators.rollups``) the
    run adds up the day's loads of these and reads neither clicks nor links."""

    advertiser_vertical: DataFrame
    campaigns: DataFrame
    users: DataFrame
    ad_clicks: DataFrame
    click_batches: DataFrame
    export_batches: DataFrame
    export_campaign_stats: DataFrame
    client_policy: DataFrame
    click_rollups: DataFrame | None = None

    def clicks_of(self, params: AllocParams) -> DataFrame:
        """Click rows of the run date. On a date-partitioned table this prunes partitions."""
        return self.ad_clicks.filter(F.col("date_date") == F.lit(params.run_date))


# Stored layout: clicks, their links and the exported campaigns are partitioned by day, so a
# run reads its own day of each and not the history, whatever their ids are. Links and exports
# have no day of their own: they get that of their click and of their batch when they are stored.
DAY_COLUMNS = {"ad_clicks": "date_date", "click_batches": "click_date", "export_campaign_stats": "batch_date"}


def links_by_day(links: DataFrame, clicks: DataFrame) -> DataFrame:
    """``links`` with the ``click_date`` of their click: once for each day that has the id, with a
    null day if no click has it (such a link joins nothing)."""
    days = clicks.select(F.col("record_id").alias("click_id"), F.col("date_date").alias("click_date")).distinct()
    return links.select("click_id", "batch_id").join(days, "click_id", "left")


def exports_by_day(stats: DataFrame, batches: DataFrame) -> DataFrame:
    """``stats`` with the ``batch_date`` of their export batch, null if there is no such batch."""
    days = batches.select(F.col("id").alias("batch_id"), F.to_date("date").alias("batch_date")).distinct()
    return stats.select("camp_id", "batch_id").join(days, "batch_id", "left")


def _write_days(frame: DataFrame, path: str, day: str, key: str, mode: str) -> None:
    """Ranges of (day, key): a large day is spread over many files, a small one lies in one."""
    (frame.repartitionByRange(day, key).sortWithinPartitions(day, key)
     .write.mode(mode).partitionBy(day).parquet(path))


def write_parquet_inputs(inputs: AdInputs, base: str) -> None:
    """Store the inputs as ``<base>/<relation>`` Parquet datasets, those of ``DAY_COLUMNS`` by day."""
    for f in fields(inputs):
        frame = getattr(inputs, f.name)
        if frame is None or f.name == "click_rollups":
            continue  # rollups are stored load by load
        if f.name == "click_batches":
            _write_days(links_by_day(frame, inputs.ad_clicks), f"{base}/{f.name}", "click_date", "click_id", "overwrite")
        elif f.name == "export_campaign_stats":
            _write_days(exports_by_day(frame, inputs.export_batches), f"{base}/{f.name}", "batch_date", "batch_id", "overwrite")
        elif f.name in DAY_COLUMNS:
            frame.write.mode("overwrite").partitionBy(DAY_COLUMNS[f.name]).parquet(f"{base}/{f.name}")
        else:
            frame.write.mode("overwrite").parquet(f"{base}/{f.name}")


def add_links(links: DataFrame, clicks: DataFrame, base: str) -> None:
    """Append links that have arrived to the stored ones. ``clicks`` are those that they can belong
    to, as a rule the clicks of the last days."""
    _write_days(links_by_day(links, clicks), f"{base}/click_batches", "click_date", "click_id", "append")


def add_exports(stats: DataFrame, batches: DataFrame, base: str) -> None:
    """Append exported campaigns to the stored ones; ``batches`` are their export batches."""
    _write_days(exports_by_day(stats, batches), f"{base}/export_campaign_stats", "batch_date", "batch_id", "append")


def read_ledger(spark: SparkSession, path: str, target_date: _dt.date) -> DataFrame:
    """Stored ledger rows of one target date (schema ``LEDGER``); only its folder is read."""
    stored = spark.read.schema(LEDGER).parquet(path).filter(F.col("date_date") == F.lit(target_date))
    return stored.select(*LEDGER.fieldNames())


# Keys that the joins take for unique.
PRIMARY_KEYS = {"campaigns": "camp_id", "users": "id", "export_batches": "id"}


def duplicate_keys(inputs: AdInputs) -> dict[str, int]:
    """Number of repeated key values by relation, for relations that have any.

    One aggregation per relation, and one number each to the driver.
    """
    found = {}
    for name, key in PRIMARY_KEYS.items():
        repeated = getattr(inputs, name).groupBy(key).count().filter(F.col("count") > 1)
        if n := repeated.count():
            found[name] = n
    return found


def check_inputs(inputs: AdInputs) -> None:
    """Raise if a key repeats (every ledger row of it would be multiplied) or a policy row is
    one that no rule reads. ``run_daily`` asks for it before anything else."""
    from adspend.operators.facts import unknown_policy_rows

    problems = [f"{n} repeated keys in {name}" for name, n in duplicate_keys(inputs).items()]
    if n := unknown_policy_rows(inputs).agg(F.sum("count")).first()[0]:
        problems.append(f"{n} unknown rows in client_policy")
    if problems:
        raise ValueError("; ".join(problems))


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored dataset; one that is partitioned by day and has no rows has no files either."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return spark.createDataFrame([], schema)


def read_parquet_inputs(spark: SparkSession, base: str) -> AdInputs:
    """Read ``<base>/<relation>`` Parquet datasets and check them against the schemas."""
    frames = {}
    for name, schema in INPUT_SCHEMAS.items():
        stored, day = _stored(spark, f"{base}/{name}", schema), DAY_COLUMNS.get(name)
        if day in stored.columns and day not in schema.fieldNames():
            schema = T.StructType([*schema, T.StructField(day, T.DateType())])
        frames[name] = conform(stored, schema, name)
    return AdInputs(**frames)


def read_jdbc_inputs(spark: SparkSession, url: str, tables: dict[str, str],
                     properties: dict[str, str] | None = None,
                     partitioning: dict[str, dict] | None = None) -> AdInputs:
    """Read the inputs over JDBC.

    ``tables`` maps relation name to the database table; ``partitioning`` may give
    ``column / lowerBound / upperBound / numPartitions`` per relation so that large
    tables (clicks, batches) are read by parallel range queries instead of one cursor.
    """
    frames = {}
    for name, schema in INPUT_SCHEMAS.items():
        reader = spark.read.format("jdbc").option("url", url).option("dbtable", tables[name])
        for k, v in (properties or {}).items():
            reader = reader.option(k, v)
        for k, v in (partitioning or {}).get(name, {}).items():
            reader = reader.option(k, str(v))
        frames[name] = conform(reader.load(), schema, name)
    return AdInputs(**frames)
