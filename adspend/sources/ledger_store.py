"""A ledger stored in buckets of campaigns, so that an update writes only the buckets it touches.

Layout: ``<path>/date_date=D/camp_bucket=B``. Each write goes through Spark's dynamic partition
overwrite: the new files of the buckets concerned are staged, and take the place of the earlier ones
when the job has ended well. Files of other buckets are not read, written or renamed. A folder holds
either this layout or the one of ``plans.allocation.write_ledger``; ``read_ledger`` reads both.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adspend.operators.ledger import keyed_update
from adspend.schemas import LEDGER

BUCKET = "camp_bucket"
STORED = T.StructType([*LEDGER, T.StructField(BUCKET, T.IntegerType())])


def _replace(rows: DataFrame, path: str) -> None:
    """One task for each bucket: a bucket is one file until Spark's own limits split it."""
    (rows.repartition("date_date", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date_date", BUCKET).parquet(path))


def _day(spark: SparkSession, path: str, target_date: _dt.date) -> DataFrame:
    return spark.read.schema(STORED).parquet(path).filter(F.col("date_date") == F.lit(target_date))


def _buckets_in(rows: DataFrame) -> set[int]:
    """The distinct buckets: at most as many numbers as the layout has buckets."""
    return {r[0] for r in rows.select(BUCKET).distinct().collect()}


def store_ledger(rows: DataFrame, path: str, target_date: _dt.date, buckets: int = 256, first: bool = False) -> None:
    """Store ``rows`` as the whole ledger of ``target_date``, dealt by ``camp_id`` over ``buckets``.

    Earlier rows of the date go; buckets that have no new rows are emptied after the write.
    ``first`` says that the folder has nothing yet. Take ``buckets`` so that one holds some 100 MB.
    """
    spark = rows.sparkSession
    earlier = set() if first else _buckets_in(_day(spark, path, target_date))
    placed = rows.select(*LEDGER.fieldNames()).withColumn("date_date", F.lit(target_date)).withColumn(
        BUCKET, F.pmod(F.xxhash64("camp_id"), F.lit(buckets)).cast("int"))
    _replace(placed, path)
    if earlier:
        nothing = spark.createDataFrame([], LEDGER).drop("date_date").coalesce(1)
        files = placed.select(BUCKET).distinct()
        for bucket in sorted(earlier - _buckets_in(files)):
            nothing.write.mode("overwrite").parquet(f"{path.rstrip('/')}/date_date={target_date.isoformat()}/{BUCKET}={bucket}")


def update_stored(spark: SparkSession, path: str, target_date: _dt.date, keys: DataFrame, on: list[str], **changes) -> int:
    """``UPDATE ... WHERE (on) IN keys`` on the stored rows of one date; the number of buckets written.

    First the key columns of the date are read and matched with ``keys``, which gives the buckets that
    hold a key. Only these are read whole and written again. Without a match nothing is written. Null
    keys match nothing; a key that occurs several times changes its rows once. A failure in either
    job leaves the stored rows as they were.
    """
    stored = _day(spark, path, target_date)
    touched = sorted(_buckets_in(stored.select(*on, BUCKET).join(keys.select(*on), on, "left_semi")))
    if touched:
        _replace(keyed_update(stored.filter(F.col(BUCKET).isin(touched)), keys, on, **changes), path)
    return len(touched)
