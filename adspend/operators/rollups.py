"""Click rollups as mergeable state: one small table for each load of clicks and links.

Every figure of ``facts.click_facts`` is a sum over clicks, or over pairs of a click and a link. A load
(say, one hour of arrivals) adds to these sums what its own rows bring: its clicks with all links
known so far, and earlier clicks with the links that came now. A run then adds up a day's loads, one
row per campaign and load, and reads no click. Late clicks and late links go to the day of the click,
whatever the load in which they arrive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adspend.operators.facts import CLICK_SUMS, click_sums, feed_counts

LOAD = "load"
ROLLUP = T.StructType([T.StructField("date_date", T.DateType()), T.StructField("camp_id", T.LongType()),
                       *[T.StructField(c, T.LongType()) for c in CLICK_SUMS], T.StructField(LOAD, T.StringType())])
_CLICK = ["record_id", "date_date", "camp_id", "partner_source", "reason_code", "click_cost"]


def load_sums(clicks: DataFrame, links: DataFrame, batches: DataFrame,
              earlier_clicks: DataFrame, earlier_links: DataFrame) -> DataFrame:
    """What a load of ``clicks`` and ``links`` adds: one row per day and campaign (``ROLLUP`` but the load).

    ``earlier_clicks`` and ``earlier_links`` are those of the loads before that may belong together
    with rows of this one, as a rule those of the last days. ``batches`` are the export batches; a
    link counts if its batch is known when the later one of click and link arrives. A repeated
    record id or link counts as often as it occurs. Clicks without an id have no links.
    """
    link = ["click_id", "batch_id"]
    known = links.select(*link).unionByName(earlier_links.select(*link))
    new = (clicks.select(*_CLICK).join(feed_counts(known, batches), F.col("record_id") == F.col("click_id"), "left")
           .withColumn("is_new", F.lit(1)))
    late = (earlier_clicks.select(*_CLICK).join(feed_counts(links, batches), F.col("record_id") == F.col("click_id"))
            .withColumn("is_new", F.lit(0)))
    return click_sums(new.unionByName(late), ["date_date", "camp_id"], F.col("is_new"))


def merge(loads: DataFrame) -> DataFrame:
    """The sums of several loads by day and campaign; partial sums combine map-side."""
    return loads.groupBy("date_date", "camp_id").agg(*[F.sum(c).alias(c) for c in CLICK_SUMS])


def store_load(sums: DataFrame, load: str, path: str) -> None:
    """Store the result of ``load_sums``. A load that is stored again takes the place of its earlier
    rows on the days it has rows for; other loads stay, and a job that fails changes nothing."""
    (sums.withColumn(LOAD, F.lit(load)).select(*ROLLUP.fieldNames()).repartition("date_date", "camp_id")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date_date", LOAD).parquet(path))


def read_rollups(spark: SparkSession, path: str) -> DataFrame:
    """The stored loads, for ``AdInputs.click_rollups``; a filter on ``date_date`` prunes the folders."""
    return spark.read.schema(ROLLUP).parquet(path)
