"""Helpers shared by the operators."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adspend.session import ensure_checkpoint_dir

# White space of all operators: space and \t \n \v \f \r. bytes.split() uses the same set.
WORD_SEP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of the session."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    Cuts the lineage: a lost executor costs no more than the tasks that ran on it.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query go when it ends. For frames that are run once: another
    run of one of them shuffles again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def per_worker(key, make):
    """``make()`` for the first task of a Python worker process; later tasks of the process that
    ask for the same key get the same object. For word caches and vocabularies: what is kept
    saves time and decides nothing."""
    home = sys.modules.setdefault("adspend_llm_worker", types.ModuleType("adspend_llm_worker"))
    kept = home.__dict__.setdefault("kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def id_remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "UTF-8")) % modulus


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
