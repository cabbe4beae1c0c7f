from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import plain  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def hard(spark):
    """Nulls, empty and long texts, repeated rows and ids, clashing columns."""
    return plain.hard_documents(spark)


@pytest.fixture(scope="session")
def empty(spark):
    return plain.hard_documents(spark, rows=[])


@pytest.fixture(scope="session")
def small_rows(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    return [(r.doc_id, r.text) for r in rows]
