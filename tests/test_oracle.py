"""Spark queries against their DuckDB oracle (set ADSPEND_FULL_ORACLE=1 for all of them)."""

from __future__ import annotations

import os

import pytest

from support import SF_MID, SF_SMALL
from oracle_compare import compare, duck_connection

import __spark_entry__ as contract
from adspend.plans.catalog import REGISTRY

CORE = ["eligible_advertisers", "eligible_campaigns", "stage_00", "stage_04", "stage_07", "stage_08",
        "stage_09", "anti_join_existing_keys", "stage_12", "stage_15", "stage_10", "stage_11",
        "stage_601", "allocation", "keyed_update", "join_total_vs_feed", "fn_floor_clicks",
        "union_inclusions", "filter_account_bands", "agg_by_alias", "scan_ledger", "stage_row_counts",
        "allocation_stored", "stage_row_counts_stored", "stage_10_stored", "stage_11_stored", "union_exclusions_stored",
        "anti_join_exported_null", "target_clicks_revenue", "target_clicks_topup", "filter_kept_spend"]
NAMES = sorted(REGISTRY) if os.environ.get("ADSPEND_FULL_ORACLE") else CORE


def test_every_query_has_oracle_sql():
    assert set(REGISTRY) == set(REGISTRY) & set(contract.queries()) & set(contract.oracle_sql())


@pytest.fixture(scope="module")
def duck_mid():
    return duck_connection(SF_MID)


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, duck_mid, name):
    result = compare(spark, duck_mid, name, SF_MID)
    assert result["status"] == "match", result


def test_entry_smoke(spark):
    df = contract.entry(spark)
    assert df.columns == ["date_date", "publisher_id", "publisher_cpc", "camp_id", "target_spend",
                          "step_num", "job_export_feed_id", "active_flag"]
    assert df.count() > 0


def test_small_scale_matches_oracle(spark):
    con = duck_connection(SF_SMALL)
    assert compare(spark, con, "allocation", SF_SMALL)["status"] == "match"
