"""A sample of the registered queries against SQL; `oracle_check.py` runs them all."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect
from plumbline.plans.oracle import ORACLE
from plumbline.plans.registered import QUERIES

SF = "/root/testdata/sf0.001"
SAMPLE = (
    "bronze_lines", "csv_to_long", "json_batch", "staging_load", "dq_flags", "classify_in_order",
    "upsert_lineage", "finalize_run", "register_or_resume", "drill_report", "referential_clean",
    "rollback_restore",
)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    con = connect(SF)
    assert compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF) == ""


def test_entry(spark):
    assert entry.entry(spark).first()["MISSING_DATE"] == 32
