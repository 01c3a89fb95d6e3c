"""Every registered query vs. its DuckDB twin at sf0.01 (the driver's gate),
plus the fixture figures stated in FIXTURES.md."""

from __future__ import annotations

import pytest
from conftest import SF01
from oracle_check import compare, duck
from pyspark.sql import functions as F

import __spark_entry__ as entry
from clickweave.plans import catalog


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    sql = entry.oracle_sql().get(name)
    assert sql is not None, "every registered query has an oracle"
    res = compare(spark, con, name, entry.queries()[name], sql, SF01)
    assert res["status"] == "match", res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 36


def test_fixture_figures(spark):
    b = catalog.bronze_all(spark, SF01)
    assert b.count() == 10500 and len(b.columns) == 27
    assert catalog.silver_dedup(spark, SF01).count() == 10000
    assert catalog.silver_not_null(spark, SF01).count() == 9786
    assert catalog.silver_keep_good_copy(spark, SF01).count() - 9786 == 4
    span = catalog.silver_sessions_span(spark, SF01)
    assert span.select("session_id").distinct().count() == 5994
    assert span.where("is_bounce").count() == 3355
    assert catalog.silver_sessions(spark, SF01).where("is_bounce").count() == 4161
    midnight = (span.groupBy("session_id")
                .agg(F.countDistinct("event_date").alias("days")).where("days > 1").count())
    assert midnight == 533
    rules = {r.rule: r.violations for r in catalog.dq_conditional_fields(spark, SF01).collect()}
    assert (rules["order_value_off_checkout"], rules["scroll_depth_off_scroll"],
            rules["scroll_depth_out_of_range"], rules["browser_on_native_app"]) == (43, 46, 48, 14)
    enums = {r.field: (r.null_rows, r.invalid_rows)
             for r in catalog.dq_enum_domains(spark, SF01).collect()}
    assert enums["event_type"] == (119, 46) and enums["device_type"] == (0, 46)
    audit = {r.stage: r for r in catalog.silver_audit(spark, SF01)
             .groupBy("stage").agg(F.sum("rows_out").alias("rows_out")).collect()}
    assert (audit["read"].rows_out, audit["dedup"].rows_out, audit["null_drop"].rows_out) == (
        10500, 10000, 9786)
