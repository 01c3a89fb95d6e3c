"""Table creation and the idempotent daily rewrite."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from conftest import SF001, bronze_rows
from pyspark.sql import functions as F

from clickweave import schema
from clickweave.operators import audit
from clickweave.plans.silver import run_silver
from clickweave.sinks import tables as sinks
from clickweave.plans import fixture


def _name(prefix):
    return f"{prefix}_{uuid.uuid4().hex[:8]}"


def test_create_tables_from_schema(spark):
    b, s = _name("raw"), _name("silver")
    sinks.create_bronze_table(spark, b)
    sinks.create_silver_table(spark, s)
    assert tuple(spark.table(b).columns[:-2]) == tuple(c for c in schema.BRONZE_COLUMNS
                                                        if c != "event_date")
    assert spark.table(b).columns[-2:] == ["event_date", "load_id"]  # partition columns last
    assert set(spark.table(s).columns) == set(schema.SILVER_COLUMNS)
    sinks.create_silver_table(spark, s)  # IF NOT EXISTS


def test_daily_rewrite_is_idempotent(spark):
    bronze_t, silver_t = _name("raw"), _name("silver")
    sinks.create_bronze_table(spark, bronze_t)
    sinks.append(fixture.bronze_view(spark, SF001), bronze_t)
    day = dt.date(2024, 1, 15)
    report = run_silver(spark, bronze_t, silver_t, day, run_ts="2024-02-01 02:00:00")
    first = spark.table(silver_t).where(F.col("event_date") == day)
    n = first.count()
    assert n > 0
    assert [r["stage"] for r in report] == ["read", "dedup", "null_drop", "write"]
    assert report[-1]["rows_out"] == n
    snapshot = first.collect()
    run_silver(spark, bronze_t, silver_t, day, run_ts="2024-02-01 02:00:00")
    again = spark.table(silver_t).where(F.col("event_date") == day)
    assert again.count() == n
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, snapshot))
    other = dt.date(2024, 1, 16)
    run_silver(spark, bronze_t, silver_t, other, run_ts="2024-02-01 02:00:00")
    m = spark.table(silver_t).where(F.col("event_date") == other).count()
    assert m > 0
    # rerun of a day whose input is now empty: that day empties, others stay
    empty = spark.table(bronze_t).where(F.lit(False))
    run_silver(spark, empty, silver_t, day)
    assert spark.table(silver_t).where(F.col("event_date") == day).count() == 0
    assert spark.table(silver_t).where(F.col("event_date") == other).count() == m


def test_observed_counts_match_audit_query(spark):
    silver_t = _name("silver")
    view = fixture.bronze_view(spark, SF001)
    report = run_silver(spark, view, silver_t, None, run_ts="2024-02-01 02:00:00")
    by_stage = {r["stage"]: r for r in report}
    q = audit.stage_counts(view.where(F.col("event_date").isNotNull()))
    totals = {r["stage"]: (r["rows_in"], r["rows_out"])
              for r in q.groupBy("stage").agg(F.sum("rows_in").alias("rows_in"),
                                               F.sum("rows_out").alias("rows_out")).collect()}
    for stage in ("dedup", "null_drop"):
        assert (by_stage[stage]["rows_in"], by_stage[stage]["rows_out"]) == totals[stage]
    assert by_stage["read"]["rows_out"] == totals["read"][1] == 1050
    assert spark.table(silver_t).count() == by_stage["write"]["rows_out"]


def test_audit_on_hand_rows(spark):
    df = bronze_rows(spark, [
        {"event_id": "x", "kafka_offset": 1, "session_id": None,
         "ingestion_timestamp": "2024-01-10 10:00:01"},
        {"event_id": "x", "kafka_offset": 2, "ingestion_timestamp": "2024-01-10 10:00:02"},
        {"event_id": "y", "kafka_offset": 3},
    ])
    rows = {r.stage: (r.rows_in, r.rows_out, r.rows_removed)
            for r in audit.stage_counts(df).collect()}
    assert rows == {"read": (3, 3, 0), "dedup": (3, 2, 1), "null_drop": (2, 1, 1),
                    "write": (1, 1, 0)}


def test_write_kafka_needs_connector(spark):
    df = bronze_rows(spark, [{}])
    from clickweave.functions import envelope

    with pytest.raises(Exception):
        sinks.write_kafka(envelope.encode(df), "t", "localhost:1")


def test_batch_raw_load_and_path_read(spark, scratch):
    import os

    from clickweave.operators import bronze
    from clickweave.plans.bronze import load_bronze
    from clickweave.sources.tables import read_bronze

    t = _name("raw_batch")
    records = fixture.envelope_view(spark, SF001)
    load_bronze(records, t)
    expected = bronze.transform(records)
    got = spark.table(t).select(*expected.columns)
    assert got.count() == expected.count() > 0
    assert got.exceptAll(expected).count() == 0
    # the same rows through a path (S6) and a one-day read
    path = os.path.join(scratch, "raw")
    expected.write.partitionBy("event_date").parquet(path)
    assert read_bronze(spark, path).count() == expected.count()
    day = read_bronze(spark, path, "2024-01-15")
    assert day.count() == expected.where(F.col("event_date") == dt.date(2024, 1, 15)).count() > 0


def test_provider_detection(spark):
    t = _name("silver_p")
    sinks.create_silver_table(spark, t)
    assert sinks.provider(spark, t) == "parquet"
    assert sinks.provider(spark, t) in sinks.FILE_PROVIDERS


def _day_table(spark):
    t = _name("silver")
    run_silver(spark, fixture.bronze_view(spark, SF001), t, None, run_ts="2024-02-01 02:00:00")
    return t, spark.table(t)


def _days(spark, t):
    return {str(r[0]): r[1] for r in spark.table(t).groupBy("event_date").count().collect()}


@pytest.mark.parametrize("day", ["2024-01-15", None])
def test_a_failed_rewrite_loses_nothing(spark, day):
    t, rows = _day_table(spark)
    before = _days(spark, t)
    broken = rows.withColumn("city", F.when(F.col("event_date") >= "2024-01-15", F.raise_error(F.lit("boom"))).otherwise(F.col("city")))
    with pytest.raises(Exception, match="boom"):
        sinks.overwrite_day(broken, t, day)
    assert before["2024-01-15"] > 0 and _days(spark, t) == before


def test_a_day_that_turns_empty_is_gone(spark):
    t, rows = _day_table(spark)
    before = _days(spark, t)
    keep = rows.where("event_date <> DATE'2024-01-15'")
    sinks.overwrite_day(keep, t, "2024-01-15")
    assert _days(spark, t) == {d: n for d, n in before.items() if d != "2024-01-15"}
    sinks.overwrite_day(rows.where("event_date > DATE'2024-01-17'"), t, None)  # all days: the result and nothing else
    assert _days(spark, t) == {d: n for d, n in before.items() if d > "2024-01-17"}
    sinks.overwrite_day(rows.limit(0), t, None)
    assert _days(spark, t) == {}


def test_a_reader_of_the_old_day_finishes(spark):
    t, rows = _day_table(spark)
    n = rows.where("event_date = DATE'2024-01-15'").count()
    old = spark.table(t).where("event_date = DATE'2024-01-15'")
    files = old.inputFiles()  # planned before the rewrite
    sinks.overwrite_day(spark.table(t).where("event_date = DATE'2024-01-15'").limit(1), t, "2024-01-15")
    assert spark.read.parquet(*files).count() == n  # its files are still there
    assert spark.table(t).where("event_date = DATE'2024-01-15'").count() == 1
    assert sinks.remove_unreferenced(spark, t) == []  # the first run still holds the other days
    sinks.overwrite_day(spark.table(t), t, None)
    assert len(sinks.remove_unreferenced(spark, t)) == 2
    assert spark.table(t).where("event_date = DATE'2024-01-15'").count() == 1
