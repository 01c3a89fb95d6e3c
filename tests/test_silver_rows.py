"""Silver semantics on hand-written rows (FIXTURES §5)."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import bronze_rows

from clickweave import schema
from clickweave.operators import silver as ops
from clickweave.plans.silver import cleanse, silver


def _ids(df):
    return sorted((r.event_id, r.kafka_offset) for r in df.select("event_id", "kafka_offset").collect())


def test_tie_keeps_lowest_offset(spark):
    df = bronze_rows(spark, [
        {"event_id": "x", "kafka_offset": 2, "ingestion_timestamp": "2024-01-10 10:00:05"},
        {"event_id": "x", "kafka_offset": 1, "ingestion_timestamp": "2024-01-10 10:00:05"},
    ])
    assert _ids(ops.deduplicate(df)) == [("x", 1)]


def test_null_ingestion_copy_wins(spark):
    df = bronze_rows(spark, [
        {"event_id": "x", "kafka_offset": 1, "ingestion_timestamp": "2024-01-10 10:00:05"},
        {"event_id": "x", "kafka_offset": 2, "ingestion_timestamp": None},
    ])
    assert _ids(ops.deduplicate(df)) == [("x", 2)]


def test_earliest_ingestion_wins(spark):
    df = bronze_rows(spark, [
        {"event_id": "x", "kafka_offset": 1, "ingestion_timestamp": "2024-01-10 11:00:00"},
        {"event_id": "x", "kafka_offset": 2, "ingestion_timestamp": "2024-01-10 10:00:00"},
    ])
    assert _ids(ops.deduplicate(df)) == [("x", 2)]


def test_dedup_before_null_drop_loses_good_copy(spark):
    rows = [
        {"event_id": "x", "kafka_offset": 1, "session_id": None,
         "ingestion_timestamp": "2024-01-10 10:00:01"},
        {"event_id": "x", "kafka_offset": 2, "ingestion_timestamp": "2024-01-10 10:00:02"},
        {"event_id": "y", "kafka_offset": 3},
    ]
    df = bronze_rows(spark, rows)
    assert _ids(cleanse(df)) == [("y", 3)]
    assert _ids(cleanse(df, drop_nulls_first=True)) == [("x", 2), ("y", 3)]


def test_null_required_fields_dropped(spark):
    df = bronze_rows(spark, [
        {"event_id": None}, {"session_id": None}, {"event_type": None},
        {"event_timestamp": None, "event_date": dt.date(2024, 1, 10)},
        {"event_date": None}, {},
    ])
    assert ops.drop_incomplete(df).count() == 1


def test_device_category(spark):
    devices = ["mobile", "tablet", "desktop", "smart_tv", "unknown", None]
    df = bronze_rows(spark, [{"device_type": d, "kafka_offset": i} for i, d in enumerate(devices)])
    got = [r.device_category for r in ops.enrich(df).orderBy("kafka_offset").collect()]
    assert got == ["mobile", "tablet", "desktop", "desktop", "desktop", "desktop"]


def test_country_flag_keeps_null(spark):
    df = bronze_rows(spark, [{"country": c, "kafka_offset": i} for i, c in enumerate(["IN", "US", None])])
    got = [r.is_indian_user for r in ops.enrich(df).orderBy("kafka_offset").collect()]
    assert got == [True, False, None]


def test_calendar_columns(spark):
    days = ["2024-01-06 23:59:59", "2024-01-07 00:00:00", "2024-01-08 13:30:00"]
    df = bronze_rows(spark, [{"event_timestamp": d, "kafka_offset": i} for i, d in enumerate(days)])
    got = [(r.is_weekend, r.day_of_week, r.hour_of_day)
           for r in ops.enrich(df).orderBy("kafka_offset").collect()]
    assert got == [(True, "Saturday", 23), (True, "Sunday", 0), (False, "Monday", 13)]


def test_calendar_independent_of_session_time_zone(spark):
    df = bronze_rows(spark, [{"event_timestamp": "2024-01-06 23:30:00"}])
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        r = ops.enrich(df).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert (r.hour_of_day, r.day_of_week, r.event_date) == (23, "Saturday", dt.date(2024, 1, 6))


@pytest.mark.parametrize("options", [{}, {"rows_per_task": 0}, {"cold": "window"}])
def test_duration_floors_each_side(spark, options):
    df = bronze_rows(spark, [
        {"event_timestamp": "2024-01-10 10:00:00.900", "kafka_offset": 1},
        {"event_timestamp": "2024-01-10 10:00:01.100", "kafka_offset": 2},
    ])
    rows = ops.session_metrics(df, "day", **options).collect()
    assert {r.session_duration_secs for r in rows} == {1}
    assert {r.session_event_count for r in rows} == {2}
    assert {r.is_bounce for r in rows} == {False}


@pytest.mark.parametrize("options", [{}, {"rows_per_task": 0}, {"cold": "window"}])
def test_bounce(spark, options):
    df = bronze_rows(spark, [
        {"session_id": "one", "kafka_offset": 1},
        {"session_id": "two", "kafka_offset": 2},
        {"session_id": "two", "kafka_offset": 3, "event_timestamp": "2024-01-10 10:05:00"},
    ])
    got = {(r.session_id, r.is_bounce, r.session_duration_secs)
           for r in ops.session_metrics(df, "day", **options).collect()}
    assert got == {("one", True, 0), ("two", False, 300)}


def test_midnight_session_scope(spark):
    df = bronze_rows(spark, [
        {"event_timestamp": "2024-01-10 23:50:00", "kafka_offset": 1},
        {"event_timestamp": "2024-01-11 00:10:00", "kafka_offset": 2},
    ])
    day = {r.session_event_count for r in ops.session_metrics(df, "day").collect()}
    span = ops.session_metrics(df, "all").collect()
    assert day == {1}
    assert {r.session_event_count for r in span} == {2}
    assert {r.session_duration_secs for r in span} == {1200}


def test_silver_columns_and_types(spark):
    df = bronze_rows(spark, [{}, {"event_id": "b", "kafka_offset": 9}])
    out = silver(df, "2024-01-10", run_ts="2024-02-01 02:00:00")
    assert tuple(out.columns) == schema.SILVER_COLUMNS
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in schema.SILVER.fields]
    assert out.count() == 2
    assert {r.processed_at for r in out.collect()} == {dt.datetime(2024, 2, 1, 2, 0)}


def test_silver_day_only_reads_that_day(spark):
    df = bronze_rows(spark, [
        {"event_timestamp": "2024-01-10 10:00:00"},
        {"event_timestamp": "2024-01-11 10:00:00", "event_id": "other"},
    ])
    out = silver(df, dt.date(2024, 1, 11))
    assert [r.event_id for r in out.collect()] == ["other"]


def test_invalid_day_rejected(spark):
    df = bronze_rows(spark, [{}])
    with pytest.raises(ValueError):
        silver(df, "2024-13-40")


def test_default_run_time_is_utc(spark):
    df = bronze_rows(spark, [{}])
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        r = ops.enrich(df).select("processed_at").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    now_utc = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert abs((r.processed_at - now_utc).total_seconds()) < 300
