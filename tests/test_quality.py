"""Contract checks (Q1-Q10) and profiles (A1-A3, T1-T2) on hand-written rows."""

from __future__ import annotations

from conftest import bronze_rows

from clickweave import schema
from clickweave.operators import profile, quality


def _by(df, key):
    return {r[key]: r for r in df.collect()}


def test_enum_domains_separate_null_and_invalid(spark):
    df = bronze_rows(spark, [
        {"event_type": "click"}, {"event_type": None}, {"event_type": "hover"},
        {"device_type": "fridge"}, {"source": "carrier_pigeon"},
    ])
    got = _by(quality.enum_domains(df), "field")
    assert (got["event_type"].null_rows, got["event_type"].invalid_rows) == (1, 1)
    assert (got["device_type"].null_rows, got["device_type"].invalid_rows) == (0, 1)
    assert got["source"].invalid_rows == 1
    assert got["event_type"].domain_size == 13 and got["event_type"].total_rows == 5


def test_conditional_rules(spark):
    df = bronze_rows(spark, [
        {"event_type": "search", "search_query": "q"},           # fine
        {"event_type": "click", "search_query": "q"},            # search off search
        {"event_type": None, "order_value": 3.0},                # order off checkout (null type)
        {"event_type": "checkout_complete", "order_value": 3.0},  # fine
        {"event_type": "scroll", "scroll_depth_pct": 100},       # fine, boundary
        {"event_type": "scroll", "scroll_depth_pct": 101},       # out of range
        {"event_type": "click", "scroll_depth_pct": 0},          # off scroll
        {"source": "ios", "browser": "Chrome"},                  # browser on native app
        {"source": "android", "browser": None},                  # fine
    ])
    got = {r.rule: r.violations for r in quality.conditional_fields(df).collect()}
    assert got == {"search_query_off_search": 1, "scroll_depth_off_scroll": 1,
                   "scroll_depth_out_of_range": 1, "order_value_off_checkout": 1,
                   "browser_on_native_app": 1}


def test_required_fields(spark):
    df = bronze_rows(spark, [{"anonymous_id": None}, {"country": None, "os": None}, {}])
    got = {r.field: r.null_rows for r in quality.required_fields(df).collect()}
    assert set(got) == set(schema.REQUIRED_FIELDS)
    assert (got["anonymous_id"], got["country"], got["os"], got["event_id"]) == (1, 1, 1, 0)


def test_event_mix_shares(spark):
    rows = [{"event_type": "page_view"}] * 3 + [{"event_type": "click"}] + [{"event_type": "hover"}]
    got = _by(quality.event_mix(bronze_rows(spark, rows)), "event_type")
    assert len(got) == 13
    assert (got["page_view"].event_count, got["page_view"].actual_share) == (3, 0.75)
    assert got["page_view"].expected_share == round(35 / 101, 6)
    assert got["error"].actual_share == 0.0
    assert got["click"].share_delta == round(0.25 - 25 / 101, 6)


def test_ingestion_lag(spark):
    df = bronze_rows(spark, [
        {"event_timestamp": "2024-01-10 10:00:00", "ingestion_timestamp": "2024-01-10 10:00:01.500"},
        {"event_timestamp": "2024-01-10 10:00:00", "ingestion_timestamp": "2024-01-10 10:00:03.001"},
        {"event_timestamp": "2024-01-10 10:00:00", "ingestion_timestamp": "2024-01-10 09:59:59"},
        {"event_timestamp": "2024-01-10 10:00:00", "ingestion_timestamp": None},
    ])
    r = quality.ingestion_lag(df).first()
    assert (r.events, r.lag_missing, r.min_lag_ms, r.max_lag_ms, r.lag_out_of_range) == (
        4, 1, -1000, 3001, 2)


def test_auth_share(spark):
    df = bronze_rows(spark, [{"user_id": "u"}, {"user_id": None}, {"user_id": "v"}, {"user_id": "w"}])
    r = quality.auth_share(df).first()
    assert (r.events, r.authenticated, r.auth_share, r.share_delta) == (4, 3, 0.75, 0.05)


def test_profiles(spark):
    df = bronze_rows(spark, [{"city": c, "event_type": t} for c, t in
                             [("A", "click"), ("A", "click"), ("B", "scroll"), ("C", None)]])
    assert profile.total(df).first().total_events == 4
    types = [(r.event_type, r.event_count) for r in profile.counts_by(df, "event_type").collect()]
    assert types == [("click", 2), ("scroll", 1), (None, 1)]
    top = [(r.city, r.event_count) for r in profile.top_values(df, "city", 2).collect()]
    assert top == [("A", 2), ("B", 1)]
