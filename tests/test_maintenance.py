"""Stale days, sessions over midnight, rejects, the quality gate, null days and
decoding by schema id."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from conftest import SF001, bronze_rows
from pyspark.sql import functions as F

from clickweave import schema
from clickweave.functions import envelope
from clickweave.operators import maintenance, quality, silver as ops
from clickweave.plans import catalog, fixture
from clickweave.plans.bronze import load_bronze_split
from clickweave.plans.maintenance import merge_crossing_sessions, refresh_silver
from clickweave.plans.silver import cleanse, run_silver, silver
from clickweave.sinks import tables as sinks


def _name(prefix):
    return f"{prefix}_{uuid.uuid4().hex[:8]}"


def _locations(spark, table):
    out = {}
    for (spec,) in spark.sql(f"SHOW PARTITIONS {table}").collect():
        day = spec.split("=", 1)[1]
        out[day] = next(r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION (event_date = '{day}')").collect()
                        if r[0] == "Location")
    return out


def _rows(df):
    return sorted(map(str, df.select(*[c for c in schema.SILVER_COLUMNS if c != "processed_at"]).collect()))


def test_only_stale_days_are_rebuilt(spark):
    raw, clean, ledger = _name("raw"), _name("silver"), _name("ledger")
    sinks.create_bronze_table(spark, raw)
    view = fixture.bronze_view(spark, SF001)
    late = F.col("kafka_offset") >= fixture.REPLAY_OFFSET
    sinks.append(view.where(~late), raw, "first")
    every = [r[0] for r in view.select("event_date").distinct().orderBy("event_date").collect()]
    assert refresh_silver(spark, raw, clean, ledger) == every
    assert refresh_silver(spark, raw, clean, ledger) == []
    before = _locations(spark, clean)

    hit = [dt.date(2024, 1, 5), dt.date(2024, 1, 20)]
    sinks.append(view.where(late & F.col("event_date").isin(hit)), raw, "late")
    assert refresh_silver(spark, raw, clean, ledger) == hit
    after = _locations(spark, clean)
    assert {d for d in after if after[d] != before[d]} == {str(d) for d in hit}
    # as if all had been there from the start
    assert _rows(spark.table(clean)) == _rows(silver(spark.table(raw).drop("load_id"), None))

    # a load replaced by one of as many rows, and one whose rows are gone
    sinks.append(view.where(late & F.col("event_date").isin(hit)), raw, "late")
    assert refresh_silver(spark, raw, clean, ledger) == hit
    sinks.append(view.where(late & (F.col("event_date") == hit[0])), raw, "late")
    assert refresh_silver(spark, raw, clean, ledger) == hit
    assert refresh_silver(spark, raw, clean, ledger) == []


def test_a_failed_rebuild_leaves_its_days_stale(spark, monkeypatch):
    raw, clean, ledger = _name("raw"), _name("silver"), _name("ledger")
    sinks.create_bronze_table(spark, raw)
    sinks.append(fixture.bronze_view(spark, SF001).where("event_date < '2024-01-03'"), raw, "a")

    def refuse(rows):
        raise ValueError("not today")

    with pytest.raises(ValueError, match="not today"):
        refresh_silver(spark, raw, clean, ledger, check=refuse)
    assert spark.table(clean).count() == 0 and spark.table(ledger).count() == 0
    assert len(refresh_silver(spark, raw, clean, ledger)) == 2


def test_stale_days_names_new_changed_and_gone_loads(spark):
    d = dt.date(2024, 1, 1)
    row = lambda load, n, v, day=d: (load, n, v, day)
    now = spark.createDataFrame([row("a", 1, 0), row("b", 2, 0), row("x", 5, 7, dt.date(2024, 1, 2))], maintenance.LEDGER)
    then = spark.createDataFrame([row("b", 3, 0), row("c", 4, 0), row("x", 5, 7, dt.date(2024, 1, 2))], maintenance.LEDGER)
    got, = maintenance.stale_days(now, then).collect()
    assert (got.event_date, got.new_loads, got.gone_loads, got.changed_loads, got.rows_now, got.rows_then) == (d, 1, 1, 1, 3, 7)
    assert maintenance.stale_days(now, now).count() == 0


def test_sessions_over_midnight_are_merged_day_by_day(spark):
    clean, states = _name("silver"), _name("states")
    view = fixture.bronze_view(spark, SF001).where("event_date < '2024-01-06'")
    days = [dt.date(2024, 1, d) for d in range(1, 6)]
    span = ops.session_metrics(cleanse(view.where("event_date IS NOT NULL")), "all")
    for day in days:
        run_silver(spark, view, clean, day, run_ts=catalog.RUN_TS)
        before = _locations(spark, clean)
        report = merge_crossing_sessions(spark, clean, states, day)
        after = _locations(spark, clean)
        assert {d for d in after if after[d] != before[d]} == {str(d) for d in report["days"]}
        assert len(report["days"]) <= 2  # 12-hour sessions
        both = spark.table(clean).where(F.col("event_date").isin(report["days"])).groupBy("session_id").agg(
            F.countDistinct("event_date").alias("d"), F.count("*").alias("n"), F.max("session_event_count").alias("c"))
        crossed = both.where("d > 1").agg(F.sum("n")).first()[0] or 0
        assert report["rows_updated"] == crossed  # of the two days, and no others
    names = ("event_id", "event_date", *schema.SESSION_COLUMNS)
    assert sorted(map(str, spark.table(clean).select(*names).collect())) == sorted(map(str, span.select(*names).collect()))
    # a day built again without its rows gives its neighbours their own metrics back
    empty = view.where(F.col("event_date") != F.lit(days[2]))
    run_silver(spark, empty, clean, days[2], run_ts=catalog.RUN_TS)
    merge_crossing_sessions(spark, clean, states, days[2])
    want = ops.session_metrics(cleanse(empty.where("event_date IS NOT NULL")), "all")
    assert sorted(map(str, spark.table(clean).select(*names).collect())) == sorted(map(str, want.select(*names).collect()))


def test_rejects_and_rows_add_up(spark):
    raw, bad = _name("raw"), _name("rejects")
    records = fixture.envelope_view(spark, SF001)
    counts = load_bronze_split(records, raw, bad, "l1", floor=catalog.LATE_FLOOR)
    assert counts["records"] == records.count() == counts["rows"] + counts["rejected"]
    again = load_bronze_split(records, raw, bad, "l1", floor=catalog.LATE_FLOOR)  # a retry replaces the load
    assert again == counts and spark.table(raw).count() == counts["rows"] and spark.table(bad).count() == counts["rejected"]
    assert {r[0] for r in spark.table(bad).select("reason").distinct().collect()} == {"not_decoded", "before_floor"}
    # what was set aside can be loaded later, from its raw form
    replay = spark.table(bad).where("reason = 'before_floor'").select(
        "key", "value", F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset"))
    more = load_bronze_split(replay, raw, bad, "l2")
    assert more["rejected"] == 0 and more["rows"] > 0


def test_quality_gate_keeps_a_bad_day_invisible(spark):
    clean, day = _name("silver"), "2024-01-10"
    good = bronze_rows(spark, [{"event_id": f"e{i}", "session_id": f"s{i}"} for i in range(10)])
    check = quality.gate({"event_type_outside_domain": 0.25}, default=0.0)
    run_silver(spark, good, clean, day, check=check)
    first = _locations(spark, clean)
    bad = good.withColumn("event_type", F.when(F.col("event_id").isin("e1", "e2", "e3"), "hover").otherwise(F.col("event_type")))
    with pytest.raises(quality.QualityGateError) as error:
        run_silver(spark, bad, clean, day, check=check)
    assert error.value.broken == [(dt.date(2024, 1, 10), "event_type_outside_domain", 3, 10)]
    assert _locations(spark, clean) == first and spark.table(clean).where("event_type = 'hover'").count() == 0
    run_silver(spark, bad, clean, day, check=quality.gate({"event_type_outside_domain": 0.3}))
    assert spark.table(clean).where("event_type = 'hover'").count() == 3
    with pytest.raises(ValueError, match="unknown rules"):
        quality.gate({"nonsense": 0.1})


def test_violations_list_their_rules(spark):
    df = bronze_rows(spark, [{"event_id": "a", "event_type": "hover", "search_query": "q"}, {"event_id": "b"}])
    row, = quality.row_violations(df).collect()
    names = [n for n, _ in quality.row_rules()]
    assert row.rules == "event_type_outside_domain,search_query_off_search" and row.n_violations == 2
    assert row.violations == sum(1 << names.index(n) for n in row.rules.split(","))


def test_rows_without_a_day_are_refused_before_the_switch(spark):
    raw = _name("raw")
    sinks.create_bronze_table(spark, raw)
    rows = bronze_rows(spark, [{"event_id": "a"}, {"event_id": "b", "event_date": None}])
    with pytest.raises(sinks.NullDayError):
        sinks.append(rows, raw, "l")
    assert spark.table(raw).count() == 0 and sinks.remove_unreferenced(spark, raw) == []
    sinks.append(rows.where("event_date IS NOT NULL"), raw, "l")
    assert spark.table(raw).count() == 1


def test_layouts_merge_by_name():
    layouts = fixture.event_layouts()
    both = envelope.merge_layouts([layouts[1], layouts[2]])
    assert both["properties"].dataType["scroll_depth_pct"].dataType.simpleString() == "bigint"
    assert "screen_resolution" in both["device"].dataType.names and both.names[-1] == "experiment"


def test_decode_versions_sorts_out_what_it_cannot_read(spark):
    record = lambda b: (b,)
    df = spark.createDataFrame([record(None), record(b""), record(b"\x00\x00"), record(b"\x01\x00\x00\x00\x01{}"),
                                record(b"\x00\x00\x00\x00\x07{}"), record(b"\x00\x00\x00\x00\x01{}"),
                                record(b'\x00\x00\x00\x00\x02{"event_id": "a", "experiment": "x"}')], "value binary")
    got = [(r.schema_id, r.decode_status, r.event and r.event.experiment)
           for r in envelope.decode_versions(df, fixture.event_layouts()).collect()]
    assert got == [(None, "no_header", None)] * 4 + [(7, "unknown_schema", None), (1, "corrupt", None), (2, "ok", "x")]
