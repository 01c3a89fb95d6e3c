"""Session facts and KPI states: order-dependent funnel by brute force, a hot
session, and ranges of days against a full recount."""

from __future__ import annotations

import datetime as dt
import random
import uuid

from conftest import SF001, bronze_rows
from pyspark.sql import functions as F
from test_plans import _shuffle_records_written

from clickweave import schema
from clickweave.operators import gold
from clickweave.plans import catalog, fixture
from clickweave.plans.maintenance import update_kpis
from clickweave.plans.silver import run_silver


def brute_funnel(events, funnel=gold.FUNNEL) -> int:
    """Earliest time of each step after the one before."""
    at, done = None, 0
    for step in funnel:
        later = [t for t, kind in events if kind == step and (at is None or t > at)]
        if not later:
            break
        at, done = min(later), done + 1
    return done


def test_funnel_in_order_with_ties_and_slices(spark):
    r = random.Random(3)
    rows, want = [], {}
    for s in range(120):
        events = [(dt.datetime(2024, 1, 10, 23, 50) + dt.timedelta(seconds=r.choice([0, 1, 2, 600, 601, 1200, 5000])),
                   r.choice([*gold.FUNNEL, "search"])) for _ in range(r.randrange(1, 9))]
        want[f"s{s}"] = brute_funnel(events)
        rows += [{"event_id": f"e{s}-{i}", "session_id": f"s{s}", "event_timestamp": str(t), "event_type": kind}
                 for i, (t, kind) in enumerate(events)]
    df = bronze_rows(spark, rows).repartition(5)
    for seconds in (1, 600, 86_400):
        got = {x.session_id: x.funnel_step for x in gold.session_facts(df, slice_seconds=seconds).collect()}
        assert got == want
    assert set(want.values()) == {0, 1, 2, 3}


def test_entry_exit_revenue_and_ties(spark):
    t = "2024-01-10 10:00:00"
    df = bronze_rows(spark, [
        {"event_id": "b", "session_id": "s", "event_timestamp": t, "page_path": "/b"},
        {"event_id": "a", "session_id": "s", "event_timestamp": t, "page_path": None},
        {"event_id": "c", "session_id": "s", "event_timestamp": t, "page_path": "/c", "event_type": "checkout_complete", "order_value": 0.1},
        {"event_id": "d", "session_id": "s", "event_timestamp": "2024-01-10 09:00:00", "page_path": "/d", "event_type": "error", "order_value": 5.0},
        {"event_id": "e", "session_id": None, "event_timestamp": t}])
    row, = gold.session_facts(df).collect()
    assert (row.entry_page, row.exit_page, row.events, row.orders, str(row.revenue)) == ("/d", "/c", 4, 1, "0.10")
    assert row.duration_secs == 3600 and row.funnel_stage == "page_view" and not row.is_bounce
    assert gold.session_facts(df.limit(0)).count() == 0


def test_hot_session_is_combined_before_the_shuffle(spark):
    """One session with half of all rows: a map task ships a row for each of
    its slices, and the second exchange has a row for each slice."""
    n, tasks = 40_000, 8
    df = spark.range(n, numPartitions=tasks).select(
        F.col("id").cast("string").alias("event_id"), F.lit("2024-01-10").cast("date").alias("event_date"),
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id"))).alias("session_id"),
        (F.lit("2024-01-10 00:00:00").cast(schema.TS) + F.make_dt_interval(secs=(F.col("id") % 7200).cast("decimal(18,6)"))).alias("event_timestamp"),
        F.lit("/p").alias("page_path"), F.lit("u").alias("user_id"), F.lit(None).cast("double").alias("order_value"),
        F.element_at(F.array(*[F.lit(x) for x in gold.FUNNEL]), (F.col("id") % 3 + 1).cast("int")).alias("event_type"))
    facts = gold.session_facts(df)
    slices = 7200 // gold.SLICE_SECONDS
    written = sorted(_shuffle_records_written(facts))
    assert all(w <= n // 2 + tasks * slices for w in written)
    hot = facts.where("session_id = 'hot'").first()
    assert hot.events == n // 2 and hot.funnel_step == 3


def test_user_numbers_are_stable_dense_and_unique(spark):
    users = lambda a, b: spark.range(a, b).select(F.concat(F.lit("u"), F.col("id")).alias("user_id"))
    first = gold.number_users(users(0, 300).unionByName(users(0, 50)), shares=8)
    known = {r.user_id: r.user_no for r in first.collect()}
    assert len(set(known.values())) == 300 and max(known.values()) < 8 * 80
    both = {r.user_id: r.user_no for r in gold.number_users(users(200, 400), first, shares=8).collect()}
    assert len(both) == len(set(both.values())) == 400 and all(both[u] == n for u, n in known.items())


def test_ranges_from_stored_states_equal_a_recount(spark):
    name = lambda p: f"{p}_{uuid.uuid4().hex[:8]}"
    silver_t, states_t, users_t, numbers_t = name("silver"), name("kpi"), name("kpiu"), name("users")
    run_silver(spark, fixture.bronze_view(spark, SF001), silver_t, None, run_ts=catalog.RUN_TS)
    days = sorted(r[0] for r in spark.table(silver_t).select("event_date").distinct().collect())
    for part in (days[:10], days[10:], days[5:12]):  # the last are replaced
        update_kpis(spark, silver_t, states_t, users_t, numbers_t, part)
    rows = spark.table(silver_t)
    assert spark.table(numbers_t).count() == rows.select("user_id").where("user_id IS NOT NULL").distinct().count()
    for a, b in ((days[0], days[-1]), (days[3], days[13]), (days[7], days[7])):
        inside = rows.where(F.col("event_date").between(a, b))
        want = inside.agg(F.count("*"), F.countDistinct("user_id"), F.countDistinct("event_date", "session_id"),
                          F.sum(gold.revenue())).first()
        got, = gold.kpis_between(spark.table(states_t), spark.table(users_t), str(a), str(b)).collect()
        assert (got.events, got.users, got.sessions, got.revenue) == tuple(want)
        assert got.days == inside.select("event_date").distinct().count()
    assert gold.kpis_between(spark.table(states_t), spark.table(users_t), "1999-01-01", "1999-01-02").count() == 0
