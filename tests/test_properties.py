"""Property tests: dedup and session invariants on generated rows."""

from __future__ import annotations

from conftest import bronze_rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickweave.operators import silver as ops
from clickweave.plans.silver import cleanse

row = st.fixed_dictionaries({
    "event_id": st.sampled_from(["a", "b", "c", "d", None]),
    "session_id": st.sampled_from(["s1", "s2", "s3", None]),
    "ingestion_timestamp": st.sampled_from(
        [None, "2024-01-10 10:00:00", "2024-01-10 10:00:01", "2024-01-10 11:00:00"]),
    "event_timestamp": st.sampled_from(
        ["2024-01-10 09:59:59.500", "2024-01-10 10:00:00", "2024-01-10 23:59:59",
         "2024-01-11 00:00:00.250"]),
    "kafka_partition": st.integers(0, 1),
})

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _frame(spark, rows):
    return bronze_rows(spark, [dict(r, kafka_offset=i) for i, r in enumerate(rows)])


@SETTINGS
@given(st.lists(row, min_size=1, max_size=12))
def test_dedup_unique_and_idempotent(spark, rows):
    once = ops.deduplicate(_frame(spark, rows))
    twice = ops.deduplicate(once)
    keys = once.groupBy("event_date", "event_id").count()
    assert keys.where(F.col("count") > 1).count() == 0
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
    assert once.count() == _frame(spark, rows).select("event_date", "event_id").distinct().count()


@SETTINGS
@given(st.lists(row, min_size=1, max_size=12))
def test_session_count_invariant(spark, rows):
    clean = cleanse(_frame(spark, rows))
    for scope in ("day", "all"):
        keys = ops.session_keys(scope)
        agg = clean.join(ops.session_stats(clean, keys), keys)
        for options in ({}, {"rows_per_task": 0}, {"rows_per_task": 1}, {"rows_per_task": 1, "max_hot": 2}, {"cold": "window"}):
            alt = ops.session_metrics(clean, scope, **options)
            assert agg.exceptAll(alt.select(*agg.columns)).count() == 0
            assert alt.count() == agg.count()
        total = agg.agg(F.sum(1 / F.col("session_event_count"))).first()[0] or 0
        sessions = clean.select(*ops.session_keys(scope)).distinct().count()
        assert round(total, 9) == sessions
