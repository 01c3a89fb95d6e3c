"""Physical-plan properties the design relies on."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from conftest import SF001, bronze_rows

from clickweave.plans import catalog
from clickweave.sinks import tables as sinks
from clickweave.plans import fixture
from clickweave.sources.tables import read_bronze


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_day_read_prunes_partitions(spark):
    t = f"raw_{uuid.uuid4().hex[:8]}"
    sinks.create_bronze_table(spark, t)
    sinks.append(fixture.bronze_view(spark, SF001), t)
    df = read_bronze(spark, t, "2024-01-15")
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "= 2024-01-15" in plan


def test_dedup_limits_before_shuffle(spark):
    plan = _plan(catalog.silver_dedup(spark, SF001))
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan
    partial = plan.index("Partial")
    exchange = plan.index("Exchange hashpartitioning(event_date")
    assert exchange < partial  # printed top-down: the partial limit sits below the exchange


def test_silver_session_join_shape(spark):
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(catalog.silver_full(spark, SF001))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    assert "partial_count" in plan  # sessions pre-aggregated map-side
    assert "SortMergeJoin" in plan and "ShuffledHashJoin" not in plan  # a join that spills
    assert "BroadcastExchange" in plan  # the bounded hot-session stats
    assert "Subquery" in plan  # the row total that bounds the hot set


def test_the_job_writes_the_tested_plan(spark, monkeypatch):
    """The frame that run_silver writes has the registered query's plan, with
    the null-id filter at the scan."""
    from clickweave.plans import silver as plans

    written = []
    monkeypatch.setattr(plans.sinks, "overwrite_day", lambda df, table, day: (written.append(df), df.count()))
    t = f"raw_{uuid.uuid4().hex[:8]}"
    sinks.create_bronze_table(spark, t)
    sinks.append(fixture.bronze_view(spark, SF001), t)
    plans.run_silver(spark, t, f"silver_{uuid.uuid4().hex[:8]}", "2024-01-15", run_ts=catalog.RUN_TS)
    plan = _plan(written[0])
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert scans and all("IsNotNull(event_id)" in s and "= 2024-01-15" in s for s in scans)
    assert plan.count("CollectMetrics") == 1
    query = _plan(plans.silver(read_bronze(spark, t), "2024-01-15", run_ts=catalog.RUN_TS))
    count = lambda p: {w: p.count(w) for w in ("Exchange", "WindowGroupLimit", "SortMergeJoin", "HashAggregate", "FileScan")}
    assert count(plan) == count(query)


def test_shuffles_are_sized_by_the_input(spark):
    from clickweave.session import INITIAL_PARTITIONS, initial_partitions, sized_shuffles

    assert initial_partitions(100 << 40, 200) == 200_000 and initial_partitions(1 << 40, 200) == 8192
    assert initial_partitions(1 << 20, 8) == 8
    big = spark.range(1 << 33)  # 64 GB by its statistics
    with sized_shuffles(big) as n:
        assert n == 512 and spark.conf.get(INITIAL_PARTITIONS) == "512"
        assert ", 512)" in _plan(big.groupBy((big["id"] % 7).alias("k")).count())
    assert spark.conf.get(INITIAL_PARTITIONS, None) is None


def test_decode_parses_once(spark):
    from clickweave.operators import bronze

    df = bronze.transform(fixture.envelope_view(spark, SF001))
    assert _optimized(df).count("from_json") == 1


def test_top_k_is_take_ordered(spark):
    plan = _plan(catalog.profile_top_cities(spark, SF001))
    assert "TakeOrderedAndProject" in plan
    assert "partial_count" in plan


def test_profile_scan_prunes_columns(spark):
    df = catalog.profile_event_types(spark, SF001)
    scan = [line for line in _plan(df).splitlines() if "FileScan parquet" in line][0]
    assert "props" not in scan.split("ReadSchema:")[1]


def test_quality_single_pass(spark):
    df = catalog.dq_conditional_fields(spark, SF001)
    assert _plan(df).count("FileScan") == 1


def test_no_single_task_write(spark):
    df = bronze_rows(spark, [{}])
    from clickweave.plans.silver import silver

    assert "Coalesce 1" not in _plan(silver(df, None))


def _skewed(spark, n):
    from pyspark.sql import functions as F

    from clickweave import schema

    return (spark.range(n, numPartitions=8).select(
        F.col("id").cast("string").alias("event_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
         .otherwise(F.concat(F.lit("s"), (F.col("id") % 5000).cast("string"))).alias("session_id"),
        (F.lit("2024-01-10 00:00:00").cast(schema.TS)
         + F.make_dt_interval(secs=(F.col("id") % 80000).cast("decimal(18,6)"))).alias("event_timestamp"),
    ).withColumn("event_date", F.to_date("event_timestamp")))


def _per_task(spark, out):
    from pyspark.sql import functions as F

    return out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


@contextmanager
def _settings(spark, **settings):
    keys = {f"spark.sql.{k.replace('_', '.')}": v for k, v in settings.items()}
    prev = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in prev.items():
            spark.conf.set(k, v)


def test_hot_session_is_spread_over_tasks(spark):
    """One session holds a third of all rows; no task may receive it whole."""
    from pyspark.sql import functions as F

    from clickweave.operators import silver as ops

    n = 60_000
    df = _skewed(spark, n)
    with _settings(spark, autoBroadcastJoinThreshold="-1", adaptive_coalescePartitions_enabled="false"):
        out = ops.session_metrics(df, "day", rows_per_task=100)
        # filter on a computed stat so the session step cannot be pruned
        assert _per_task(spark, out.where(F.col("session_event_count") > 0)) < n // 6
        hot = out.where("session_id = 'hot'")
        stats = hot.agg(F.count("*"), F.min("session_event_count"), F.max("session_event_count")).first()
        cold = ops.session_metrics(df, "day")  # below ROWS_PER_TASK: the ordinary path
        assert out.exceptAll(cold.select(*out.columns)).count() == 0
    assert tuple(stats) == (n // 3, n // 3, n // 3)  # every hot row still gets exact stats


def test_hot_rows_skip_the_session_exchange(spark):
    from clickweave.operators import silver as ops

    n = 60_000
    df = _skewed(spark, n)
    with _settings(spark, autoBroadcastJoinThreshold="-1", adaptive_coalescePartitions_enabled="false"):
        written = _shuffle_records_written(ops.session_metrics(df, "day", rows_per_task=100))
    assert max(written) == n - n // 3


def test_null_session_keys_are_spread(spark):
    from pyspark.sql import functions as F

    from clickweave.operators import silver as ops

    n = 30_000
    df = _skewed(spark, n).withColumn(
        "session_id", F.when(F.col("session_id") == "hot", F.lit(None)).otherwise(F.col("session_id")))
    with _settings(spark, autoBroadcastJoinThreshold="-1", adaptive_coalescePartitions_enabled="false"):
        out = ops.session_metrics(df, "day").where(
            F.col("session_event_count").isNull() | (F.col("session_event_count") > 0))
        per_task = _per_task(spark, out)
        got = out.where(F.col("session_id").isNull()).agg(F.count("*"), F.count("session_event_count")).first()
    assert per_task < n // 6
    assert tuple(got) == (n // 3, 0)  # kept, with null metrics


def _shuffle_records_written(df) -> list[int]:
    """Run ``df`` and read each shuffle's records-written metric."""
    df.collect()
    out, stack = [], [df._jdf.queryExecution().executedPlan()]
    while stack:
        p = stack.pop()
        cls = p.getClass().getSimpleName()
        children = p.children()
        stack.extend(children.apply(i) for i in range(children.size()))
        if cls.endswith("QueryStageExec"):
            stack.append(p.plan())
        if cls == "AdaptiveSparkPlanExec":
            stack.append(p.executedPlan())
        if cls == "ShuffleExchangeExec":
            out.append(int(p.metrics().apply("shuffleRecordsWritten").value()))
    return out


def test_hot_copy_group_is_combined_before_the_shuffle(spark):
    """One event with a third of all rows as copies: each map task ships
    one copy, not all of them."""
    from pyspark.sql import functions as F

    from clickweave import schema
    from clickweave.operators import silver as ops

    n, tasks = 60_000, 8
    df = spark.range(n, numPartitions=tasks).select(
        F.when(F.col("id") % 3 == 0, F.lit("dup")).otherwise(F.col("id").cast("string"))
         .alias("event_id"),
        F.lit("2024-01-10").cast("date").alias("event_date"),
        (F.lit("2024-01-10 00:00:00").cast(schema.TS)
         + F.make_dt_interval(secs=(F.col("id") % 1000).cast("decimal(18,6)"))).alias("ingestion_timestamp"),
        F.lit(0).alias("kafka_partition"), F.col("id").alias("kafka_offset"))
    written = _shuffle_records_written(ops.deduplicate(df))
    assert written == [n - n // 3 + tasks]
