"""Benchmark the headline queries.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default sf0.1) and
prints ONE JSON line. Each query is fully executed through the ``noop`` sink
(no collect); the figure per query is the median of ``$BENCH_RUNS`` warm
runs. Besides the registered queries it times two write jobs on a scratch
folder: ``silver_write`` (this repo's job: one action, stage counts by
observation, atomic overwrite into a partitioned table) and
``silver_reference_shape`` (the original's shape: an action after every stage
and a single-file ``coalesce(1)`` write).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from clickweave import schema  # noqa: E402
from clickweave.functions import columns  # noqa: E402
from clickweave.operators import bronze as bronze_ops  # noqa: E402
from clickweave.operators import silver as ops  # noqa: E402
from clickweave.plans import catalog  # noqa: E402
from clickweave.plans.silver import run_silver, silver  # noqa: E402
from clickweave.session import build_session  # noqa: E402
from clickweave.sinks import tables as sinks  # noqa: E402
from clickweave.plans import fixture  # noqa: E402
from clickweave.sources.tables import for_day  # noqa: E402

HEADLINE = ("silver_full", "silver_dedup", "silver_sessions", "profile_event_types",
            "profile_top_cities")
EXTRA = ("silver_sessions_mixed", "silver_sessions_window", "silver_day", "silver_audit", "bronze_flatten",
         "profile_total", "dq_enum_domains", "dq_conditional_fields", "event_mix")


def timed(fn, runs: int, warmup: int = 2) -> float:
    for _ in range(warmup):
        fn()
    samples = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        samples.append(time.perf_counter() - t0)
    return round(statistics.median(samples), 3)


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def silver_write(spark, sf_dir, table):
    """The Silver job as shipped: one action, observed stage counts, atomic
    overwrite of every day into a partitioned table (rebalanced by day)."""
    def run():
        return run_silver(spark, fixture.bronze_view(spark, sf_dir), table, None,
                          run_ts=catalog.RUN_TS)
    return run


def silver_day_from_table(spark, bronze_table, table):
    """The daily job as deployed: one day read from the partitioned raw table
    (partition-pruned scan) and rewritten atomically."""
    def run():
        return run_silver(spark, bronze_table, table, catalog.SAMPLE_DAY, run_ts=catalog.RUN_TS)
    return run


def silver_reference_shape(spark, sf_dir, out_dir):
    """Control with the original job's execution shape (not its defects)."""
    def run():
        df = for_day(fixture.bronze_view(spark, sf_dir), None)
        df.count()
        before = df.count()
        d = ops.deduplicate(df)
        after = d.count()
        c = ops.drop_incomplete(d)
        before, after = d.count(), c.count()
        w = Window.partitionBy("event_date", "session_id")
        s = ops.enrich(c, catalog.RUN_TS).withColumns({
            "session_event_count": F.count("event_id").over(w),
            "session_start": F.min("event_timestamp").over(w),
            "session_end": F.max("event_timestamp").over(w),
        })
        s = s.withColumns({
            "session_duration_secs": columns.duration_secs("session_start", "session_end"),
            "is_bounce": F.col("session_event_count") == 1})
        s = s.select(*schema.SILVER_COLUMNS)
        s.count()
        s.coalesce(1).write.mode("overwrite").parquet(out_dir)
        return before, after
    return run


def skewed(spark, sf_dir):
    """The raw rows with one session that holds a third of them."""
    return fixture.bronze_view(spark, sf_dir).withColumn(
        "session_id", F.when(F.col("kafka_offset") % 3 == 0, F.lit("hot")).otherwise(F.col("session_id")))


def many_files(spark, sf_dir, folder, files: int = 64):
    """The raw rows and their broker records as ``files`` files each, so that
    scans run in parallel and decoding is timed without encoding."""
    raw, records = os.path.join(folder, "raw"), os.path.join(folder, "records")
    fixture.bronze_view(spark, sf_dir).repartition(files).write.parquet(raw)
    fixture.envelope_view(spark, sf_dir).repartition(files).write.parquet(records)
    return spark.read.parquet(raw), spark.read.parquet(records)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    scratch = tempfile.mkdtemp(prefix="clickweave-bench-")
    spark = build_session("clickweave-bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": str(cpus * 2),
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    results = {}
    for name in HEADLINE + EXTRA:
        fn = catalog.QUERIES[name]
        results[name] = timed(lambda fn=fn: noop(fn(spark, sf_dir)), runs)
    results["silver_write"] = timed(silver_write(spark, sf_dir, "silver_bench"), runs)
    sinks.create_bronze_table(spark, "bronze_bench")
    sinks.append(fixture.bronze_view(spark, sf_dir), "bronze_bench")
    results["silver_day_table"] = timed(
        silver_day_from_table(spark, "bronze_bench", "silver_bench_day"), runs)
    results["silver_reference_shape"] = timed(
        silver_reference_shape(spark, sf_dir, os.path.join(scratch, "b")), runs)
    raw, records = many_files(spark, sf_dir, scratch)
    results["files_decode"] = timed(lambda: noop(bronze_ops.transform(records)), runs)
    results["files_silver_cold"] = timed(lambda: noop(silver(raw, None, run_ts=catalog.RUN_TS)), runs)
    results["files_silver_mixed"] = timed(lambda: noop(
        silver(raw, None, run_ts=catalog.RUN_TS, rows_per_task=catalog.MIXED_ROWS_PER_TASK)), runs)
    hot = skewed(spark, sf_dir)
    results["skew_silver_hot"] = timed(lambda: noop(silver(hot, None, run_ts=catalog.RUN_TS, session_scope="all", rows_per_task=1000)), runs)
    rows = fixture.load(spark, sf_dir, "events").agg(F.count(F.lit(1))).first()[0]
    total = round(sum(results[q] for q in HEADLINE), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_sum_median_sec",
        "value": total,
        "unit": "sec",
        "queries": results,
        "sf": sf,
        "events_rows": rows,
        "cpus": cpus,
        "runs": runs,
        "events_per_sec_silver_write": round(rows / results["silver_write"], 1),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
