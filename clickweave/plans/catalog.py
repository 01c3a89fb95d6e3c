"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each reads the driver's tables (through the deterministic Bronze view of
``events``) in full; none collects. The DuckDB twins are in
``clickweave.plans.oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave import schema
from clickweave.functions import envelope
from clickweave.operators import audit, bronze, gold, maintenance, profile, quality, spans
from clickweave.operators import silver as silver_ops
from clickweave.plans.silver import cleanse, silver
from clickweave.plans import fixture
from clickweave.session import shared_dir
from clickweave.sources.tables import for_day
from clickweave.streaming import ingest

# Parameters of the registered queries (fixed so results are reproducible).
SAMPLE_DAY = "2024-01-15"
LATE_FLOOR = "2024-01-15 00:00:00"
RUN_TS = "2024-02-01 02:00:00"

# Sessions with more events than this are hot in the *_mixed queries, so that
# both paths of the session plan run on small data.
MIXED_ROWS_PER_TASK = 3
_TIMES = ("event_timestamp", "ingestion_timestamp")

Query = Callable[[SparkSession, str], DataFrame]


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.bronze_view(spark, sf_dir)


def _clean(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return cleanse(for_day(_bronze(spark, sf_dir), None), **kw)


# -- sources / raw layer ----------------------------------------------------
def bronze_all(spark, sf_dir):
    return _bronze(spark, sf_dir)


def bronze_day(spark, sf_dir):
    return for_day(_bronze(spark, sf_dir), SAMPLE_DAY)


def bronze_floor(spark, sf_dir):
    return bronze.apply_floor(_bronze(spark, sf_dir), LATE_FLOOR)


def decode_envelope(spark, sf_dir):
    decoded = envelope.decode(fixture.envelope_view(spark, sf_dir))
    ev = F.col("event")
    fields = []
    for flat, path in schema.FLAT_PATHS:
        c = F.col(f"event.{path}")
        fields.append((envelope.millis_to_ts(c) if flat in _TIMES else c).alias(flat))
    return decoded.select(
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        ev.isNotNull().alias("decoded"),
        *fields,
    )


# Fields that the flat layout has no column for, as paths into ``rest``.
REST_PATHS = ("device.browser_version", "device.app_version", "device.screen_resolution", "geo.ip_address", "page.title",
              "properties.product_name", "properties.category", "properties.click_element", "properties.error_message")


def bronze_rest(spark, sf_dir):
    """Flat rows, and from their VARIANT column the fields that have no place there."""
    rows = bronze.transform(fixture.full_envelope_view(spark, sf_dir), keep_rest=True)
    rest = F.col(schema.REST)
    return rows.select(
        "event_id", "event_type", "os", "kafka_offset",
        *[F.try_variant_get(rest, f"$.{p}", "string").alias(p.rpartition(".")[2]) for p in REST_PATHS],
        F.try_variant_get(rest, "$.experiment.arm", "bigint").alias("arm"),
        F.try_variant_get(rest, "$.device.os", "string").alias("os_again"))


_REPLAYED = ("event_id", "event_type", "event_timestamp", "device_type", "city", "price", "order_value", "event_date")


def stream_without_replays(spark, sf_dir):
    """The raw stream job over all events, replays taken out by its state."""
    folder = shared_dir(spark, f"replays-{uuid.uuid4().hex}")
    spark.createDataFrame([], schema.BRONZE).write.parquet(f"{folder}/rows/batch=-1")  # there may be no batch
    query = ingest.start_bronze_foreach_batch(
        fixture.envelope_stream(spark, sf_dir),
        lambda batch, i: batch.write.mode("overwrite").parquet(f"{folder}/rows/batch={i}"),
        checkpoint=f"{folder}/state", trigger="availableNow", drop_replays="1 day")
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/rows").select(*_REPLAYED)


def encode_envelope(spark, sf_dir):
    rows = _bronze(spark, sf_dir)
    records = envelope.encode(rows, keep=("kafka_offset",))
    payload = envelope.strip_header(F.col("value")).cast("string")

    def field(path: str):
        return F.get_json_object(payload, path)

    fields = []
    for flat, path in schema.FLAT_PATHS:
        c = field(f"$.{path}")
        if flat in _TIMES:
            fields.append(c.cast("long").alias(f"{flat}_ms"))
        else:
            fields.append(c.cast(schema.BRONZE[flat].dataType).alias(flat))
    return records.select(
        "kafka_offset",
        F.col("key").cast("string").alias("key"),
        F.hex(F.substring("value", 1, schema.ENVELOPE_HEADER_BYTES)).alias("header_hex"),
        *fields,
    )


def bronze_flatten(spark, sf_dir):
    return bronze.transform(fixture.envelope_view(spark, sf_dir))


def decode_by_schema_id(spark, sf_dir):
    decoded = envelope.decode_versions(fixture.versioned_envelope_view(spark, sf_dir), fixture.event_layouts())
    return decoded.select(
        F.col("offset").alias("kafka_offset"), "schema_id", "decode_status",
        *[F.col(f"event.{path}").alias(flat) for flat, path in (
            ("event_id", "event_id"), ("event_type", "event_type"), ("os", "device.os"), ("price", "properties.price"),
            ("scroll_depth_pct", "properties.scroll_depth_pct"), ("experiment", "experiment"))])


def bronze_rejects(spark, sf_dir):
    decoded = envelope.decode(fixture.envelope_view(spark, sf_dir))
    return bronze.rejects(decoded, LATE_FLOOR).select(
        F.col("key").cast("string").alias("key"), "kafka_partition", "kafka_offset", "reason")


# -- silver layer -----------------------------------------------------------
def silver_dedup(spark, sf_dir):
    return silver_ops.deduplicate(for_day(_bronze(spark, sf_dir), None))


def silver_not_null(spark, sf_dir):
    return _clean(spark, sf_dir)


def silver_keep_good_copy(spark, sf_dir):
    return _clean(spark, sf_dir, drop_nulls_first=True)


def silver_enrich(spark, sf_dir):
    return silver_ops.enrich(_clean(spark, sf_dir), RUN_TS)


_SESSION_OUT = ("event_id", "session_id", "event_date") + schema.SESSION_COLUMNS


def silver_sessions(spark, sf_dir):
    return silver_ops.session_metrics(_clean(spark, sf_dir), "day").select(*_SESSION_OUT)


def silver_sessions_mixed(spark, sf_dir):
    return silver_ops.session_metrics(
        _clean(spark, sf_dir), "day", rows_per_task=MIXED_ROWS_PER_TASK).select(*_SESSION_OUT)


def silver_sessions_window(spark, sf_dir):
    return silver_ops.session_metrics(_clean(spark, sf_dir), "day", cold="window").select(*_SESSION_OUT)


def silver_sessions_span(spark, sf_dir):
    return silver_ops.session_metrics(_clean(spark, sf_dir), "all").select(*_SESSION_OUT)


def silver_sessions_span_mixed(spark, sf_dir):
    return silver_ops.session_metrics(
        _clean(spark, sf_dir), "all", rows_per_task=MIXED_ROWS_PER_TASK).select(*_SESSION_OUT)


def silver_sessions_carry(spark, sf_dir):
    """Day metrics, then the sessions over midnight merged from their states."""
    daily = silver_ops.session_metrics(_clean(spark, sf_dir), "day")
    return spans.carry_over(daily, spans.crossing(spans.day_states(daily))).select(*_SESSION_OUT)


def silver_stale_days(spark, sf_dir):
    """Days that late loads made stale, after a first build without the late
    loads of the partitions 1 to 3 and with other counts of load 2 on Mondays."""
    now = maintenance.loads(fixture.loads_view(spark, sf_dir))
    monday = F.dayofweek("event_date") == 2
    then = now.where(~F.col("load_id").isin("late-1", "late-2", "late-3")).withColumn(
        "load_rows", F.when(monday & (F.col("load_id") == "load-2"), F.col("load_rows") + 1).otherwise(F.col("load_rows")))
    return maintenance.stale_days(now, then)


def silver_full(spark, sf_dir):
    return silver(_bronze(spark, sf_dir), None, run_ts=RUN_TS)


def silver_day(spark, sf_dir):
    return silver(_bronze(spark, sf_dir), SAMPLE_DAY, run_ts=RUN_TS)


def silver_day_mixed(spark, sf_dir):
    return silver(_bronze(spark, sf_dir), SAMPLE_DAY, run_ts=RUN_TS, rows_per_task=MIXED_ROWS_PER_TASK)


def silver_audit(spark, sf_dir):
    return audit.stage_counts(for_day(_bronze(spark, sf_dir), None))


# -- gold layer -------------------------------------------------------------
def session_facts(spark, sf_dir):
    return gold.session_facts(_clean(spark, sf_dir))


def _kpi_tables(spark, sf_dir):
    clean = _clean(spark, sf_dir)
    return gold.daily_states(clean), gold.daily_users(clean, gold.number_users(clean))


def daily_kpis(spark, sf_dir):
    return gold.rolling_kpis(*_kpi_tables(spark, sf_dir), days=1)


def weekly_kpis(spark, sf_dir):
    return gold.rolling_kpis(*_kpi_tables(spark, sf_dir), days=7)


# -- profile ----------------------------------------------------------------
def profile_total(spark, sf_dir):
    return profile.total(_bronze(spark, sf_dir))


def profile_event_types(spark, sf_dir):
    return profile.counts_by(_bronze(spark, sf_dir), "event_type")


def profile_top_cities(spark, sf_dir):
    return profile.top_values(_bronze(spark, sf_dir), "city", 10)


# -- contract checks --------------------------------------------------------
def dq_enum_domains(spark, sf_dir):
    return quality.enum_domains(_bronze(spark, sf_dir))


def dq_conditional_fields(spark, sf_dir):
    return quality.conditional_fields(_bronze(spark, sf_dir))


def dq_required_fields(spark, sf_dir):
    return quality.required_fields(_bronze(spark, sf_dir))


def dq_row_violations(spark, sf_dir):
    return quality.row_violations(_bronze(spark, sf_dir)).select(
        "event_id", "kafka_offset", "violations", "n_violations", "rules")


def event_mix(spark, sf_dir):
    return quality.event_mix(_bronze(spark, sf_dir))


def ingestion_lag(spark, sf_dir):
    return quality.ingestion_lag(_bronze(spark, sf_dir))


def auth_share(spark, sf_dir):
    return quality.auth_share(_bronze(spark, sf_dir))


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        bronze_all, bronze_day, bronze_floor, decode_envelope, encode_envelope, bronze_flatten,
        silver_dedup, silver_not_null, silver_keep_good_copy, silver_enrich, silver_sessions,
        silver_sessions_window, silver_sessions_mixed, silver_sessions_span,
        silver_sessions_span_mixed, silver_full, silver_day, silver_day_mixed, silver_audit,
        profile_total, profile_event_types, profile_top_cities,
        dq_enum_domains, dq_conditional_fields, dq_required_fields,
        event_mix, ingestion_lag, auth_share,
        session_facts, daily_kpis, weekly_kpis, silver_sessions_carry, silver_stale_days,
        decode_by_schema_id, bronze_rejects, dq_row_violations, bronze_rest, stream_without_replays,
    )
}
