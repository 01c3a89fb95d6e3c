"""Deterministic Bronze view over the driver's ``events`` table.

``events`` holds no sessions, devices, geo, nulls or duplicates, so this view
injects them by fixed rules on the original ``event_id`` (``id``) and keeps
every source row. Rows with ``id % 20 == 0`` are delivered a second time (a
broker replay) through a one-scan ``explode``; no row is dropped or sampled.

The rules below are fixed values of the test fixture (see FIXTURES.md §3);
the DuckDB twin of this view lives in ``clickweave.plans.oracle``.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave import schema

REPLAY_OFFSET = 1_000_000_000
SHOP_URL = "https://shop.example.com"

# Declared schemas of the driver tables used here: reading with a schema
# skips footer-based inference on every plan.
SOURCE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    reader = spark.read
    if table in SOURCE_SCHEMAS:
        reader = reader.schema(SOURCE_SCHEMAS[table])
    return reader.parquet(os.path.join(sf_dir, f"{table}.parquet"))


def _event_type(id_: Column, raw: Column) -> Column:
    view = (F.when(id_ % 3 == 0, "page_view").when(id_ % 3 == 1, "scroll")
            .otherwise("search"))
    mapped = (F.when(raw == "view", view)
              .when(raw == "purchase", "checkout_complete")
              .when(raw == "signup", "login")
              .when(raw == "click", F.when(id_ % 2 == 1, "add_to_cart").otherwise("click"))
              .when(raw == "error", "error"))
    return (F.when(id_ % 89 == 0, F.lit(None).cast("string"))
            .when(id_ % 227 == 0, "hover")
            .otherwise(mapped))


def _device_type(id_: Column) -> Column:
    slot = id_ % 20
    return (F.when(id_ % 233 == 0, "fridge")
            .when(slot < 10, "desktop").when(slot < 17, "mobile")
            .when(slot < 19, "tablet").otherwise("smart_tv"))


def _session_view(spark: SparkSession, kind: str, sf_dir: str, build) -> DataFrame:
    """Register ``build()`` once per session as a temp view and read it back.

    Reading a registered view reuses its analyzed plan instead of rebuilding
    hundreds of column expressions for every query.
    """
    tag = hashlib.sha1(os.path.abspath(sf_dir).encode()).hexdigest()[:12]
    name = f"clickweave_{kind}_{tag}"
    try:
        return spark.table(name)
    except AnalysisException:
        build().createOrReplaceTempView(name)
        return spark.table(name)


def bronze_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table as the stream job would have written it (27 columns)."""
    return bronze_with_id(spark, sf_dir).drop("id")


def bronze_with_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _session_view(spark, "bronze", sf_dir, lambda: _build_bronze(load(spark, sf_dir, "events")))


def _build_bronze(ev: DataFrame) -> DataFrame:
    id_, uid, ts = F.col("event_id"), F.col("user_id"), F.col("ts")
    k = F.get_json_object("props", "$.k").cast("int")
    base = ev.select(
        id_.alias("id"), uid.alias("uid"), ts.alias("ts"),
        F.col("value").alias("value"), k.alias("k"),
        _event_type(id_, F.col("event_type")).alias("etype"),
        _device_type(id_).alias("dtype"),
        # replay copy number: 0 = first delivery, 1 = replay
        F.explode(F.when(id_ % 20 == 0, F.array(F.lit(0), F.lit(1)))
                  .otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    id_, uid, ts, copy = F.col("id"), F.col("uid"), F.col("ts"), F.col("copy")
    etype, dtype = F.col("etype"), F.col("dtype")
    mobile = dtype == "mobile"
    block = F.floor((F.unix_timestamp(ts) + 10800) / 43200.0)
    session = F.concat(uid.cast("string"), F.lit("-"), block.cast("string"))
    ingest = ts + F.expr("INTERVAL 2 SECONDS")
    replay_ingest = (F.when(id_ % 60 == 0, F.lit(None).cast(schema.TS))
                     .when(id_ % 40 == 0, ingest)
                     .otherwise(ingest + F.expr("INTERVAL 1 HOUR")))
    product_event = etype.isin("click", "add_to_cart")
    geo_slot = uid % 5
    page = (uid % 12).cast("string")
    return base.select(
        id_,
        id_.cast("string").alias("event_id"),
        etype.alias("event_type"),
        ts.alias("event_timestamp"),
        F.when(copy == 0, ingest).otherwise(replay_ingest).alias("ingestion_timestamp"),
        F.when(id_ % 10 < 7, uid.cast("string")).alias("user_id"),
        F.when((copy == 1) | (id_ % 97 != 0), session).alias("session_id"),
        uid.cast("string").alias("anonymous_id"),
        dtype.alias("device_type"),
        F.when(mobile, "Android 14").otherwise("Windows 11").alias("os"),
        F.when(~mobile | (id_ % 229 == 0), "Chrome").alias("browser"),
        F.when(geo_slot == 0, "IN").when(geo_slot == 1, "US").when(geo_slot == 2, "GB")
         .when(geo_slot == 3, "SG").alias("country"),
        F.concat(F.lit("REGION_"), geo_slot.cast("string")).alias("region"),
        F.concat(F.lit("CITY_"), (uid % 25).cast("string")).alias("city"),
        F.lit("UTC").alias("timezone"),
        F.concat(F.lit(SHOP_URL + "/p/"), page).alias("page_url"),
        F.concat(F.lit("/p/"), page).alias("page_path"),
        F.when(id_ % 10 >= 3, F.lit(SHOP_URL + "/")).alias("referrer"),
        F.when(product_event, F.concat(F.lit("P"), F.lpad((id_ % 8 + 1).cast("string"), 3, "0")))
         .alias("product_id"),
        F.when(product_event, F.col("value")).alias("price"),
        F.when(etype == "search", F.concat(F.lit("q"), F.col("k").cast("string")))
         .alias("search_query"),
        F.when(id_ % 223 == 0, F.lit(150)).when(etype == "scroll", F.col("k"))
         .cast("int").alias("scroll_depth_pct"),
        F.when((etype == "checkout_complete") | (id_ % 211 == 0), F.col("value"))
         .alias("order_value"),
        F.when(mobile, F.when(id_ % 2 == 0, "ios").otherwise("android")).otherwise("web")
         .alias("source"),
        F.lit(schema.DEFAULT_SCHEMA_VERSION).alias("schema_version"),
        F.to_date(ts).alias("event_date"),
        (uid % 4).cast("int").alias("kafka_partition"),
        (id_ + copy * REPLAY_OFFSET).alias("kafka_offset"),
    )


def envelope_view(spark: SparkSession, sf_dir: str, schema_id: int = 1) -> DataFrame:
    """Broker records for the Bronze view: JSON payload behind a 5-byte header.

    Corrupt payloads are injected on purpose: ``id % 101 == 0`` is not JSON,
    ``id % 101 == 1`` is the JSON cut to 60 characters.
    """
    return _session_view(spark, f"envelope{int(schema_id)}", sf_dir,
                         lambda: _build_envelope(bronze_with_id(spark, sf_dir), schema_id))


def envelope_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records as a stream over the ``events`` file."""
    events = (spark.readStream.schema(load(spark, sf_dir, "events").schema)
              .option("pathGlobFilter", "events.parquet").parquet(sf_dir))
    return _build_envelope(_build_bronze(events), 1)


def full_envelope_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker records whose events also have the fields that the flat layout
    leaves out, and an ``experiment`` that no layout knows (see FIXTURES.md)."""
    return _session_view(spark, "full", sf_dir, lambda: _build_full(spark, sf_dir))


def _build_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickweave.functions import envelope

    id_, product = F.col("id"), F.col("product_id")

    def tag(letter: str, number: Column) -> Column:
        return F.concat(F.lit(letter), number.cast("string"))

    more = {
        "device.browser_version": F.when(F.col("browser").isNotNull(), tag("v", id_ % 7)),
        "device.app_version": F.when(F.col("source") != "web", tag("a", id_ % 4)),
        "device.screen_resolution": F.when(id_ % 3 != 0, tag("1080x", id_ % 5)),
        "geo.ip_address": tag("10.0.0.", id_ % 250),
        "page.title": tag("T", F.col("anonymous_id")),
        "properties.product_name": F.when(product.isNotNull(), F.concat(F.lit("N"), product)),
        "properties.category": F.when(product.isNotNull(), tag("C", id_ % 3)),
        "properties.click_element": F.when(F.col("event_type") == "click", tag("b", id_ % 6)),
        "properties.error_message": F.when(F.col("event_type") == "error", tag("E", id_ % 9)),
        "experiment": F.when(id_ % 2 == 0, F.struct((id_ % 5).alias("arm"))),
    }
    event = envelope.event_struct()
    for path, value in more.items():
        event = event.withField(path, value)
    return bronze_with_id(spark, sf_dir).select(
        F.col("session_id").cast("binary").alias("key"),
        F.concat(envelope.header(1), F.to_json(event).cast("binary")).alias("value"),
        F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset"))


def _build_envelope(rows: DataFrame, schema_id: int) -> DataFrame:
    from clickweave.functions import envelope

    payload = envelope.event_json()
    id_ = F.col("id")
    payload = (F.when(id_ % 101 == 0, F.lit("not json{"))
               .when(id_ % 101 == 1, F.substring(payload, 1, 60))
               .otherwise(payload))
    return rows.select(
        F.col("session_id").cast("binary").alias("key"),
        F.concat(envelope.header(schema_id), payload.cast("binary")).alias("value"),
        F.lit("clickstream.raw").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
    )


# Two layouts of the event and a registry id that nobody knows: version 2 has
# one field more, one less and a wider one (see FIXTURES.md).
UNKNOWN_SCHEMA_ID = 9
WIDE = 10_000_000_000


def event_layouts() -> dict[int, T.StructType]:
    device = T.StructType([f for f in schema.DEVICE.fields if f.name != "screen_resolution"])
    properties = T.StructType([T.StructField(f.name, T.LongType()) if f.name == "scroll_depth_pct" else f
                               for f in schema.PROPERTIES.fields])
    second = [T.StructField(f.name, {"device": device, "properties": properties}.get(f.name, f.dataType))
              for f in schema.EVENT.fields] + [T.StructField("experiment", T.StringType())]
    return {1: schema.EVENT, 2: T.StructType(second)}


def versioned_envelope_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker records of both layouts: ``id % 3 == 0`` in version 2, ``id % 31
    == 0`` under an unknown id, ``id % 101 == 0`` cut short, ``id % 103 == 0``
    without a header."""
    return _session_view(spark, "versions", sf_dir, lambda: _build_versions(spark, sf_dir))


def _build_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickweave.functions import envelope

    id_ = F.col("id")
    first = envelope.event_struct()
    second = F.to_json(first.withField("experiment", F.concat(F.lit("x"), (id_ % 5).cast("string")))
                       .withField("properties.scroll_depth_pct", F.col("scroll_depth_pct").cast("long") * F.lit(WIDE)))
    payload = F.when(id_ % 3 == 0, second).otherwise(F.to_json(first))
    payload = F.when(id_ % 101 == 0, F.substring(payload, 1, 60)).otherwise(payload).cast("binary")
    header = (F.when(id_ % 31 == 0, envelope.header(UNKNOWN_SCHEMA_ID)).when(id_ % 3 == 0, envelope.header(2))
              .otherwise(envelope.header(1)))
    value = F.when(id_ % 103 == 0, F.lit(b"{}")).otherwise(F.concat(header, payload))
    return bronze_with_id(spark, sf_dir).select(
        F.col("session_id").cast("binary").alias("key"), value.alias("value"),
        F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset"))


def loads_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Bronze view with a load id: first deliveries in loads by partition,
    replays in one late load for each partition."""
    late = F.col("kafka_offset") >= REPLAY_OFFSET
    return bronze_view(spark, sf_dir).withColumn("load_id", F.concat(
        F.when(late, "late-").otherwise("load-"), F.col("kafka_partition").cast("string")))
