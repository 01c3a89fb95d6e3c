"""One source of truth for the event contract and the table layouts.

Event times are carried as ``timestamp_ntz`` holding UTC wall-clock time, so
calendar fields (``event_date``, hour, weekday) never depend on the session
time zone of whoever runs the job.
"""

from __future__ import annotations

import json

from pyspark.sql import types as T

TS = T.TimestampNTZType()

# --------------------------------------------------------------------------
# Fixed values of the event contract. They must equal the contract for right
# results: enum symbols in contract order, the simulator's event-type weights,
# the default schema version, the envelope header size, the stated
# ingestion-lag and authenticated-share rules, the Avro type names (Avro
# resolves records and enums by name), required fields, wire structs, the raw
# layout and its paths into the event. They end before ENRICH_COLUMNS.
# --------------------------------------------------------------------------
EVENT_TYPES = (
    "page_view", "click", "scroll", "search", "add_to_cart", "remove_from_cart",
    "checkout_start", "checkout_complete", "login", "logout", "app_open",
    "app_close", "error",
)
DEVICE_TYPES = ("desktop", "mobile", "tablet", "smart_tv", "unknown")
SOURCES = ("web", "ios", "android", "backend_service", "event_log")
NATIVE_APP_SOURCES = ("ios", "android")
EVENT_TYPE_WEIGHTS = (
    ("page_view", 35), ("click", 25), ("scroll", 15), ("search", 8),
    ("add_to_cart", 5), ("remove_from_cart", 2), ("checkout_start", 3),
    ("checkout_complete", 2), ("login", 2), ("logout", 1), ("app_open", 1),
    ("app_close", 1), ("error", 1),
)
DEFAULT_SCHEMA_VERSION = "1.0.0"
ENVELOPE_HEADER_BYTES = 5
MAX_INGESTION_LAG_MS = 3000
AUTHENTICATED_SHARE = 0.7
DEFAULT_TIMESTAMP_FLOOR = "2024-01-01 00:00:00"
AVRO_EVENT_RECORD = "ClickstreamEvent"
AVRO_RECORD_NAMES = {"device": "Device", "geo": "Geo", "page": "Page",
                     "properties": "EventProperties"}
AVRO_ENUM_NAMES = {"event_type": "EventType", "device_type": "DeviceType", "source": "Source"}

# Fields that must be present on every event (non-union types in the contract).
REQUIRED_FIELDS = (
    "event_id", "event_type", "event_timestamp", "ingestion_timestamp",
    "session_id", "anonymous_id", "device_type", "os", "country", "timezone",
    "page_url", "page_path", "source", "schema_version",
)
# Fields the Silver layer refuses to carry when null.
SILVER_REQUIRED = ("event_id", "session_id", "event_type", "event_timestamp", "event_date")
# Enum-typed fields and their domains.
ENUM_DOMAINS = (
    ("event_type", EVENT_TYPES),
    ("device_type", DEVICE_TYPES),
    ("source", SOURCES),
)


def _str(name: str) -> T.StructField:
    return T.StructField(name, T.StringType(), True)


# Nested event as it travels on the wire. Timestamps are epoch milliseconds,
# as the contract's ``timestamp-millis`` longs.
DEVICE = T.StructType([
    _str("device_type"), _str("os"), _str("browser"), _str("browser_version"),
    _str("app_version"), _str("screen_resolution"),
])
GEO = T.StructType([
    _str("country"), _str("region"), _str("city"), _str("timezone"), _str("ip_address"),
])
PAGE = T.StructType([_str("url"), _str("path"), _str("referrer"), _str("title")])
PROPERTIES = T.StructType([
    _str("product_id"), _str("product_name"), _str("category"),
    T.StructField("price", T.DoubleType(), True), _str("search_query"),
    T.StructField("scroll_depth_pct", T.IntegerType(), True), _str("click_element"),
    _str("error_message"), T.StructField("order_value", T.DoubleType(), True),
])
EVENT = T.StructType([
    _str("event_id"), _str("event_type"),
    T.StructField("event_timestamp", T.LongType(), True),
    T.StructField("ingestion_timestamp", T.LongType(), True),
    _str("user_id"), _str("session_id"), _str("anonymous_id"),
    T.StructField("device", DEVICE, True),
    T.StructField("geo", GEO, True),
    T.StructField("page", PAGE, True),
    T.StructField("properties", PROPERTIES, True),
    _str("source"), _str("schema_version"),
])

# Stream record as delivered by the broker (or a file-based stand-in).
ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("timestampType", T.IntegerType(), True),
])

# Raw (Bronze) table: flat, partitioned by event_date.
BRONZE = T.StructType([
    _str("event_id"), _str("event_type"),
    T.StructField("event_timestamp", TS, True),
    T.StructField("ingestion_timestamp", TS, True),
    _str("user_id"), _str("session_id"), _str("anonymous_id"),
    _str("device_type"), _str("os"), _str("browser"),
    _str("country"), _str("region"), _str("city"), _str("timezone"),
    _str("page_url"), _str("page_path"), _str("referrer"),
    _str("product_id"), T.StructField("price", T.DoubleType(), True),
    _str("search_query"), T.StructField("scroll_depth_pct", T.IntegerType(), True),
    T.StructField("order_value", T.DoubleType(), True),
    _str("source"), _str("schema_version"),
    T.StructField("event_date", T.DateType(), True),
    T.StructField("kafka_partition", T.IntegerType(), True),
    T.StructField("kafka_offset", T.LongType(), True),
])
BRONZE_COLUMNS = tuple(f.name for f in BRONZE.fields)
EVENT_COLUMNS = BRONZE_COLUMNS[:25]  # Bronze without the broker lineage

# Flat Bronze column -> path in the nested event (P1/P2). ``event_date`` is
# derived and the two lineage columns come from the broker record.
FLAT_PATHS = (
    ("event_id", "event_id"), ("event_type", "event_type"),
    ("event_timestamp", "event_timestamp"), ("ingestion_timestamp", "ingestion_timestamp"),
    ("user_id", "user_id"), ("session_id", "session_id"), ("anonymous_id", "anonymous_id"),
    ("device_type", "device.device_type"), ("os", "device.os"), ("browser", "device.browser"),
    ("country", "geo.country"), ("region", "geo.region"), ("city", "geo.city"),
    ("timezone", "geo.timezone"),
    ("page_url", "page.url"), ("page_path", "page.path"), ("referrer", "page.referrer"),
    ("product_id", "properties.product_id"), ("price", "properties.price"),
    ("search_query", "properties.search_query"),
    ("scroll_depth_pct", "properties.scroll_depth_pct"),
    ("order_value", "properties.order_value"),
    ("source", "source"), ("schema_version", "schema_version"),
)

# -- end of the fixed contract lists (the Silver layout is built from them) -----

ENRICH_COLUMNS = ("hour_of_day", "day_of_week", "is_weekend", "is_indian_user", "device_category")
SESSION_COLUMNS = (
    "session_event_count", "session_duration_secs", "is_bounce", "session_start", "session_end",
)
SILVER = T.StructType(
    [BRONZE[c] for c in EVENT_COLUMNS]
    + [
        T.StructField("hour_of_day", T.IntegerType(), True),
        T.StructField("day_of_week", T.StringType(), True),
        T.StructField("is_weekend", T.BooleanType(), True),
        T.StructField("is_indian_user", T.BooleanType(), True),
        T.StructField("device_category", T.StringType(), True),
        T.StructField("session_event_count", T.LongType(), True),
        T.StructField("session_duration_secs", T.LongType(), True),
        T.StructField("is_bounce", T.BooleanType(), True),
        T.StructField("session_start", TS, True),
        T.StructField("session_end", TS, True),
        T.StructField("processed_at", TS, True),
    ]
)
SILVER_COLUMNS = tuple(f.name for f in SILVER.fields)


# Optional column of a raw table: what the flat layout has no column for.
REST = "rest"


def ddl(schema: T.StructType) -> str:
    """Column list for CREATE TABLE, derived from a StructType."""
    return ",\n  ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


# Avro writer schema: enums are real Avro enums (the raw job in the original
# pipeline decoded them as strings, which misreads every non-first symbol).
_ENUM_FIELDS = {field: (AVRO_ENUM_NAMES[field], domain) for field, domain in ENUM_DOMAINS}
_REQUIRED_WIRE = {path.rpartition(".")[2] for flat, path in FLAT_PATHS if flat in REQUIRED_FIELDS} | {
    f.name for f in EVENT.fields if isinstance(f.dataType, T.StructType)}


def _avro_type(field: T.StructField):
    if field.name in _ENUM_FIELDS:
        name, symbols = _ENUM_FIELDS[field.name]
        return {"type": "enum", "name": name, "symbols": list(symbols)}
    if field.name in ("event_timestamp", "ingestion_timestamp"):
        return {"type": "long", "logicalType": "timestamp-millis"}
    dt = field.dataType
    if isinstance(dt, T.StructType):
        return {"type": "record", "name": AVRO_RECORD_NAMES[field.name],
                "fields": [_avro_field(f) for f in dt.fields]}
    return {T.StringType: "string", T.DoubleType: "double",
            T.IntegerType: "int", T.LongType: "long"}[type(dt)]


def _avro_field(field: T.StructField) -> dict:
    t = _avro_type(field)
    if field.name in _REQUIRED_WIRE:
        out = {"name": field.name, "type": t}
        if field.name == "schema_version":
            out["default"] = DEFAULT_SCHEMA_VERSION
        return out
    return {"name": field.name, "type": ["null", t], "default": None}


def avro_schema_json() -> str:
    """The event contract as an Avro schema string, built from ``EVENT``."""
    return json.dumps({"type": "record", "name": AVRO_EVENT_RECORD,
                       "fields": [_avro_field(f) for f in EVENT.fields]})
