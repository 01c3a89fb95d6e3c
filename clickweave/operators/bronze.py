"""Raw-layer transform: decoded envelope -> flat Bronze rows.

A single Project/Filter chain with no shuffle; the same function serves a
streaming source and a batch read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave import schema
from clickweave.functions import columns, envelope


def _floor_literal(floor: str):
    return F.lit(floor).cast(schema.TS)


def flatten(decoded: DataFrame, floor: str = schema.DEFAULT_TIMESTAMP_FLOOR) -> DataFrame:
    """F1-F3 then P1-P3 on a frame with an ``event`` struct and broker columns.

    F1 drops events that failed to decode (null struct), F2 events without an
    id, F3 events at or before ``floor`` (strict ``>``; null times dropped).
    A ``rest`` column of the frame (``envelope.decode``) is kept as the last one.
    """
    # F1 as a generator: each record yields its event, or nothing when the
    # payload did not decode. Besides dropping null events, the Generate is a
    # barrier for predicate pushdown: F2/F3 below reference the generated
    # column, so Catalyst cannot inline the parser into the filter (which
    # would run it once per predicate term instead of once per row).
    # (explode of a NULL array yields no row: no lambda-based array filter.)
    more = [schema.REST] if schema.REST in decoded.columns else []
    events = decoded.select(
        "partition", "offset", *more,
        F.explode(F.when(F.col("event").isNotNull(), F.array(F.col("event")))).alias("event"))
    ev = F.col("event")
    ts = envelope.millis_to_ts(ev.getField("event_timestamp"))
    kept = events.where(ev.getField("event_id").isNotNull() & (ts > _floor_literal(floor)))
    cols = []  # P1/P2/E11: nested field access, renamed to the flat layout
    for flat, path in schema.FLAT_PATHS:
        c = F.col("event." + path)
        if flat in ("event_timestamp", "ingestion_timestamp"):
            c = envelope.millis_to_ts(c)
        cols.append(c.cast(schema.BRONZE[flat].dataType).alias(flat))
    cols += [
        columns.event_date(envelope.millis_to_ts(ev.getField("event_timestamp"))).alias("event_date"),
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("long").alias("kafka_offset"),
    ]
    return kept.select(*cols, *more)


def reject_reason(floor: str = schema.DEFAULT_TIMESTAMP_FLOOR) -> Column:
    """Why F1-F3 leave a decoded record out; null for those they keep."""
    ev = F.col("event")
    ts = envelope.millis_to_ts(ev.getField("event_timestamp"))
    return (F.when(ev.isNull() | ev.getField("event_id").isNull(), "not_decoded")
            .when(ts.isNull(), "no_event_time")
            .when(ts <= _floor_literal(floor), "before_floor"))


def rejects(decoded: DataFrame, floor: str = schema.DEFAULT_TIMESTAMP_FLOOR) -> DataFrame:
    """The records that ``flatten`` leaves out, raw, with the reason. Every
    record is in exactly one of the two."""
    return (decoded.withColumn("reason", reject_reason(floor)).where(F.col("reason").isNotNull())
            .select("key", "value", F.col("partition").cast("int").alias("kafka_partition"),
                    F.col("offset").cast("long").alias("kafka_offset"), "reason"))


def transform(records: DataFrame, payload_format: str = "json",
              floor: str = schema.DEFAULT_TIMESTAMP_FLOOR, keep_rest: bool = False) -> DataFrame:
    """J2's pure part: broker records -> Bronze rows (X1, X2, F1-F3, P1-P3),
    with ``keep_rest`` the ``rest`` of each event behind them."""
    return flatten(envelope.decode(records, payload_format, keep_rest), floor)


def apply_floor(bronze: DataFrame, floor: str = schema.DEFAULT_TIMESTAMP_FLOOR) -> DataFrame:
    """F3 on already-flat rows."""
    return bronze.where(F.col("event_timestamp") > _floor_literal(floor))
