"""Wire envelope: 5-byte registry header + serialized event.

All of it is Spark column expressions, evaluated on the executors in the
scan's stage with no shuffle (the JSON parser itself runs interpreted, the
rest is code-generated). Two payload formats share one interface:

* ``json`` -- the event as JSON, timestamps as epoch-millis numbers (the
  contract's ``timestamp-millis``). Decoded with ``from_json``.
* ``avro`` -- the contract's Avro binary, decoded with Spark's ``from_avro``
  using the enum writer schema. Needs the spark-avro package on the
  classpath; without it Spark's own error names the missing Avro module.

A payload that does not decode *whole* yields a null event. ``from_json``
alone would return partial fields for truncated JSON (event_id included), so
the corrupt-record column is used to null the entire struct. Avro's PERMISSIVE
mode gives a struct of nulls instead. Under both formats an event without an
id counts as not decoded.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave import schema

_CORRUPT = "_corrupt_record"


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast(schema.TS)


def header(schema_id: int = 1) -> Column:
    """Magic byte 0 followed by the 4-byte big-endian schema id."""
    return F.lit(bytes([0]) + int(schema_id).to_bytes(4, "big"))


def strip_header(value: Column) -> Column:
    """X1 (E10: binary substring/length): drop the header. Payloads shorter
    than the header become empty."""
    n = schema.ENVELOPE_HEADER_BYTES
    return F.substring(value, n + 1, F.greatest(F.length(value) - n, F.lit(0)))


def millis_to_ts(col: Column) -> Column:
    return F.timestamp_add("MILLISECOND", col, _epoch())


def ts_to_millis(col: Column) -> Column:
    return F.timestamp_diff("MILLISECOND", _epoch(), col)


def parse_payload(payload: Column, payload_format: str = "json") -> Column:
    """X2, raw: binary payload -> parsed struct.

    For JSON the struct carries an extra ``_corrupt_record`` field that is set
    when the payload did not parse whole. Use ``decode`` to get the event.
    """
    if payload_format == "json":
        wire = T.StructType(schema.EVENT.fields + [T.StructField(_CORRUPT, T.StringType())])
        return F.from_json(payload.cast("string"), wire,
                           {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    if payload_format == "avro":
        try:
            from pyspark.sql.avro.functions import from_avro
        except ImportError as exc:  # pragma: no cover - depends on the build
            raise RuntimeError("Avro payloads need pyspark's avro module") from exc
        return from_avro(payload, schema.avro_schema_json(), {"mode": "PERMISSIVE"})
    raise ValueError(f"unknown payload format: {payload_format!r}")


def _event_from_parsed(parsed: Column, payload_format: str) -> Column:
    if payload_format == "json":
        return F.when(parsed.getField(_CORRUPT).isNull() & parsed.getField("event_id").isNotNull(),
                      parsed.dropFields(_CORRUPT))
    # Avro surfaces timestamp-millis as a timestamp; bring it back to millis
    # so both formats yield the same struct.
    # A record that does not parse is a struct of nulls there: no id, no event.
    return F.when(parsed.getField("event_id").isNotNull(), parsed.withField(
        "event_timestamp", F.unix_millis(parsed.getField("event_timestamp"))).withField(
        "ingestion_timestamp", F.unix_millis(parsed.getField("ingestion_timestamp"))))


def rest_of(payload: Column) -> Column:
    """What the flat layout has no column for, of a JSON payload as VARIANT:
    fields of the contract that P1 leaves out and fields that no layout knows,
    at their own paths. JSON nulls are left out; a nested record that is no
    object is kept as it is. Null if nothing is left, and if the payload is no
    JSON object, has a key twice or is beyond a VARIANT's size."""
    paths = [path.split(".") for _, path in schema.FLAT_PATHS]
    nested = {p[0]: [q[1] for q in paths if q[0] == p[0]] for p in paths if len(p) > 1}
    plain = [p[0] for p in paths if len(p) == 1]
    fields = "map<string,variant>"

    def left(of: Column, known: list[str]) -> Column:
        return F.map_filter(of, lambda k, v: ~k.isin(*known) & ~F.is_variant_null(v))

    top = F.try_variant_get(payload, "$", fields)
    out = [left(top, [*plain, *nested])]
    for name, known in nested.items():
        record = F.try_variant_get(payload, f"$.{name}", fields)
        inner = left(record, known)
        other = F.when(~F.is_variant_null(top[name]), top[name])
        value = F.when(record.isNull(), other).when(F.size(inner) > 0, F.to_variant_object(inner))
        out.append(F.create_map(F.lit(name), value))
    rest = F.map_filter(F.map_concat(*out), lambda _, v: v.isNotNull())
    return F.when(F.size(rest) > 0, F.to_variant_object(rest))


def decode(records: DataFrame, payload_format: str = "json", keep_rest: bool = False) -> DataFrame:
    """X1 + X2: envelope records -> records plus an ``event`` struct column,
    with ``keep_rest`` also a ``rest`` column (``rest_of``; JSON only, a second
    parse of each record).

    The payload is parsed once into its own column; the corrupt check and the
    later field accesses read that column, so the parser runs once per row
    (inlining the parse into every field would run it once per field).
    """
    if keep_rest and payload_format != "json":
        raise ValueError("the rest of an event is kept for JSON payloads only: Avro's layout has no unknown fields")
    parsed = records.withColumn(
        "_parsed", parse_payload(strip_header(F.col("value")), payload_format))
    out = parsed.withColumn("event", _event_from_parsed(F.col("_parsed"), payload_format)).drop("_parsed")
    if not keep_rest:
        return out
    whole = F.try_parse_json(strip_header(F.col("value")).cast("string"))
    return out.withColumn("_whole", whole).withColumn(schema.REST, rest_of(F.col("_whole"))).drop("_whole")


def schema_id(value: str | Column = "value") -> Column:
    """The registry id in the header; null if there is no header (too short, or
    another magic byte)."""
    value = F.col(value) if isinstance(value, str) else value
    number = F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("long")
    return F.when((F.length(value) >= schema.ENVELOPE_HEADER_BYTES) & (F.hex(F.substring(value, 1, 1)) == "00"), number)


def merge_layouts(layouts: Sequence[T.StructType]) -> T.StructType:
    """All fields of the layouts by name, nested ones alike; a field that is in
    several takes the type of the last."""
    fields: dict[str, T.DataType] = {}
    for layout in layouts:
        for f in layout.fields:
            have = fields.get(f.name)
            both = isinstance(have, T.StructType) and isinstance(f.dataType, T.StructType)
            fields[f.name] = merge_layouts([have, f.dataType]) if both else f.dataType
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


def conform(col: Column, source: T.StructType, target: T.StructType) -> Column:
    """A struct of layout ``source`` in layout ``target``: fields by name, cast
    where the type differs, null where the source has none."""
    have = {f.name: f.dataType for f in source.fields}
    out = []
    for f in target.fields:
        if f.name not in have:
            c = F.lit(None).cast(f.dataType)
        elif isinstance(f.dataType, T.StructType) and isinstance(have[f.name], T.StructType):
            c = conform(col.getField(f.name), have[f.name], f.dataType)
        else:
            c = col.getField(f.name).cast(f.dataType)
        out.append(c.alias(f.name))
    return F.when(col.isNotNull(), F.struct(*out))


def decode_versions(records: DataFrame, layouts: Mapping[int, T.StructType],
                    target: T.StructType | None = None) -> DataFrame:
    """X1 + X2 with the header's schema id: each JSON payload is parsed with the
    layout registered under its id and brought to one layout (``target``, by
    default all fields of all layouts in the order of their ids), so readers see
    one struct over all versions.

    Adds ``schema_id``, ``event`` and ``decode_status``: ``ok``, ``corrupt`` (a
    known layout, but the payload did not parse whole or has no id),
    ``unknown_schema``, ``no_header``. Nothing is dropped. One scan and one parse
    a record: a parser runs for the rows of its id only.
    """
    target = target or merge_layouts([layouts[i] for i in sorted(layouts)])
    out = records.withColumn("schema_id", schema_id())
    payload = strip_header(F.col("value")).cast("string")
    for i, layout in layouts.items():
        wire = T.StructType([*layout.fields, T.StructField(_CORRUPT, T.StringType())])
        parsed = F.from_json(payload, wire, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
        out = out.withColumn(f"_v{i}", F.when(F.col("schema_id") == i, parsed))
    event = F.lit(None).cast(target)
    for i, layout in layouts.items():
        p = F.col(f"_v{i}")
        whole = F.when(p.getField(_CORRUPT).isNull() & p.getField("event_id").isNotNull(), p.dropFields(_CORRUPT))
        event = F.when(F.col("schema_id") == i, conform(whole, layout, target)).otherwise(event)
    status = (F.when(F.col("schema_id").isNull(), "no_header").when(~F.col("schema_id").isin(*layouts), "unknown_schema")
              .when(F.col("event").isNull(), "corrupt").otherwise("ok"))
    return (out.withColumn("event", event).withColumn("decode_status", status)
            .drop(*[f"_v{i}" for i in layouts]))


def event_struct() -> Column:
    """Full contract struct from flat Bronze columns (inverse of P1).

    Fields the flat layout does not carry (browser_version, title, ...) are
    emitted as nulls so the struct always has the contract's exact shape.
    """
    by_path = {path: flat for flat, path in schema.FLAT_PATHS}

    def build(struct_type: T.StructType, prefix: str) -> list[Column]:
        out = []
        for f in struct_type.fields:
            path = prefix + f.name
            if isinstance(f.dataType, T.StructType):
                c = F.struct(*build(f.dataType, path + "."))
            elif path in by_path:
                c = F.col(by_path[path])
                if f.name in ("event_timestamp", "ingestion_timestamp"):
                    c = ts_to_millis(c)
            else:
                c = F.lit(None).cast(f.dataType)
            out.append(c.alias(f.name))
        return out

    return F.struct(*build(schema.EVENT, ""))


def event_json() -> Column:
    """The contract struct of the current row as JSON (timestamps as millis)."""
    return F.to_json(event_struct())


def fits_contract() -> Column:
    """Required fields present, enum fields within their domains."""
    ok = F.lit(True)
    for c in schema.REQUIRED_FIELDS:
        ok = ok & F.col(c).isNotNull()
    for c, domain in schema.ENUM_DOMAINS:
        ok = ok & (F.col(c).isNull() | F.col(c).isin(*domain))
    return ok


def encode(rows: DataFrame, schema_id: int = 1, payload_format: str = "json",
           keep: tuple[str, ...] = ()) -> DataFrame:
    """K9: flat events -> broker records keyed by session_id.

    Keying by session keeps one session's events in one broker partition,
    so their order is preserved per session.
    """
    if payload_format == "json":
        payload = event_json().cast("binary")
    elif payload_format == "avro":
        from pyspark.sql.avro.functions import to_avro

        # required fields and enum symbols are part of the writer's schema: an
        # event that breaks them cannot be written and is left out
        rows = rows.where(fits_contract())
        payload = to_avro(event_struct(), schema.avro_schema_json())
    else:
        raise ValueError(f"unknown payload format: {payload_format!r}")
    return rows.select(
        *keep,
        F.col("session_id").cast("binary").alias("key"),
        F.concat(header(schema_id), payload).alias("value"),
    )
