"""Table creation and writes (K1, K5-K8, K9 sink).

A day of a file table is never overwritten in place: Spark deletes the old
files before it writes the new ones, so a failed job would lose the day. The
new rows go to a folder of their own first, and only when that job has
committed is the day's partition switched to it in the catalog; a day without
rows switches to an empty folder or is dropped. A reader sees the old files or
the new ones, a failed run leaves the old ones, a rerun gives the same result.
Old folders stay until ``remove_unreferenced``, so running readers finish.

Appends carry a load id: loading the same id again replaces that load, so a
stream's batch and a batch job can be retried, and both write the same table.

A v2 table (Iceberg, Delta) does both in its own atomic commits. No
``coalesce(1)``: the final stage keeps its parallelism and AQE sizes the
output files.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave import schema
from clickweave.sources.tables import parse_day


def create_table(spark: SparkSession, name: str, table_schema: T.StructType,
                 partition_by: str = "event_date", location: str | None = None,
                 fmt: str = "parquet", properties: dict[str, str] | None = None) -> None:
    """K7/K8: CREATE TABLE IF NOT EXISTS from a StructType, partitioned by day."""
    loc = f"LOCATION '{location}'" if location else ""
    opts = {"compression": "snappy", **(properties or {})} if fmt == "parquet" else (properties or {})
    options = ", ".join(f"'{k}' = '{v}'" for k, v in opts.items())
    spark.sql(f"""
        CREATE TABLE IF NOT EXISTS {name} (
          {schema.ddl(table_schema)}
        )
        USING {fmt}
        PARTITIONED BY ({partition_by})
        {f'OPTIONS ({options})' if options else ''}
        {loc}
    """)


LOAD_ID = "load_id"


def create_bronze_table(spark: SparkSession, name: str, location: str | None = None, fmt: str = "parquet",
                        keep_rest: bool = False) -> None:
    """The raw table: its contract columns, by day and load; with ``keep_rest``
    a VARIANT column for what these columns leave out."""
    rest = [T.StructField(schema.REST, T.VariantType())] if keep_rest else []
    loads = T.StructType([*schema.BRONZE.fields, *rest, T.StructField(LOAD_ID, T.StringType())])
    create_table(spark, name, loads, partition_by=f"event_date, {LOAD_ID}", location=location, fmt=fmt)


REJECTS = T.StructType([
    T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType()),
    T.StructField("kafka_partition", T.IntegerType()), T.StructField("kafka_offset", T.LongType()),
    T.StructField("reason", T.StringType()), T.StructField(LOAD_ID, T.StringType()),
])


def create_rejects_table(spark: SparkSession, name: str, location: str | None = None, fmt: str = "parquet") -> None:
    """Records that were not loaded, as they came, by reason and load."""
    create_table(spark, name, REJECTS, partition_by=f"reason, {LOAD_ID}", location=location, fmt=fmt)


def create_silver_table(spark: SparkSession, name: str, location: str | None = None, fmt: str = "parquet") -> None:
    create_table(spark, name, schema.SILVER, location=location, fmt=fmt)


FILE_PROVIDERS = {"parquet", "orc", "csv", "json", "avro", "text", "hive"}


def provider(spark: SparkSession, table: str) -> str:
    """The table's provider as the catalog reports it (``parquet``, ``iceberg``...)."""
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect():
        if row[0] == "Provider":
            return str(row[1]).lower()
    return "hive"


def _detail(spark: SparkSession, table: str, name: str) -> str:
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect():
        if row[0] == name:
            return str(row[1])
    raise ValueError(f"{table} has no {name}")


# A check gets the rows as written, before they become visible, and raises to
# keep them from it.
Check = Callable[[DataFrame], None]


class NullDayError(ValueError):
    """Rows without a day have no partition to go to."""


def overwrite_day(df: DataFrame, table: str, day: str | dt.date | None,
                  partition_col: str = "event_date", rebalance: bool | None = None,
                  check: Check | None = None) -> None:
    """K5 (absorbing F7, the row-level delete): replace one day of ``table``
    with ``df``, or with ``day=None`` all days: afterwards the table holds
    ``df`` and nothing else.

    K6: instead of a single-file ``coalesce(1)``, ``rebalance`` (default: only
    for multi-day writes) adds a ``REBALANCE`` by day so each day is written
    as a few AQE-sized files instead of one file per task per day.
    """
    overwrite_days(df, table, None if day is None else [day], partition_col, rebalance, check)


def overwrite_days(df: DataFrame, table: str, days: Sequence[str | dt.date] | None,
                   partition_col: str = "event_date", rebalance: bool | None = None,
                   check: Check | None = None) -> None:
    """Replace the given days of ``table`` (None: all) with ``df``'s rows of
    these days; the others stay. ``check`` sees the new rows when they are
    written and nothing of them is visible yet; if it raises, the table keeps
    its old rows."""
    spark = df.sparkSession
    cols = spark.table(table).columns
    if days is not None:
        days = sorted({parse_day(d) for d in days})
        if not days:
            return
        df = df.where(F.col(partition_col) == F.lit(days[0]) if len(days) == 1 else F.col(partition_col).isin(days))
    df = df.select(*cols)
    if rebalance is None:
        rebalance = days is None or len(days) > 1
    if rebalance:
        df = df.hint("rebalance", partition_col)
    if provider(spark, table) not in FILE_PROVIDERS:
        # v2 tables (e.g. Iceberg, Delta): one atomic delete-matching-rows and
        # append; an empty result still empties the day.
        if check:
            check(df)
        df.writeTo(table).overwrite(F.lit(True) if days is None else F.col(partition_col).isin(days))
        return
    _switch(df, table, partition_col, {}, None if days is None else {str(d) for d in days}, check)


_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _switch(df: DataFrame, table: str, partition_col: str, fixed: dict[str, str], days: set[str] | None,
            check: Check | None = None) -> None:
    """Write ``df`` to a folder of its own and, once that job has committed and
    ``check`` has passed, point its days' partitions to it. ``fixed``: the other
    partition columns' values; days that these hold already but ``df`` lacks are
    dropped (with ``days``, only those)."""
    spark = df.sparkSession
    base = _detail(spark, table, "Location").rstrip("/")
    folder = f"{base}/{RUN_PREFIX}{uuid.uuid4().hex}"
    df = df.drop(*fixed)
    df.write.format(provider(spark, table)).partitionBy(partition_col).save(folder)
    try:
        written = {name.split("=", 1)[1] for name in _children(spark, folder) if name.startswith(f"{partition_col}=")}
        if _NULL_PARTITION in written:
            raise NullDayError(f"rows without {partition_col}: nothing of this load was added to {table}")
        if check:
            check(spark.read.format(provider(spark, table)).schema(df.schema).load(folder))
    except Exception:
        path, fs = _path(spark, folder)
        fs.delete(path, True)  # written by this call, seen by nobody
        raise
    others = "".join(f", {c} = '{v}'" for c, v in fixed.items())
    held = spark.sql(f"SHOW PARTITIONS {table}" + (f" PARTITION ({others[2:]})" if fixed else "")).collect()
    have = {part.split("=", 1)[1] for (spec,) in held for part in spec.split("/") if part.startswith(f"{partition_col}=")}

    typed = "DATE" if isinstance(spark.table(table).schema[partition_col].dataType, T.DateType) else ""

    def spec(d: str) -> str:
        return f"PARTITION ({partition_col} = {typed}'{d}'{others})"

    if new := sorted(written - have):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS "
                  + " ".join(f"{spec(d)} LOCATION '{folder}/{partition_col}={d}'" for d in new))
    for d in sorted(written & have):
        spark.sql(f"ALTER TABLE {table} {spec(d)} SET LOCATION '{folder}/{partition_col}={d}'")
    gone = have - written if days is None else days & (have - written)
    for d in sorted(gone):
        # switched to an empty folder first: dropping a managed partition
        # deletes its folder, and readers may still hold the old files
        spark.sql(f"ALTER TABLE {table} {spec(d)} SET LOCATION '{folder}/empty-{d}'")
        spark.sql(f"ALTER TABLE {table} DROP {spec(d)}")
    spark.catalog.refreshTable(table)


RUN_PREFIX = "_run-"


def remove_unreferenced(spark: SparkSession, table: str) -> list[str]:
    """Delete the run folders of ``table`` that no partition points to; run it
    when no reader or writer is at work. Returns the folders deleted."""
    base = _detail(spark, table, "Location").rstrip("/")
    used = set()
    for (spec,) in spark.sql(f"SHOW PARTITIONS {table}").collect():
        parts = ", ".join("{} = '{}'".format(*part.split("=", 1)) for part in spec.split("/"))
        for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({parts})").collect():
            if row[0] == "Location":
                used.add(str(row[1]).rstrip("/").split("/")[-2])
    out = [name for name in _children(spark, base) if name.startswith(RUN_PREFIX) and name not in used]
    for name in out:
        path, fs = _path(spark, f"{base}/{name}")
        fs.delete(path, True)
    return out


def _path(spark: SparkSession, location: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _children(spark: SparkSession, location: str) -> list[str]:
    path, fs = _path(spark, location)
    return [status.getPath().getName() for status in fs.listStatus(path)]


def append(df: DataFrame, table: str, load_id: str | None = None, partition_col: str = "event_date") -> None:
    """Add ``df`` to a raw table as one load; a load with the same id replaces
    the one before, so a retry adds nothing twice. Both the stream and the
    batch job write this way. Rows without a day raise NullDayError, and nothing
    of the load is added."""
    spark = df.sparkSession
    load = load_id or uuid.uuid4().hex
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", load):
        raise ValueError(f"a load id has letters, digits, '_', '.' and '-' only, not {load!r}")
    cols = spark.table(table).columns
    rows = df.drop(LOAD_ID).withColumn(LOAD_ID, F.lit(load)).select(*cols).hint("rebalance", partition_col)
    if provider(spark, table) not in FILE_PROVIDERS:
        rows.writeTo(table).overwrite(F.col(LOAD_ID) == F.lit(load))
        return
    _switch(rows, table, partition_col, {LOAD_ID: load}, None)


# Producer settings of the original publisher: wait for all replicas, snappy.
PRODUCER_DEFAULTS = {"kafka.acks": "all", "kafka.compression.type": "snappy"}


def write_kafka(records: DataFrame, topic: str, bootstrap_servers: str,
                options: dict[str, str] | None = None) -> None:
    """K9 sink: publish ``key``/``value`` records (batch). Needs the Kafka package.

    Records keyed by session land in one broker partition per session, so a
    session's events keep their order; ``options`` override the defaults.
    """
    writer = (records.select("key", "value").write.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("topic", topic))
    for k, v in {**PRODUCER_DEFAULTS, **(options or {})}.items():
        writer = writer.option(k, v)
    writer.save()

