"""Raw job as a batch (J2 over a bounded set of records).

The stream job lives in ``clickweave.streaming.ingest``; both apply the same
pure ``operators.bronze.transform``.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave import schema
from clickweave.functions import envelope
from clickweave.operators import bronze as ops
from clickweave.sinks import tables as sinks


def bronze_batch(records: DataFrame, payload_format: str = "json",
                 floor: str = schema.DEFAULT_TIMESTAMP_FLOOR, keep_rest: bool = False) -> DataFrame:
    return ops.transform(records, payload_format, floor, keep_rest)


def load_bronze(records: DataFrame, table: str, payload_format: str = "json",
                floor: str = schema.DEFAULT_TIMESTAMP_FLOOR, load_id: str | None = None, fmt: str = "parquet",
                keep_rest: bool = False) -> None:
    """Append decoded records to the raw table (creating it if missing, with a
    ``rest`` column if ``keep_rest``); a retry with the same ``load_id`` replaces
    the load. A table that has a ``rest`` column gets it from every load."""
    spark = records.sparkSession
    sinks.create_bronze_table(spark, table, fmt=fmt, keep_rest=keep_rest)
    held = schema.REST in spark.table(table).columns
    sinks.append(bronze_batch(records, payload_format, floor, held), table, load_id)


def load_bronze_split(records: DataFrame, table: str, rejects_table: str, load_id: str, payload_format: str = "json",
                      floor: str = schema.DEFAULT_TIMESTAMP_FLOOR, fmt: str = "parquet") -> dict[str, int]:
    """Like ``load_bronze``, and the records that it leaves out go to
    ``rejects_table`` with their reason, under the same load id. The input is
    read and parsed once: both writes read the decoded records from the
    executors' disks (a lost one is decoded again). The rejects are written
    first, so a load that is visible has all its rejects beside it. Returns the
    counts; records = rows + rejected, or the load fails."""
    spark = records.sparkSession
    sinks.create_bronze_table(spark, table, fmt=fmt)
    sinks.create_rejects_table(spark, rejects_table, fmt=fmt)
    held = schema.REST in spark.table(table).columns
    decoded = envelope.decode(records, payload_format, held).persist(StorageLevel.DISK_ONLY)
    try:
        reason = ops.reject_reason(floor)
        total, bad = decoded.select(F.count(F.lit(1)), F.count(reason)).first()
        sinks.append(ops.rejects(decoded, floor), rejects_table, load_id, partition_col="reason")
        sinks.append(ops.flatten(decoded, floor), table, load_id)
    finally:
        decoded.unpersist()
    loaded = lambda t: spark.table(t).where(F.col(sinks.LOAD_ID) == load_id).count()
    counts = {"records": total, "rows": loaded(table), "rejected": loaded(rejects_table)}
    if counts["rows"] + counts["rejected"] != total or counts["rejected"] != bad:
        raise RuntimeError(f"load {load_id}: {counts} do not add up ({bad} rejected)")
    return counts
