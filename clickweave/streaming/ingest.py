"""Raw-layer stream job.

``records -> bronze.transform -> raw table``. Every micro-batch is one load of
the raw table, named after the query and the batch: a batch that is run again
after a failure replaces itself, and batch jobs append to the same table by
the same rule (``sinks.tables.append``). The table may be a file table or a v2
one (Iceberg, Delta); it is created first. Empty batches are skipped (K2).
There is no log of all files for the driver to read.

``drop_replays`` takes out records that the at-least-once broker delivers
again: keyed state holds each event id for at least that long after its first
arrival, over restarts. A replay that comes later passes and is left to
Silver's dedup. Time is the batch's own time, not the event's: a late event is
never taken for an old one and lost.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickweave import schema
from clickweave.operators import bronze
from clickweave.session import shared_dir
from clickweave.sinks import tables as sinks

DEFAULT_TRIGGER = "15 minutes"


def _trigger(writer, trigger: str | None):
    if trigger is None:
        return writer
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def without_replays(rows: DataFrame, delay: str) -> DataFrame:
    """The first row of each event id, as long as its state is kept (``delay``,
    counted in batch time, which is part of the batch's log and the same when a
    batch runs again). One exchange by event id a batch; the state holds the ids
    of ``delay``, spread evenly as ids are. Which of the copies within a batch
    stays is open; they differ in the broker's and the ingestion time only."""
    return (rows.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", delay)
            .dropDuplicatesWithinWatermark(["event_id"]).drop("_arrived"))


def start_bronze_stream(
    records: DataFrame,
    table: str,
    *,
    checkpoint: str | None = None,
    trigger: str | None = DEFAULT_TRIGGER,
    payload_format: str = "json",
    floor: str = schema.DEFAULT_TIMESTAMP_FLOOR,
    query_name: str = "bronze",
    fmt: str = "parquet",
    on_batch: Callable[[int, int], None] | None = None,
    drop_replays: str | None = None,
    keep_rest: bool = False,
) -> StreamingQuery:
    """K1 append into a catalog table with K3 trigger and K4 checkpoint. The
    checkpoint and ``query_name`` belong together: both name the batches.
    ``on_batch(batch_id, rows)`` gets the rows of each batch (A4), counted by
    the batch's own write. ``drop_replays``: how long event ids are held (a
    stream's checkpoint is with or without this for good). ``keep_rest``: see
    ``plans.bronze.load_bronze``."""
    spark = records.sparkSession
    sinks.create_bronze_table(spark, table, fmt=fmt, keep_rest=keep_rest)

    def load(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        sinks.append(batch.observe(seen, F.count(F.lit(1)).alias("rows")), table, f"{query_name}-{batch_id}")
        if on_batch:
            on_batch(batch_id, int(seen.get["rows"]))

    return start_bronze_foreach_batch(
        records, load, checkpoint=checkpoint or shared_dir(spark, "streams", query_name), trigger=trigger,
        payload_format=payload_format, floor=floor, query_name=query_name, drop_replays=drop_replays,
        keep_rest=schema.REST in spark.table(table).columns)


def start_bronze_foreach_batch(
    records: DataFrame,
    write_batch: Callable[[DataFrame, int], None],
    *,
    checkpoint: str | None = None,
    trigger: str | None = DEFAULT_TRIGGER,
    payload_format: str = "json",
    floor: str = schema.DEFAULT_TIMESTAMP_FLOOR,
    query_name: str | None = None,
    drop_replays: str | None = None,
    keep_rest: bool = False,
) -> StreamingQuery:
    """K1 through a callback; K2: empty micro-batches are skipped. Exactly-once
    if the callback is idempotent per ``batch_id``."""
    spark = records.sparkSession
    ckpt = checkpoint or shared_dir(spark, "streams", query_name or "bronze-fb")
    rows = bronze.transform(records, payload_format, floor, keep_rest)
    if drop_replays:
        rows = without_replays(rows, drop_replays)

    def guarded(batch_df: DataFrame, batch_id: int) -> None:
        if drop_replays:
            # all partitions, and each whole: the state of an id is stored when
            # its partition has been read to the end. What is written is read
            # from the same rows; a lost block is computed from the old state.
            batch_df = batch_df.persist(StorageLevel.DISK_ONLY)
        try:
            if not (batch_df.count() if drop_replays else not batch_df.isEmpty()):
                return
            write_batch(batch_df, batch_id)
        finally:
            if drop_replays:
                batch_df.unpersist()

    writer = rows.writeStream.foreachBatch(guarded).option("checkpointLocation", ckpt)
    if query_name:
        writer = writer.queryName(query_name)
    return _trigger(writer, trigger).start()


def stop(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Stop after the running micro-batch (replaces the DStream-era flag)."""
    if timeout_s is not None:
        query.awaitTermination(timeout_s)
    query.stop()

