"""Raw stream job on a file-based stand-in for the broker."""

from __future__ import annotations

import os
import time
import uuid

from conftest import SF001
from pyspark.sql import functions as F

from clickweave.operators import bronze
from clickweave.plans import fixture
from clickweave.sources import stream
from clickweave.plans.bronze import load_bronze
from clickweave.sinks import tables as sinks
from clickweave.sources.tables import read_bronze
from clickweave.streaming import ingest


def _write_records(spark, path, df):
    df.select("key", "value", "topic", "partition", "offset").write.mode("append").parquet(path)


def _table():
    return f"raw_{uuid.uuid4().hex[:8]}"


def test_restart_and_batch_append_hold_every_row_once(spark, scratch):
    src, ckpt, table = os.path.join(scratch, "in"), os.path.join(scratch, "ckpt"), _table()
    records = fixture.envelope_view(spark, SF001)
    batches = []
    first = records.where(F.col("offset") < 400)
    _write_records(spark, src, first)

    def run():
        q = ingest.start_bronze_stream(
            stream.read_records(spark, "parquet", path=src, max_files_per_trigger=1), table,
            checkpoint=ckpt, trigger="availableNow", on_batch=lambda i, rows: batches.append(rows))
        q.awaitTermination(120)
        return spark.table(table).count()

    expected = bronze.transform(first).count()
    assert run() == expected > 0
    assert sum(batches) == expected  # A4
    assert run() == expected  # restart: nothing reprocessed
    _write_records(spark, src, records.where((F.col("offset") >= 400) & (F.col("offset") < 700)))
    run()
    late = records.where(F.col("offset") >= 700)
    for _ in range(2):  # a retried batch load replaces itself
        load_bronze(late, table, load_id="late")
    batch = bronze.transform(records)
    got = read_bronze(spark, table).select(*batch.columns)
    assert got.count() == batch.count()
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0
    location = [r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r[0] == "Location"][0]
    assert not os.path.exists(os.path.join(location.removeprefix("file:"), "_spark_metadata"))


def test_a_batch_run_again_replaces_itself(spark):
    table = _table()
    sinks.create_bronze_table(spark, table)
    rows = bronze.transform(fixture.envelope_view(spark, SF001))
    sinks.append(rows, table, "bronze-0")
    sinks.append(rows, table, "bronze-0")
    sinks.append(rows.limit(7), table, "bronze-1")
    assert spark.table(table).count() == rows.count() + 7


def test_foreach_batch_skips_empty(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    seen = []
    q = ingest.start_bronze_foreach_batch(
        stream.read_records(spark, "parquet", path=src),
        lambda df, bid: seen.append((bid, df.count())),
        checkpoint=os.path.join(scratch, "ckpt"), trigger="availableNow")
    q.awaitTermination(60)
    assert seen == []
    _write_records(spark, src, fixture.envelope_view(spark, SF001).limit(20))
    q = ingest.start_bronze_foreach_batch(
        stream.read_records(spark, "parquet", path=src),
        lambda df, bid: seen.append((bid, df.count())),
        checkpoint=os.path.join(scratch, "ckpt"), trigger="availableNow")
    q.awaitTermination(60)
    assert len(seen) == 1 and seen[0][1] > 0


def test_kafka_source_needs_settings(spark):
    import pytest

    with pytest.raises(ValueError):
        stream.read_records(spark, "kafka")


def test_limits_belong_to_their_sources(spark):
    import pytest

    with pytest.raises(ValueError):
        stream.read_records(spark, "parquet", path="/x", max_records_per_trigger=5)
    with pytest.raises(ValueError):
        stream.read_records(spark, topic="t", bootstrap_servers="h:1", max_files_per_trigger=5)


def test_default_checkpoint_under_shared_dir(spark):
    from clickweave.session import shared_dir

    base = shared_dir(spark)
    assert shared_dir(spark, "streams", "x") == os.path.join(base, "streams", "x")
    assert spark.conf.get("spark.checkpoint.dir") == base


def _replay_stream(spark, src, ckpt, table, delay):
    q = ingest.start_bronze_stream(
        stream.read_records(spark, "parquet", path=src, max_files_per_trigger=1), table,
        checkpoint=ckpt, trigger="availableNow", drop_replays=delay)
    q.awaitTermination(120)
    assert q.exception() is None
    return sorted(r[0] for r in spark.table(table).select("event_id").collect())


def test_replays_within_the_delay_are_dropped_over_a_restart(spark, scratch):
    src, ckpt, table = os.path.join(scratch, "in"), os.path.join(scratch, "ckpt"), _table()
    records = fixture.envelope_view(spark, SF001).where(F.col("offset") < fixture.REPLAY_OFFSET)
    ids = sorted(r[0] for r in bronze.transform(records).select("event_id").collect())
    assert len(ids) == len(set(ids))
    part = F.col("offset") % 3
    _write_records(spark, src, records.where(part == 0).union(records.where(part == 0)))  # within a batch
    assert _replay_stream(spark, src, ckpt, table, "1 hour") == [
        r[0] for r in bronze.transform(records.where(part == 0)).select("event_id").sort("event_id").collect()]
    # older and newer records in one batch: late events stay, replays go
    _write_records(spark, src, records.where(part < 2).repartition(1))
    _write_records(spark, src, records.repartition(1))
    assert _replay_stream(spark, src, ckpt, table, "1 hour") == ids
    assert _replay_stream(spark, src, ckpt, table, "1 hour") == ids  # nothing new


def test_replays_beyond_the_delay_pass_and_state_is_let_go(spark, scratch):
    src, ckpt, table = os.path.join(scratch, "in"), os.path.join(scratch, "ckpt"), _table()
    records = fixture.envelope_view(spark, SF001).where(F.col("offset") < fixture.REPLAY_OFFSET)
    first, other = records.where("offset BETWEEN 1 AND 40"), records.where("offset BETWEEN 41 AND 80")
    n = bronze.transform(first).count()
    _write_records(spark, src, first)
    _replay_stream(spark, src, ckpt, table, "1 second")
    time.sleep(2)
    _write_records(spark, src, other)  # moves the batch time on
    held = _replay_stream(spark, src, ckpt, table, "1 second")
    _write_records(spark, src, first)
    got = _replay_stream(spark, src, ckpt, table, "1 second")
    assert len(got) == len(held) + n and len(set(got)) == len(held)
