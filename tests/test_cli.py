"""Command-line entry points, end to end on small tables."""

from __future__ import annotations

import json
import uuid

from conftest import SF001, bronze_rows
from pyspark.sql import functions as F

from clickweave import cli
from clickweave.sinks import tables as sinks
from clickweave.plans import fixture


def test_silver_and_profile_commands(spark, capsys):
    raw, clean = f"raw_{uuid.uuid4().hex[:8]}", f"silver_{uuid.uuid4().hex[:8]}"
    sinks.create_bronze_table(spark, raw)
    sinks.append(fixture.bronze_view(spark, SF001), raw)
    assert cli.main(["silver", "--bronze", raw, "--silver", clean, "--day", "2024-01-15"]) == 0
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert [r["stage"] for r in report] == ["read", "dedup", "null_drop", "write"]
    assert spark.table(clean).where(F.col("event_date") == "2024-01-15").count() == report[-1]["rows_out"]
    assert cli.main(["profile", "--table", raw]) == 0
    out = capsys.readouterr().out
    assert "total_events" in out and "CITY_" in out
    assert cli.main(["quality", "--table", raw]) == 0
    assert "order_value_off_checkout" in capsys.readouterr().out


def test_bronze_stream_command(spark, scratch):
    import os

    from clickweave.operators import bronze

    src, table = os.path.join(scratch, "in"), f"raw_{uuid.uuid4().hex[:8]}"
    records = fixture.envelope_view(spark, SF001)
    records.select("key", "value", "topic", "partition", "offset").write.parquet(src)
    assert cli.main(["bronze", "--source", "parquet", "--path", src, "--target", table,
                     "--checkpoint", os.path.join(scratch, "ckpt"),
                     "--trigger", "availableNow"]) == 0
    assert spark.table(table).count() == bronze.transform(records).count()


def test_reports_are_complete_and_ordered(spark, capsys):
    rows = bronze_rows(spark, [{"event_timestamp": f"2024-{1 + i // 28:02d}-{1 + i % 28:02d} 10:00:00", "event_type": f"t{i % 60}"}
                               for i in range(140)])
    table = f"raw_{uuid.uuid4().hex[:8]}"
    sinks.create_bronze_table(spark, table)
    sinks.append(rows, table)
    assert cli.main(["quality", "--table", table]) == 0
    blocks = capsys.readouterr().out.split("\n\n")
    lag = [line.split("\t")[0] for line in blocks[4].strip().splitlines()[1:]]
    assert len(lag) == 140 and lag == sorted(lag)
    assert cli.main(["profile", "--table", table]) == 0
    types = capsys.readouterr().out.split("\n\n")[1].strip().splitlines()[1:]
    assert len(types) == 60


def test_publish_command_reaches_the_sink(spark, monkeypatch):
    from clickweave.sinks import tables

    table, sent = f"raw_{uuid.uuid4().hex[:8]}", []
    sinks.create_bronze_table(spark, table)
    sinks.append(fixture.bronze_view(spark, SF001), table)
    monkeypatch.setattr(tables, "write_kafka", lambda records, topic, servers: sent.append((records.count(), topic, servers)))
    assert cli.main(["publish", "--table", table, "--topic", "t", "--servers", "h:9092"]) == 0
    assert sent == [(spark.table(table).count(), "t", "h:9092")]
