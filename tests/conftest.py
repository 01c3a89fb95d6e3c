from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickweave import schema  # noqa: E402
from clickweave.session import build_session, shared_dir  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("clickweave-tests", "local[*]", {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="clickweave-wh-"),
    })
    s.sparkContext.setLogLevel("ERROR")
    shared_dir(s)  # tests: no cluster folder is configured, so pick one
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="clickweave-test-")


def ts(text: str | None) -> dt.datetime | None:
    return None if text is None else dt.datetime.fromisoformat(text)


def bronze_rows(spark, rows: list[dict]):
    """A Bronze frame from partial dicts; unspecified fields get sensible values."""
    full = []
    for i, r in enumerate(rows):
        event_ts = r.get("event_timestamp", "2024-01-10 10:00:00")
        base = {
            "event_id": f"e{i}", "event_type": "page_view",
            "event_timestamp": event_ts, "ingestion_timestamp": event_ts,
            "user_id": "u1", "session_id": "s1", "anonymous_id": "a1",
            "device_type": "desktop", "os": "Windows 11", "browser": "Chrome",
            "country": "IN", "region": "R", "city": "C", "timezone": "UTC",
            "page_url": "https://x/p", "page_path": "/p", "referrer": None,
            "product_id": None, "price": None, "search_query": None,
            "scroll_depth_pct": None, "order_value": None, "source": "web",
            "schema_version": "1.0.0", "kafka_partition": 0, "kafka_offset": i,
        }
        base.update(r)
        for k in ("event_timestamp", "ingestion_timestamp"):
            base[k] = ts(base[k]) if isinstance(base[k], str) else base[k]
        if "event_date" not in r:
            base["event_date"] = base["event_timestamp"].date() if base["event_timestamp"] else None
        full.append(tuple(base[c] for c in schema.BRONZE_COLUMNS))
    return spark.createDataFrame(full, schema.BRONZE)
