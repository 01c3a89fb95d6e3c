"""Silver-layer operators: dedup (W1, F5, P5), null drop (F6), enrichment
(E1-E6, P4) and per-session metrics (W2-W4, E7, E8).

Every function is ``DataFrame -> DataFrame``; nothing is collected.

Scale notes
-----------
* Dedup is ``row_number() == 1`` over ``(event_date, event_id)``. Catalyst
  turns that filter into a *partial* ``WindowGroupLimit`` before the shuffle,
  so however many copies one event has, each map task ships at most one row
  per key: a replay storm cannot pile up in one reducer.
* Session metrics never route a large session through one task. Per-session
  stats are pre-aggregated (partial then final aggregate). A session is *hot*
  if it holds more than ``ROWS_PER_TASK`` rows and more than 1/``MAX_HOT`` of
  all rows: the first keeps ordinary sessions on the ordinary path at every
  size, the second bounds the hot sessions (at most ``MAX_HOT`` of them,
  whatever the data size), so their stats are broadcast with a proven bound
  and their rows are never shuffled by session. The other rows meet their
  stats in a join on the session key; a session there has at most
  max(ROWS_PER_TASK, N/MAX_HOT) rows. It is a sort-merge join, which spills.
  Rows whose session key is null meet nothing and are not shuffled either.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave import schema
from clickweave.functions import columns


def dedup_order(df: DataFrame) -> list[Column]:
    """Earliest ingestion wins; a null ingestion time sorts first (the
    original's behaviour); broker partition and offset break ties."""
    order = [F.col("ingestion_timestamp").asc_nulls_first()]
    order += [F.col(c).asc_nulls_first() for c in ("kafka_partition", "kafka_offset")
              if c in df.columns]
    return order


def deduplicate(df: DataFrame, key: str = "event_id",
                scope: Sequence[str] = ("event_date",)) -> DataFrame:
    """Keep the first copy of each ``key`` within ``scope``."""
    w = Window.partitionBy(*scope, key).orderBy(*dedup_order(df))
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") == 1)
              .drop("_rn"))


def drop_incomplete(df: DataFrame, required: Sequence[str] = schema.SILVER_REQUIRED) -> DataFrame:
    """drop rows where any required field is null.

    Written as a conjunction of ``IS NOT NULL`` (not ``dropna``, whose single
    ``AtLeastNNonNulls`` predicate cannot be split), so the conjuncts on the
    dedup window's partition keys move below the window and null-id rows never
    reach the dedup shuffle; the others stay above it, as the order demands.
    """
    cond = F.lit(True)
    for c in required:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def run_timestamp(run_ts: str | None) -> Column:
    """One timestamp for the whole run (UTC wall-clock)."""
    if run_ts is None:
        # the session-zone wall clock, converted to UTC like every event time
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())
    return F.lit(run_ts).cast(schema.TS)


def enrich(df: DataFrame, run_ts: str | None = None, home_country: str = "IN") -> DataFrame:
    """Append the calendar, geo and device columns in one projection."""
    ts = F.col("event_timestamp")
    return df.withColumns({
        "hour_of_day": columns.hour_of_day(ts),
        "day_of_week": columns.day_of_week(ts),
        "is_weekend": columns.is_weekend(ts),
        "is_indian_user": columns.is_country("country", home_country),
        "device_category": columns.device_category("device_type"),
        "processed_at": run_timestamp(run_ts),
    })


def session_keys(scope: str) -> list[str]:
    if scope == "day":
        return ["event_date", "session_id"]
    if scope == "all":
        return ["session_id"]
    raise ValueError(f"session scope must be 'day' or 'all', not {scope!r}")


# A session with more rows than this is too large for the task of its key...
ROWS_PER_TASK = 1_000_000
# ...and takes the broadcast path if it also has over 1/MAX_HOT of all rows.
MAX_HOT = 100_000

_STATS = ("session_event_count", "session_start", "session_end")


def session_stats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per session: event count, first and last event time."""
    return df.groupBy(*keys).agg(
        F.count("event_id").alias("session_event_count"),
        F.min("event_timestamp").alias("session_start"),
        F.max("event_timestamp").alias("session_end"),
    )


def session_metrics(df: DataFrame, scope: str = "day", rows_per_task: int = ROWS_PER_TASK,
                    max_hot: int = MAX_HOT, cold: str = "join") -> DataFrame:
    """W2 count, W3 start (min), W4 end (max), E7 duration, E8 bounce, per row.

    ``scope='day'`` scopes a session to one ``event_date`` (what a daily job
    sees); ``scope='all'`` lets sessions span midnight. Rows whose session
    key is null get null metrics (Silver has none after F6). ``cold`` says how
    the sessions that are not hot get their metrics: ``join`` with their
    pre-aggregated stats, or a ``window`` over the session (one exchange less,
    but a task holds the rows of a whole session and sorts them all).
    """
    keys = session_keys(scope)
    stats = session_stats(df, keys)
    total = F.coalesce(stats.agg(F.sum("session_event_count")).scalar(), F.lit(0))
    count = F.col("session_event_count")
    is_hot = (count > rows_per_task) & (count * max_hot > total)
    # fewer than max_hot rows by construction: safe to broadcast at any size
    hot = F.broadcast(stats.where(is_hot))
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    of_hot = df.join(hot, keys)
    of_cold = df.where(keyed).join(F.broadcast(stats.where(is_hot).select(*keys)), keys, "left_anti")
    if cold == "join":
        of_cold = of_cold.join(stats.where(~is_hot), keys, "left")
    elif cold == "window":
        w = Window.partitionBy(*keys)
        of_cold = of_cold.withColumns({
            "session_event_count": F.count("event_id").over(w),
            "session_start": F.min("event_timestamp").over(w),
            "session_end": F.max("event_timestamp").over(w),
        })
    else:
        raise ValueError(f"cold must be 'join' or 'window', not {cold!r}")
    of_none = df.where(~keyed).withColumns(
        {c: F.lit(None).cast(stats.schema[c].dataType) for c in _STATS})
    columns_out = [*df.columns, *_STATS]
    out = (of_hot.select(*columns_out).unionByName(of_cold.select(*columns_out))
                 .unionByName(of_none.select(*columns_out)))
    return out.withColumns({
        "session_duration_secs": columns.duration_secs("session_start", "session_end"),
        "is_bounce": F.col("session_event_count") == 1,
    })
