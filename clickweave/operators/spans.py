"""Sessions over midnight without recomputing whole histories.

A daily job sees one day, so the metrics of a session that goes on past
midnight are those of its part on that day. Each day's sessions are kept as
*states* (count, first and last time), which merge. Only a session with states
on several days has other metrics than its day's: its states are merged, and
its rows, and no others, get the merged values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave import schema
from clickweave.functions import columns
from clickweave.operators.silver import session_stats

STATES = T.StructType([
    T.StructField("session_id", T.StringType()), T.StructField("session_event_count", T.LongType()),
    T.StructField("session_start", schema.TS), T.StructField("session_end", schema.TS),
    T.StructField("event_date", T.DateType()),
])


def day_states(silver: DataFrame) -> DataFrame:
    """A row for each session and day (partial aggregates on the map side)."""
    return session_stats(silver.where("session_id IS NOT NULL"), ["event_date", "session_id"])


def merged(states: DataFrame) -> DataFrame:
    """The metrics of each session over all its states, and their days."""
    return states.groupBy("session_id").agg(
        F.collect_set("event_date").alias("days"), F.sum("session_event_count").alias("session_event_count"),
        F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"))


def crossing(states: DataFrame) -> DataFrame:
    """Merged metrics of the sessions with states on more than one day."""
    return merged(states).where(F.size("days") > 1).drop("days")


def carry_over(day_silver: DataFrame, values: DataFrame) -> DataFrame:
    """Rows with day metrics -> rows whose crossing sessions have the merged
    ones. A join whose large side AQE can split (a session with very many rows);
    rows of other sessions keep their values."""
    new = values.select("session_id", *[F.col(c).alias(f"_{c}") for c in ("session_event_count", "session_start", "session_end")])
    hit = F.col("_session_event_count").isNotNull()
    pick = lambda c, new: F.when(hit, new).otherwise(F.col(c))
    return day_silver.join(new, "session_id", "left").withColumns({
        "session_duration_secs": pick("session_duration_secs", columns.duration_secs("_session_start", "_session_end")),
        "is_bounce": pick("is_bounce", F.col("_session_event_count") == 1),
        "session_event_count": pick("session_event_count", F.col("_session_event_count")),
        "session_start": pick("session_start", F.col("_session_start")),
        "session_end": pick("session_end", F.col("_session_end")),
    }).select(*day_silver.columns)
