"""Jobs that keep Silver and Gold up to date: rebuild of stale days, sessions
over midnight, and the daily KPI states."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave import schema
from clickweave.operators import gold, maintenance, spans
from clickweave.plans.silver import silver
from clickweave.session import shared_dir, sized_shuffles
from clickweave.sinks import tables as sinks
from clickweave.sources.tables import parse_day


def _days(frame: DataFrame) -> list[dt.date]:
    """The distinct days of a frame; one value for each day."""
    return sorted(r[0] for r in frame.select("event_date").distinct().collect())


def refresh_silver(spark: SparkSession, bronze_table: str, silver_table: str, ledger_table: str,
                   fmt: str = "parquet", check: sinks.Check | None = None, **kwargs) -> list[dt.date]:
    """Rebuild the Silver days that are out of date, and no others; returns them.

    The state of the raw table is taken first. A load that arrives while the
    days are built is perhaps in them but not in the ledger, so its days are
    rebuilt once more by the next run; one that fails before the ledger is
    written leaves its days stale. Rebuilding twice gives the same rows.
    """
    sinks.create_silver_table(spark, silver_table, fmt=fmt)
    sinks.create_table(spark, ledger_table, maintenance.LEDGER, fmt=fmt)
    shared_dir(spark)  # the checkpoint folder
    bronze = spark.table(bronze_table)
    version = maintenance.file_version() if sinks.provider(spark, bronze_table) in sinks.FILE_PROVIDERS else None
    now = maintenance.loads(bronze, version).checkpoint()
    stale = _days(maintenance.stale_days(now, spark.table(ledger_table)))
    if not stale:
        return []
    source = bronze.where(F.col("event_date").isin(stale)).drop(sinks.LOAD_ID)  # prunes partitions
    with sized_shuffles(source):
        sinks.overwrite_days(silver(source, None, **kwargs), silver_table, stale, check=check)
    sinks.overwrite_days(now, ledger_table, stale)
    return stale


def merge_crossing_sessions(spark: SparkSession, silver_table: str, states_table: str, day: str | dt.date,
                            lookback_days: int | None = None, fmt: str = "parquet") -> dict:
    """After ``day`` was built: give the sessions that have rows on ``day`` and
    on other days their metrics over all of them, in every day they touch.

    Reads the day's rows for its states, the narrow states of the other days
    (``lookback_days`` around it; None: all), and only the days of Silver that
    hold a crossing session. Their rows of other sessions are copied, not
    computed. Returns the days rewritten, the rows updated and the rows copied.
    """
    day = parse_day(day)
    sinks.create_table(spark, states_table, spans.STATES, fmt=fmt)
    shared_dir(spark)
    rows = spark.table(silver_table)
    of_day = F.col("event_date") == F.lit(day)
    before = spark.table(states_table).where(of_day).select("session_id").checkpoint()
    sinks.overwrite_day(spans.day_states(rows.where(of_day)), states_table, day)
    states = spark.table(states_table)
    if lookback_days is not None:
        near = dt.timedelta(days=lookback_days)
        states = states.where(F.col("event_date").between(F.lit(day - near), F.lit(day + near)))
    # also those that the day had before, perhaps for the last time
    sessions = states.where(of_day).select("session_id").unionByName(before).distinct()
    values = (spans.merged(states.join(sessions, "session_id", "left_semi"))
              .where(F.exists("days", lambda d: d != F.lit(day))).checkpoint())
    touched = _days(values.select(F.explode("days").alias("event_date")))
    if not touched:
        return {"days": [], "rows_updated": 0, "rows_copied": 0}
    seen = Observation()
    hit = rows.where(F.col("event_date").isin(touched)).join(
        values.select("session_id", F.lit(True).alias("_hit")), "session_id", "left")
    out = spans.carry_over(hit, values.drop("days")).observe(
        seen, F.count_if("_hit").alias("updated"), F.count(F.lit(1)).alias("rows"))
    sinks.overwrite_days(out.select(*schema.SILVER_COLUMNS), silver_table, touched)
    got = seen.get
    return {"days": touched, "rows_updated": int(got["updated"]), "rows_copied": int(got["rows"] - got["updated"])}


USER_NUMBERS = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("user_no", T.LongType())])
DAILY_STATES = T.StructType([
    *[T.StructField(c, T.LongType()) for c in ("events", "sessions", "bounces", "orders")],
    T.StructField("revenue", T.DecimalType(28, 2)), T.StructField("event_date", T.DateType())])
DAILY_USERS = T.StructType([
    T.StructField("bucket", T.LongType()), T.StructField("users", T.BinaryType()), T.StructField("event_date", T.DateType())])


def update_kpis(spark: SparkSession, silver_table: str, states_table: str, users_table: str, numbers_table: str,
                days: Sequence[str | dt.date], fmt: str = "parquet") -> None:
    """Store the KPI states of ``days`` (replacing them) and number the users
    that are new. Ranges of days are then answered from the stored rows alone
    (``gold.kpis_between``)."""
    days = [parse_day(d) for d in days]
    shared_dir(spark)
    sinks.create_table(spark, states_table, DAILY_STATES, fmt=fmt)
    sinks.create_table(spark, users_table, DAILY_USERS, fmt=fmt)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {numbers_table} ({schema.ddl(USER_NUMBERS)}) USING {fmt}")
    rows = spark.table(silver_table).where(F.col("event_date").isin(days))
    known = spark.table(numbers_table)
    fresh = (gold.number_users(rows, known).join(known.select("user_id"), "user_id", "left_anti")).checkpoint()
    fresh.select("user_id", "user_no").write.insertInto(numbers_table)
    spark.catalog.refreshTable(numbers_table)
    sinks.overwrite_days(gold.daily_states(rows), states_table, days)
    sinks.overwrite_days(gold.daily_users(rows, spark.table(numbers_table)), users_table, days)

