"""Batch scans of the raw and cleansed tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_day(day: str | dt.date) -> dt.date:
    """Validate a processing date before it reaches any plan."""
    if isinstance(day, dt.datetime):
        return day.date()
    if isinstance(day, dt.date):
        return day
    return dt.date.fromisoformat(str(day))


def yesterday(today: dt.date | None = None) -> dt.date:
    return (today or dt.datetime.now(dt.timezone.utc).date()) - dt.timedelta(days=1)


def read_table(spark: SparkSession, source: str | DataFrame, fmt: str = "parquet") -> DataFrame:
    """A catalog table name, a path, or an existing frame."""
    if isinstance(source, DataFrame):
        return source
    if "/" in source or source.startswith("file:"):
        return spark.read.format(fmt).load(source)
    return spark.table(source)


def for_day(df: DataFrame, day: str | dt.date | None) -> DataFrame:
    """keep one ``event_date`` with a typed DATE literal.

    On a table partitioned by ``event_date`` this lands in
    ``PartitionFilters``: only that day's files are listed and read. With
    ``day=None`` every dated row is kept (a backfill of all days).
    """
    if day is None:
        return df.where(F.col("event_date").isNotNull())
    return df.where(F.col("event_date") == F.lit(parse_day(day)))


def read_bronze(spark: SparkSession, source: str | DataFrame,
                day: str | dt.date | None = None) -> DataFrame:
    """The raw table, optionally one day of it; the load id is left out."""
    return for_day(read_table(spark, source), day).drop("load_id")
