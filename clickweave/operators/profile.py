"""Profile queries over any event table.

Each is one partial/final hash aggregate; the top-k becomes a
``TakeOrderedAndProject`` so only k rows per task reach the final merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def total(df: DataFrame) -> DataFrame:
    """A1: number of rows."""
    return df.agg(F.count(F.lit(1)).alias("total_events"))


def counts_by(df: DataFrame, column: str, name: str = "event_count") -> DataFrame:
    """Rows per value of ``column``, most frequent first (ties by value)."""
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias(name))
              .orderBy(F.desc(name), F.asc_nulls_last(column)))


def top_values(df: DataFrame, column: str, k: int = 10, name: str = "event_count") -> DataFrame:
    """The ``k`` most frequent values of ``column``."""
    return counts_by(df, column, name).limit(k)
