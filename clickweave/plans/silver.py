"""Silver daily job (J1, J3): read -> dedup -> null drop -> session metrics
-> enrich -> fixed column order -> atomic day rewrite.

Enrichment is row-local, so it runs after the session join and stays out of
its shuffle; the output is the same as enriching first. The plan has two
full-row exchanges (dedup key; session key, without the rows of hot sessions),
a narrow one for the pre-aggregated session stats, a bounded broadcast of the
hot sessions. The write is one action; the stage row counts come from one more,
a narrow aggregate, instead of a ``count()`` per stage.
"""

from __future__ import annotations

import datetime as dt

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clickweave import schema
from clickweave.operators import silver as ops
from clickweave.operators.audit import run_report
from clickweave.session import sized_shuffles
from clickweave.sinks import tables as sinks
from clickweave.sources.tables import for_day, parse_day, read_table, yesterday


def cleanse(bronze: DataFrame, drop_nulls_first: bool = False) -> DataFrame:
    """W1/F5/P5 then F6. By default dedup runs first, as in the original: a
    null-field earliest copy then hides a later good copy (SURVEY D2).
    ``drop_nulls_first=True`` keeps the good copy instead."""
    if drop_nulls_first:
        return ops.deduplicate(ops.drop_incomplete(bronze))
    return ops.drop_incomplete(ops.deduplicate(bronze))


def silver(bronze: DataFrame, day: str | dt.date | None = None, *,
           run_ts: str | None = None, session_scope: str = "day",
           drop_nulls_first: bool = False, rows_per_task: int = ops.ROWS_PER_TASK) -> DataFrame:
    """J3 as a frame with the 36 Silver columns in table order.

    ``day=None`` processes every day at once, equal to running the daily job
    for each day (dedup and sessions are scoped by ``event_date``).
    """
    clean = cleanse(for_day(bronze, day), drop_nulls_first)
    # Session metrics before enrichment: the enrichment columns are row-local
    # functions of columns the row already has, so deriving them after the
    # session join keeps them out of that full-row shuffle (same result).
    sessions = ops.session_metrics(clean, session_scope, rows_per_task)
    enriched = ops.enrich(sessions, run_ts)
    return enriched.select(*schema.SILVER_COLUMNS)  # P6: fixed table order


def run_silver(spark: SparkSession, bronze_source: str | DataFrame, silver_table: str,
               day: str | dt.date | None = "yesterday", fmt: str = "parquet",
               drop_nulls_first: bool = False, check: sinks.Check | None = None, **kwargs) -> list[dict]:
    """Process one day (default yesterday, UTC) into ``silver_table``.
    ``check`` (e.g. ``quality.gate``) can keep the new rows from becoming
    visible by raising.

    Returns the stage audit (read, dedup, null_drop, write) of this run.
    """
    if day == "yesterday":
        day = yesterday()
    elif day is not None:
        day = parse_day(day)
    sinks.create_silver_table(spark, silver_table, fmt=fmt)
    source = read_table(spark, bronze_source)
    write = Observation("write")  # the last node, above all branches of the plan
    out = silver(source, day, drop_nulls_first=drop_nulls_first, **kwargs).observe(
        write, F.count(F.lit(1)).alias("rows"))
    with sized_shuffles(for_day(source, day)):
        sinks.overwrite_day(out, silver_table, day, **({"check": check} if check else {}))
        return run_report(for_day(source, day), _rows(write), drop_nulls_first)


def _rows(observed: Observation) -> int:
    """Rows of an observation. If Catalyst removed the node (its input folded
    to an empty relation) the metrics are a row without fields, which PySpark
    refuses to convert: zero rows. Other errors are raised. Rows of a task
    that ran again may be counted again."""
    try:
        return int(observed.get.get("rows") or 0)
    except Py4JJavaError as error:
        if "PythonSQLUtils.toPyRow" in str(error) and "assertion failed" in str(error):
            return 0
        raise
