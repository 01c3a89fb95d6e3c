"""Per-stage row audit of the Silver job (A4, A5).

* ``stage_counts`` -- a query: one row per (event_date, stage) with rows in,
  out and removed, computed in ONE scan. Rows are grouped by
  ``(event_date, event_id)`` with a partial aggregate (so a key with a
  third of all rows is combined on the map side); ``min_by`` picks the
  copy the dedup keeps and whether it survives the null drop.
* ``run_report`` -- the same totals for one run of the job, with the rows its
  write counted. The stages are counted beside the write, from the few columns
  they need, not by observing its frames: an observation keeps filters from
  reaching the scan, and a frame that several branches of the plan read is
  counted by each of them or, where a branch is dropped at run time, by none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave import schema

STAGES = ("read", "dedup", "null_drop", "write")


def stage_counts(bronze: DataFrame, required: Sequence[str] = schema.SILVER_REQUIRED) -> DataFrame:
    complete = F.lit(True)
    for c in required:
        complete = complete & F.col(c).isNotNull()
    order = F.struct(
        F.col("ingestion_timestamp").isNotNull(), F.col("ingestion_timestamp"),
        F.col("kafka_partition"), F.col("kafka_offset"))
    per_key = bronze.groupBy("event_date", "event_id").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min_by(complete, order).alias("winner_complete"),
    )
    per_day = per_key.groupBy("event_date").agg(
        F.sum("copies").alias("n_read"),
        F.count(F.lit(1)).alias("n_dedup"),
        F.count_if(F.col("winner_complete")).alias("n_clean"),
    )

    def stage(i: int, name: str, rows_in: str, rows_out: str):
        return F.struct(F.lit(i).alias("stage_order"), F.lit(name).alias("stage"),
                        F.col(rows_in).alias("rows_in"), F.col(rows_out).alias("rows_out"),
                        (F.col(rows_in) - F.col(rows_out)).alias("rows_removed"))

    return per_day.select("event_date", F.inline(F.array(
        stage(1, "read", "n_read", "n_read"),
        stage(2, "dedup", "n_read", "n_dedup"),
        stage(3, "null_drop", "n_dedup", "n_clean"),
        stage(4, "write", "n_clean", "n_clean"),
    )))


def _good_first_counts(bronze: DataFrame, required: Sequence[str]) -> DataFrame:
    complete = F.lit(True)
    for c in required:
        complete = complete & F.col(c).isNotNull()
    per_key = bronze.groupBy("event_date", "event_id").agg(
        F.count(F.lit(1)).alias("copies"), F.count_if(complete).alias("good"))
    return per_key.agg(F.sum("copies").alias("read"), F.sum("good").alias("null_drop"),
                       F.count_if(F.col("good") > 0).alias("dedup"))


def run_report(bronze: DataFrame, written: int, drop_nulls_first: bool = False,
               required: Sequence[str] = schema.SILVER_REQUIRED) -> list[dict]:
    """Stage, rows in, out and removed of one run over ``bronze``."""
    if drop_nulls_first:
        r = _good_first_counts(bronze, required).first()
        rows = {s: r[s] or 0 for s in ("read", "null_drop", "dedup")}
    else:
        totals = stage_counts(bronze, required).groupBy("stage").agg(F.sum("rows_out").alias("n")).collect()
        found = {r["stage"]: r["n"] for r in totals}
        rows = {s: found.get(s, 0) for s in ("read", "dedup", "null_drop")}
    out, before = [], None
    for stage, n in {**rows, "write": written}.items():
        rows_in = n if before is None else before
        out.append({"stage": stage, "rows_in": rows_in, "rows_out": n, "rows_removed": rows_in - n})
        before = n
    return out
