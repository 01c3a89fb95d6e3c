"""Which days of Silver are out of date (late events, replaced loads).

A late event lands in the partition of its own day, perhaps long after Silver
was built for that day. The *ledger* keeps what each Silver day was built from:
a row for every (day, load) with the load's rows and version. Comparing it with
what the raw table holds now lists the stale days; only these are rebuilt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEDGER = T.StructType([
    T.StructField("load_id", T.StringType()), T.StructField("load_rows", T.LongType()),
    T.StructField("version", T.LongType()), T.StructField("event_date", T.DateType()),
])


def file_version() -> Column:
    """Changes when a load is replaced: its rows then lie in other files."""
    return F.xxhash64("_metadata.file_path")


def loads(bronze: DataFrame, version: Column | None = None) -> DataFrame:
    """event_date, load_id, load_rows, version of the raw table's rows. Reads no
    data column; counted per file first, so a large load does not meet in a task.
    Rows without a day or load are left out: Silver doesn't read them."""
    rows = bronze.where("event_date IS NOT NULL AND load_id IS NOT NULL")
    per_file = rows.groupBy("event_date", "load_id", (version if version is not None else F.lit(0).cast("long")).alias("_v")).agg(
        F.count(F.lit(1)).alias("n"))
    return per_file.groupBy("event_date", "load_id").agg(
        F.sum("n").alias("load_rows"), F.bit_xor("_v").alias("version"))


def stale_days(now: DataFrame, ledger: DataFrame) -> DataFrame:
    """One row for every day that is out of date: loads that are new, changed or
    gone since it was built, and rows now and then. ``now`` and ``ledger`` are
    frames of ``loads``."""
    a = now.select("event_date", "load_id", F.col("load_rows").alias("rows_now"), F.col("version").alias("version_now"))
    b = ledger.select("event_date", "load_id", F.col("load_rows").alias("rows_then"), F.col("version").alias("version_then"))
    both = a.join(b, ["event_date", "load_id"], "full")
    is_new, is_gone = F.col("rows_then").isNull(), F.col("rows_now").isNull()
    changed = (F.col("rows_now") != F.col("rows_then")) | (F.col("version_now") != F.col("version_then"))
    per_day = both.groupBy("event_date").agg(
        F.count_if(is_new).alias("new_loads"), F.count_if(is_gone).alias("gone_loads"),
        F.count_if(~is_new & ~is_gone & changed).alias("changed_loads"),
        F.coalesce(F.sum("rows_now"), F.lit(0)).alias("rows_now"), F.coalesce(F.sum("rows_then"), F.lit(0)).alias("rows_then"))
    return per_day.where("new_loads + gone_loads + changed_loads > 0")
