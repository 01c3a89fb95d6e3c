"""Gold layer: session facts and daily KPIs over Silver rows.

Session facts
-------------
One row per session: first and last event, entry and exit page, events by kind,
revenue, and how far it came in the funnel: step k counts when an event of its
type is strictly later than the one that completed step k - 1.

Order matters there, so min and sum do not express it, and a window would bring
a whole session into one task. Instead time is cut into slices, and a slice of
a session is summarised by a *transition*: for each number of steps done before
the slice the number done after it. Transitions of neighbouring slices compose,
and within a slice only the distinct (time, step) pairs matter, which a map task
can reduce. So a session with a third of all rows is spread over its slices, and
what meets in the end is one short row per slice.

Daily KPIs
----------
Counts, bounces and revenue add up over days; distinct users do not. Each day
keeps its users as bitmaps: users are numbered once (``number_users``), and a
bitmap holds ``BITMAP`` consecutive numbers. A range of days ORs its days'
bitmaps and counts the bits: exact, from small stored rows, without the events.
Money is summed as decimals, so that sums do not depend on their order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.functions import columns
from clickweave.operators.silver import session_keys

FUNNEL = ("page_view", "add_to_cart", "checkout_complete")
SLICE_SECONDS = 600
MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(28,2)"


def money(amount: str = "order_value") -> Column:
    return F.col(amount).cast(MONEY)


def revenue() -> Column:
    """Order values of completed checkouts; other events' values are not sales."""
    return F.when(F.col("event_type") == "checkout_complete", money())


def _fold(pairs: Column, start: int) -> Column:
    """Steps done after a slice that began with ``start`` steps done; pairs
    (at, step) ascending. A step needs a time later than the last completed one,
    which lies in this slice or before it."""
    none = F.lit(None).cast("timestamp_ntz")
    end = F.aggregate(
        pairs, F.struct(F.lit(start).alias("done"), none.alias("at")),
        lambda acc, x: F.when(
            (x["step"] == acc["done"] + 1) & (acc["at"].isNull() | (x["at"] > acc["at"])),
            F.struct(x["step"].alias("done"), x["at"].alias("at"))).otherwise(acc))
    return end["done"]


def session_facts(silver: DataFrame, scope: str = "all", funnel: Sequence[str] = FUNNEL,
                  slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """One row per session of cleaned rows (``scope`` as in ``session_metrics``).

    ``funnel_step`` is the number of funnel steps done in order, ``funnel_stage``
    the name of the last one (null if none). Entry and exit page are those of
    the first and the last event; the smaller id goes first among events of one
    time. A null page of such an event stays null; rows without a session are
    left out.
    """
    keys = session_keys(scope)
    ts = F.col("event_timestamp")
    step = F.lit(None).cast("int")
    for i, name in reversed(list(enumerate(funnel, 1))):
        step = F.when(F.col("event_type") == name, F.lit(i)).otherwise(step)
    rows = silver.where("session_id IS NOT NULL").select(
        *dict.fromkeys([*keys, "event_date"]), "event_id", ts, "page_path", "event_type", "user_id", "order_value", step.alias("_step"),
        F.floor(F.unix_timestamp(ts) / slice_seconds).alias("_slice"))
    place = F.struct(ts.alias("at"), F.col("event_id").alias("id"))
    pair = F.when(F.col("_step").isNotNull(), F.struct(ts.alias("at"), F.col("_step").alias("step")))
    slices = rows.groupBy(*keys, "_slice").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("event_type") == "page_view").alias("page_views"),
        F.count(revenue()).alias("orders"),
        F.sum(revenue()).cast(MONEY_SUM).alias("revenue"),
        F.max("user_id").alias("user_id"),
        F.min(F.struct(place.alias("place"), F.col("page_path").alias("page"))).alias("first"),
        F.max(F.struct(place.alias("place"), F.col("page_path").alias("page"))).alias("last"),
        F.sort_array(F.collect_set(pair)).alias("_pairs"))
    slices = slices.withColumn("_done", F.array(*[_fold(F.col("_pairs"), i) for i in range(len(funnel) + 1)])).drop("_pairs")
    facts = slices.groupBy(*keys).agg(
        F.sum("events").alias("events"), F.sum("page_views").alias("page_views"), F.sum("orders").alias("orders"),
        F.coalesce(F.sum("revenue"), F.lit(0)).cast(MONEY_SUM).alias("revenue"), F.max("user_id").alias("user_id"),
        F.min("first").alias("first"), F.max("last").alias("last"),
        F.sort_array(F.collect_list(F.struct("_slice", "_done"))).alias("_slices"))
    done = F.aggregate("_slices", F.lit(0), lambda acc, x: F.element_at(x["_done"], acc + 1))
    out = facts.select(
        *keys, "user_id", F.to_date("first.place.at").alias("start_date"),
        F.col("first.place.at").alias("session_start"), F.col("last.place.at").alias("session_end"),
        columns.duration_secs(F.col("first.place.at"), F.col("last.place.at")).alias("duration_secs"),
        "events", "page_views", "orders", "revenue",
        F.col("first.page").alias("entry_page"), F.col("last.page").alias("exit_page"),
        (F.col("events") == 1).alias("is_bounce"), done.alias("funnel_step"))
    stage = F.lit(None).cast("string")
    for i, name in enumerate(funnel, 1):
        stage = F.when(F.col("funnel_step") == i, F.lit(name)).otherwise(stage)
    return out.withColumn("funnel_stage", stage)


# -- daily KPIs ---------------------------------------------------------------
BITMAP = 32_768          # user numbers of one bitmap (Spark's bitmap functions)
NUMBER_SHARES = 1_024    # users are numbered in so many independent shares


def number_users(users: DataFrame, known: DataFrame | None = None, shares: int = NUMBER_SHARES) -> DataFrame:
    """user_id -> user_no for all of ``users`` (user_id) and ``known`` (user_id,
    user_no): known users keep their numbers, new ones get the next free numbers
    of their share. A share's numbers are those equal to it modulo ``shares``,
    so numbers stay dense and no task sees more than a share."""
    share = F.pmod(F.xxhash64("user_id"), F.lit(shares))
    fresh = users.where("user_id IS NOT NULL").select("user_id").distinct()
    used = None
    if known is not None:
        fresh = fresh.join(known.select("user_id"), "user_id", "left_anti")
        used = known.groupBy(share.alias("_share")).agg((F.max("user_no") / shares).cast("long").alias("_used"))
    local = F.row_number().over(Window.partitionBy("_share").orderBy("user_id"))
    fresh = fresh.withColumn("_share", share).withColumn("_local", local)
    if used is None:
        return fresh.select("user_id", ((F.col("_local") - 1) * shares + F.col("_share")).alias("user_no"))
    fresh = (fresh.join(used, "_share", "left")
             .select("user_id", ((F.coalesce(F.col("_used") + 1, F.lit(0)) + F.col("_local") - 1) * shares + F.col("_share")).alias("user_no")))
    return known.select("user_id", "user_no").unionByName(fresh)


def daily_states(silver: DataFrame) -> DataFrame:
    """One row a day that adds up over days: events, sessions (of the day),
    bounces, orders, revenue. Sessions are reduced to one row before they are
    counted, so no task holds a session's or a day's rows."""
    sessions = silver.groupBy("event_date", "session_id").agg(  # a null session is one of its own
        F.count(F.lit(1)).alias("n"), F.count(revenue()).alias("orders"), F.sum(revenue()).cast(MONEY_SUM).alias("revenue"))
    return sessions.groupBy("event_date").agg(
        F.sum("n").alias("events"), F.count(F.lit(1)).alias("sessions"), F.count_if(F.col("n") == 1).alias("bounces"),
        F.sum("orders").alias("orders"), F.coalesce(F.sum("revenue"), F.lit(0)).cast(MONEY_SUM).alias("revenue"))


def daily_users(silver: DataFrame, numbers: DataFrame) -> DataFrame:
    """event_date, bucket, users: each day's users as bitmaps of their numbers."""
    seen = silver.where("user_id IS NOT NULL").select("event_date", "user_id").distinct().join(numbers, "user_id")
    no = F.col("user_no")
    return (seen.groupBy("event_date", F.bitmap_bucket_number(no).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(no)).alias("users")))


def _ratios(totals: DataFrame) -> DataFrame:
    return totals.withColumn("bounce_rate", F.round(F.col("bounces") / F.col("sessions"), 6))


def kpis_by(states: DataFrame, users: DataFrame, ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """KPIs of each range of days. ``ranges`` (event_date and the columns
    ``keys``) lists the days of every range; a day can be in many."""
    totals = states.join(ranges, "event_date").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("days"), *[F.sum(c).alias(c) for c in ("events", "sessions", "bounces", "orders")],
        F.sum("revenue").cast(MONEY_SUM).alias("revenue"))
    merged = users.join(ranges, "event_date").groupBy(*keys, "bucket").agg(F.bitmap_or_agg("users").alias("users"))
    counted = merged.groupBy(*keys).agg(F.sum(F.bitmap_count("users")).alias("users"))
    return _ratios(totals.join(counted, [*keys], "left").fillna(0, ["users"]))


def kpis_between(states: DataFrame, users: DataFrame, start: str, end: str) -> DataFrame:
    """KPIs of the days from ``start`` to ``end``, both included: one row."""
    inside = F.col("event_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    ranges = states.where(inside).select("event_date", F.lit(1).alias("_range"))
    return kpis_by(states.where(inside), users.where(inside), ranges, ["_range"]).drop("_range")


def rolling_kpis(states: DataFrame, users: DataFrame, days: int = 7) -> DataFrame:
    """KPIs of the ``days`` days up to each day with events."""
    ends = states.select(F.col("event_date").alias("range_end"))
    ranges = (ends.withColumn("event_date", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(days - 1)), lambda i: F.date_sub("range_end", i)))))
    return kpis_by(states, users, ranges, ["range_end"])
