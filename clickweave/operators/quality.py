"""Contract checks as aggregate queries (Q1-Q10).

Each check is a single scan with one aggregate: the per-rule counters are
computed side by side with ``count_if`` and turned into rows with
``inline``, so adding a rule never adds a pass over the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave import schema
from clickweave.functions import columns


def _rows(df: DataFrame, entries: list[Column]) -> DataFrame:
    return df.select(F.inline(F.array(*entries)))


def enum_domains(df: DataFrame) -> DataFrame:
    """Q1/Q2: null and out-of-domain values of every enum field."""
    aggs = [F.count(F.lit(1)).alias("_total")]
    for name, domain in schema.ENUM_DOMAINS:
        c = F.col(name)
        aggs.append(F.count_if(c.isNull()).alias(f"{name}__null"))
        aggs.append(F.count_if(c.isNotNull() & ~c.isin(*domain)).alias(f"{name}__invalid"))
    counts = df.agg(*aggs)
    entries = [
        F.struct(F.lit(name).alias("field"), F.lit(len(domain)).alias("domain_size"),
                 F.col(f"{name}__null").alias("null_rows"),
                 F.col(f"{name}__invalid").alias("invalid_rows"),
                 F.col("_total").alias("total_rows"))
        for name, domain in schema.ENUM_DOMAINS
    ]
    return _rows(counts, entries)


def _not_type(event_type: str) -> Column:
    return ~F.col("event_type").eqNullSafe(F.lit(event_type))


def conditional_rules() -> list[tuple[str, Column]]:
    """(rule, violation predicate) for the contract's field-level rules."""
    return [
        ("search_query_off_search", F.col("search_query").isNotNull() & _not_type("search")),
        ("scroll_depth_off_scroll", F.col("scroll_depth_pct").isNotNull() & _not_type("scroll")),
        ("scroll_depth_out_of_range",
         F.col("scroll_depth_pct").isNotNull() & ~F.col("scroll_depth_pct").between(0, 100)),
        ("order_value_off_checkout",
         F.col("order_value").isNotNull() & _not_type("checkout_complete")),
        ("browser_on_native_app",
         F.col("source").isin(*schema.NATIVE_APP_SOURCES) & F.col("browser").isNotNull()),
    ]


def conditional_fields(df: DataFrame) -> DataFrame:
    """Q3 search_query, Q4 scroll_depth_pct (and its 0-100 range), Q5
    order_value, Q7 browser: fields that may only appear on certain events."""
    rules = conditional_rules()
    counts = df.agg(F.count(F.lit(1)).alias("_total"),
                    *[F.count_if(pred).alias(name) for name, pred in rules])
    entries = [F.struct(F.lit(name).alias("rule"), F.col(name).alias("violations"),
                        F.col("_total").alias("total_rows"))
               for name, _ in rules]
    return _rows(counts, entries)


def required_fields(df: DataFrame) -> DataFrame:
    """Q6: null count of every field the contract declares mandatory."""
    counts = df.agg(F.count(F.lit(1)).alias("_total"),
                    *[F.count_if(F.col(f).isNull()).alias(f) for f in schema.REQUIRED_FIELDS])
    entries = [F.struct(F.lit(f).alias("field"), F.col(f).alias("null_rows"),
                        F.col("_total").alias("total_rows"))
               for f in schema.REQUIRED_FIELDS]
    return _rows(counts, entries)


def row_rules() -> list[tuple[str, Column]]:
    """(rule, violation predicate) of every rule on a single row (Q1-Q7); the
    place in this list is the rule's bit."""
    enums = [(f"{name}_outside_domain", F.col(name).isNotNull() & ~F.col(name).isin(*domain))
             for name, domain in schema.ENUM_DOMAINS]
    required = [(f"{name}_missing", F.col(name).isNull()) for name in schema.REQUIRED_FIELDS]
    return enums + conditional_rules() + required


def violation_mask() -> Column:
    """Bit i is set if a row breaks rule i of ``row_rules``."""
    mask = F.lit(0).cast("long")
    for i, (_, broken) in enumerate(row_rules()):
        mask = mask + F.when(broken, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))
    return mask


def row_violations(df: DataFrame) -> DataFrame:
    """The rows that break a rule, with ``violations`` (the bit mask),
    ``n_violations`` and the rules' names: one projection over one scan."""
    names = F.array(*[F.lit(name) for name, _ in row_rules()])
    broken = df.withColumn("violations", violation_mask()).where(F.col("violations") != 0)
    bit = lambda i: F.expr("shiftright(violations, {})".format(i)).bitwiseAND(F.lit(1)) == 1
    kept = F.filter(F.transform(F.arrays_zip(names.alias("name"), F.array(*[bit(i) for i in range(len(row_rules()))]).alias("set")),
                                lambda x: F.when(x["set"], x["name"])), lambda x: x.isNotNull())
    return broken.withColumns({"n_violations": F.bit_count("violations").cast("int"), "rules": F.array_join(kept, ",")})


class QualityGateError(ValueError):
    """A day broke a rule more often than allowed; it was not published."""

    def __init__(self, broken: list[tuple]):
        super().__init__("; ".join(f"{day}: {rule} in {n} of {total} rows" for day, rule, n, total in broken))
        self.broken = broken


def gate(limits: dict[str, float], default: float | None = None, day: str = "event_date"):
    """A check for ``sinks.tables``: raises QualityGateError if on any day the
    share of rows that break a rule is over its limit (``default`` for rules
    without one; None: not checked). One aggregate over the written rows; what
    comes back is one row for each failed day and rule."""
    rules = [(name, broken, limits.get(name, default)) for name, broken in row_rules()]
    unknown = set(limits) - {name for name, _, _ in rules}
    if unknown:
        raise ValueError(f"unknown rules: {sorted(unknown)}")
    rules = [r for r in rules if r[2] is not None]

    def check(rows: DataFrame) -> None:
        if not rules:
            return
        counts = rows.groupBy(day).agg(F.count(F.lit(1)).alias("_total"), *[F.count_if(b).alias(n) for n, b, _ in rules])
        failed = counts.select(day, F.inline(F.array(*[
            F.struct(F.lit(n).alias("rule"), F.col(n).alias("n"), F.col("_total").alias("total"), F.lit(float(limit)).alias("most"))
            for n, _, limit in rules]))).where(F.col("n") > F.col("most") * F.col("total"))
        broken = [tuple(r)[:4] for r in failed.orderBy(day, "rule").collect()]
        if broken:
            raise QualityGateError(broken)

    return check


def event_mix(df: DataFrame, digits: int = 6) -> DataFrame:
    """Q8: observed share of each contract event type vs. the expected weights.

    Shares are over rows whose ``event_type`` is in the contract domain.
    """
    weights = dict(schema.EVENT_TYPE_WEIGHTS)
    weight_total = float(sum(weights.values()))
    counts = df.agg(*[F.count_if(F.col("event_type") == t).alias(t) for t in schema.EVENT_TYPES])
    valid_total = sum((F.col(t) for t in schema.EVENT_TYPES), F.lit(0))
    entries = [F.struct(F.lit(t).alias("event_type"), F.col(t).alias("event_count"),
                        F.lit(weights[t] / weight_total).alias("_expected"))
               for t in schema.EVENT_TYPES]
    rows = counts.select(valid_total.alias("_valid"), F.inline(F.array(*entries)))
    actual = F.when(F.col("_valid") > 0, F.col("event_count") / F.col("_valid"))
    return rows.select(
        "event_type", "event_count",
        F.round(F.col("_expected"), digits).alias("expected_share"),
        F.round(actual, digits).alias("actual_share"),
        F.round(actual - F.col("_expected"), digits).alias("share_delta"),
    )


def ingestion_lag(df: DataFrame, limit_ms: int = schema.MAX_INGESTION_LAG_MS) -> DataFrame:
    """Q9: ingestion minus event time per day, and rows outside 0..limit."""
    lag = columns.millis_between("event_timestamp", "ingestion_timestamp")
    return (df.withColumn("_lag", lag).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("_lag").isNull()).alias("lag_missing"),
        F.min("_lag").alias("min_lag_ms"),
        F.max("_lag").alias("max_lag_ms"),
        F.round(F.avg("_lag"), 3).alias("avg_lag_ms"),
        F.count_if((F.col("_lag") < 0) | (F.col("_lag") > limit_ms)).alias("lag_out_of_range"),
    ))


def auth_share(df: DataFrame, digits: int = 6) -> DataFrame:
    """Q10: share of events from signed-in users per day, and its distance
    from the contract's stated share."""
    share = F.avg(F.col("user_id").isNotNull().cast("double"))
    return df.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("user_id").isNotNull()).alias("authenticated"),
        F.round(share, digits).alias("auth_share"),
        F.round(share - F.lit(schema.AUTHENTICATED_SHARE), digits).alias("share_delta"),
    )
