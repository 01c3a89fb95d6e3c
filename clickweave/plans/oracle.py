"""DuckDB twins of the registered queries (correctness oracle).

Each string is self-contained SQL over the pre-registered ``events`` view.
``BRONZE_CTE`` is the SQL form of ``clickweave.plans.fixture``; the
per-query SQL restates the Spark semantics independently (window dedup with
``NULLS FIRST``, ``dayname``, Sunday = 0 in ``dayofweek``, ``date_diff``
counting second boundaries).
"""

from __future__ import annotations

from clickweave import schema
from clickweave.plans.catalog import LATE_FLOOR, RUN_TS, SAMPLE_DAY

BRONZE_CTE = """
src AS (
  SELECT e.event_id AS id, e.user_id AS uid, e.ts, e.value,
         CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k,
         CASE WHEN e.event_id % 89 = 0 THEN NULL
              WHEN e.event_id % 227 = 0 THEN 'hover'
              WHEN e.event_type = 'view' THEN
                   CASE e.event_id % 3 WHEN 0 THEN 'page_view' WHEN 1 THEN 'scroll' ELSE 'search' END
              WHEN e.event_type = 'purchase' THEN 'checkout_complete'
              WHEN e.event_type = 'signup' THEN 'login'
              WHEN e.event_type = 'click' THEN
                   CASE WHEN e.event_id % 2 = 1 THEN 'add_to_cart' ELSE 'click' END
              WHEN e.event_type = 'error' THEN 'error' END AS etype,
         CASE WHEN e.event_id % 233 = 0 THEN 'fridge'
              WHEN e.event_id % 20 < 10 THEN 'desktop'
              WHEN e.event_id % 20 < 17 THEN 'mobile'
              WHEN e.event_id % 20 < 19 THEN 'tablet'
              ELSE 'smart_tv' END AS dtype,
         CAST(e.user_id AS VARCHAR) || '-' ||
           CAST((epoch_us(e.ts) // 1000000 + 10800) // 43200 AS VARCHAR) AS sess
  FROM events e
),
copies AS (
  SELECT src.*, 0 AS copy FROM src
  UNION ALL
  SELECT src.*, 1 AS copy FROM src WHERE id % 20 = 0
),
bronze_id AS (
  SELECT id,
    CAST(id AS VARCHAR) AS event_id,
    etype AS event_type,
    ts AS event_timestamp,
    CASE WHEN copy = 0 THEN ts + INTERVAL 2 SECOND
         WHEN id % 60 = 0 THEN NULL
         WHEN id % 40 = 0 THEN ts + INTERVAL 2 SECOND
         ELSE ts + INTERVAL 2 SECOND + INTERVAL 1 HOUR END AS ingestion_timestamp,
    CASE WHEN id % 10 < 7 THEN CAST(uid AS VARCHAR) END AS user_id,
    CASE WHEN copy = 1 OR id % 97 <> 0 THEN sess END AS session_id,
    CAST(uid AS VARCHAR) AS anonymous_id,
    dtype AS device_type,
    CASE WHEN dtype = 'mobile' THEN 'Android 14' ELSE 'Windows 11' END AS os,
    CASE WHEN dtype <> 'mobile' OR id % 229 = 0 THEN 'Chrome' END AS browser,
    CASE uid % 5 WHEN 0 THEN 'IN' WHEN 1 THEN 'US' WHEN 2 THEN 'GB' WHEN 3 THEN 'SG' END AS country,
    'REGION_' || CAST(uid % 5 AS VARCHAR) AS region,
    'CITY_' || CAST(uid % 25 AS VARCHAR) AS city,
    'UTC' AS timezone,
    'https://shop.example.com/p/' || CAST(uid % 12 AS VARCHAR) AS page_url,
    '/p/' || CAST(uid % 12 AS VARCHAR) AS page_path,
    CASE WHEN id % 10 >= 3 THEN 'https://shop.example.com/' END AS referrer,
    CASE WHEN etype IN ('click', 'add_to_cart')
         THEN 'P' || lpad(CAST(id % 8 + 1 AS VARCHAR), 3, '0') END AS product_id,
    CASE WHEN etype IN ('click', 'add_to_cart') THEN value END AS price,
    CASE WHEN etype = 'search' THEN 'q' || CAST(k AS VARCHAR) END AS search_query,
    CAST(CASE WHEN id % 223 = 0 THEN 150 WHEN etype = 'scroll' THEN k END AS INTEGER)
      AS scroll_depth_pct,
    CASE WHEN etype = 'checkout_complete' OR id % 211 = 0 THEN value END AS order_value,
    CASE WHEN dtype = 'mobile' THEN CASE WHEN id % 2 = 0 THEN 'ios' ELSE 'android' END
         ELSE 'web' END AS source,
    '1.0.0' AS schema_version,
    CAST(ts AS DATE) AS event_date,
    CAST(uid % 4 AS INTEGER) AS kafka_partition,
    id + copy * 1000000000 AS kafka_offset
  FROM copies
),
bronze AS (SELECT * EXCLUDE (id) FROM bronze_id)
"""

_REQUIRED = " AND ".join(f"{c} IS NOT NULL" for c in schema.SILVER_REQUIRED)

SILVER_CTE = BRONZE_CTE + f""",
dated AS (SELECT * FROM bronze WHERE event_date IS NOT NULL),
ranked AS (
  SELECT *, row_number() OVER (
      PARTITION BY event_date, event_id
      ORDER BY ingestion_timestamp ASC NULLS FIRST, kafka_partition ASC NULLS FIRST,
               kafka_offset ASC NULLS FIRST) AS rn
  FROM dated
),
dedup AS (SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1),
clean AS (SELECT * FROM dedup WHERE {_REQUIRED}),
good_first AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
        PARTITION BY event_date, event_id
        ORDER BY ingestion_timestamp ASC NULLS FIRST, kafka_partition ASC NULLS FIRST,
                 kafka_offset ASC NULLS FIRST) AS rn
    FROM dated WHERE {_REQUIRED}) WHERE rn = 1
),
enriched AS (
  SELECT *,
    CAST(hour(event_timestamp) AS INTEGER) AS hour_of_day,
    dayname(event_timestamp) AS day_of_week,
    dayofweek(event_timestamp) IN (0, 6) AS is_weekend,
    country = 'IN' AS is_indian_user,
    CASE device_type WHEN 'mobile' THEN 'mobile' WHEN 'tablet' THEN 'tablet'
         ELSE 'desktop' END AS device_category,
    TIMESTAMP '{RUN_TS}' AS processed_at
  FROM clean
)"""


def _sessions(partition: str, source: str = "enriched") -> str:
    return f"""
  SELECT *,
    date_diff('second', session_start, session_end) AS session_duration_secs,
    session_event_count = 1 AS is_bounce
  FROM (
    SELECT *,
      count(event_id) OVER (PARTITION BY {partition}) AS session_event_count,
      min(event_timestamp) OVER (PARTITION BY {partition}) AS session_start,
      max(event_timestamp) OVER (PARTITION BY {partition}) AS session_end
    FROM {source})"""


_SESSION_OUT = ("event_id, session_id, event_date, session_event_count, "
                "session_duration_secs, is_bounce, session_start, session_end")
_SILVER_OUT = ", ".join(schema.SILVER_COLUMNS)
_BRONZE_OUT = ", ".join(schema.BRONZE_COLUMNS)


def _with(cte: str, body: str) -> str:
    return f"WITH {cte}\n{body}"


def _ms(col: str) -> str:
    return f"date_trunc('millisecond', {col})"


_CORRUPT = "id % 101 IN (0, 1)"

_TIMES = ("event_timestamp", "ingestion_timestamp")
_DECODED = ",\n  ".join(
    f"CASE WHEN {_CORRUPT} THEN NULL ELSE {_ms(flat) if flat in _TIMES else flat} END AS {flat}"
    for flat, _ in schema.FLAT_PATHS)
_DECODE = _with(BRONZE_CTE, f"""
SELECT kafka_partition, kafka_offset,
  NOT ({_CORRUPT}) AS decoded,
  {_DECODED}
FROM bronze_id""")

_ENCODED = ", ".join(
    f"epoch_us({flat}) // 1000 AS {flat}_ms" if flat in _TIMES else flat for flat, _ in schema.FLAT_PATHS)
_ENCODE = _with(BRONZE_CTE, f"""
SELECT kafka_offset, session_id AS key, '0000000001' AS header_hex,
  {_ENCODED}
FROM bronze_id""")

_FLAT_COLS = ", ".join(
    _ms(c) + f" AS {c}" if c in ("event_timestamp", "ingestion_timestamp") else c
    for c in schema.BRONZE_COLUMNS)

_FLATTEN = _with(BRONZE_CTE, f"""
SELECT {_FLAT_COLS}
FROM bronze_id
WHERE NOT ({_CORRUPT})
  AND {_ms('event_timestamp')} > TIMESTAMP '{schema.DEFAULT_TIMESTAMP_FLOOR}'""")


def _union(rows: list[str]) -> str:
    return "\nUNION ALL\n".join(rows)


_ENUMS = _with(BRONZE_CTE, _union([
    f"""SELECT '{name}' AS field, {len(domain)} AS domain_size,
  count(*) FILTER (WHERE {name} IS NULL) AS null_rows,
  count(*) FILTER (WHERE {name} IS NOT NULL AND {name} NOT IN ({", ".join(f"'{v}'" for v in domain)})) AS invalid_rows,
  count(*) AS total_rows
FROM bronze""" for name, domain in schema.ENUM_DOMAINS]))

_COND_RULES = (
    ("search_query_off_search", "search_query IS NOT NULL AND event_type IS DISTINCT FROM 'search'"),
    ("scroll_depth_off_scroll", "scroll_depth_pct IS NOT NULL AND event_type IS DISTINCT FROM 'scroll'"),
    ("scroll_depth_out_of_range", "scroll_depth_pct IS NOT NULL AND NOT (scroll_depth_pct BETWEEN 0 AND 100)"),
    ("order_value_off_checkout",
     "order_value IS NOT NULL AND event_type IS DISTINCT FROM 'checkout_complete'"),
    ("browser_on_native_app", "source IN ('ios', 'android') AND browser IS NOT NULL"),
)

_CONDITIONAL = _with(BRONZE_CTE, _union([
    f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {pred}) AS violations, "
    f"count(*) AS total_rows FROM bronze" for name, pred in _COND_RULES]))

_REQUIRED_Q = _with(BRONZE_CTE, _union([
    f"SELECT '{f}' AS field, count(*) FILTER (WHERE {f} IS NULL) AS null_rows, "
    f"count(*) AS total_rows FROM bronze" for f in schema.REQUIRED_FIELDS]))

_WEIGHT_TOTAL = float(sum(w for _, w in schema.EVENT_TYPE_WEIGHTS))
_WEIGHTS_VALUES = ", ".join(f"('{t}', {w})" for t, w in schema.EVENT_TYPE_WEIGHTS)

_EVENT_MIX = _with(BRONZE_CTE + f""",
expected(event_type, weight) AS (VALUES {_WEIGHTS_VALUES}),
counts AS (
  SELECT x.event_type, count(b.event_type) AS event_count
  FROM expected x LEFT JOIN bronze b ON b.event_type = x.event_type
  GROUP BY x.event_type
),
tot AS (SELECT sum(event_count) AS valid FROM counts)""", f"""
SELECT c.event_type, c.event_count,
  round(x.weight / {_WEIGHT_TOTAL}, 6) AS expected_share,
  round(CAST(c.event_count AS DOUBLE) / tot.valid, 6) AS actual_share,
  round(CAST(c.event_count AS DOUBLE) / tot.valid - x.weight / {_WEIGHT_TOTAL}, 6) AS share_delta
FROM counts c JOIN expected x USING (event_type) CROSS JOIN tot""")

_LAG = ("CAST(trunc((epoch_us(ingestion_timestamp) - epoch_us(event_timestamp)) / 1000) "
        "AS BIGINT)")

_INGESTION_LAG = _with(BRONZE_CTE, f"""
SELECT event_date, count(*) AS events,
  count(*) FILTER (WHERE lag IS NULL) AS lag_missing,
  min(lag) AS min_lag_ms, max(lag) AS max_lag_ms,
  round(avg(lag), 3) AS avg_lag_ms,
  count(*) FILTER (WHERE lag < 0 OR lag > {schema.MAX_INGESTION_LAG_MS}) AS lag_out_of_range
FROM (SELECT event_date, {_LAG} AS lag FROM bronze)
GROUP BY event_date""")

_AUTH = _with(BRONZE_CTE, f"""
SELECT event_date, count(*) AS events,
  count(user_id) AS authenticated,
  round(avg(CASE WHEN user_id IS NOT NULL THEN 1.0 ELSE 0.0 END), 6) AS auth_share,
  round(avg(CASE WHEN user_id IS NOT NULL THEN 1.0 ELSE 0.0 END) - {schema.AUTHENTICATED_SHARE}, 6)
    AS share_delta
FROM bronze GROUP BY event_date""")

_AUDIT = _with(SILVER_CTE + f""",
per_day AS (
  SELECT event_date, count(*) AS n_read,
    count(*) FILTER (WHERE rn = 1) AS n_dedup,
    count(*) FILTER (WHERE rn = 1 AND {_REQUIRED}) AS n_clean
  FROM ranked GROUP BY event_date
)""", _union([
    f"SELECT event_date, {i} AS stage_order, '{name}' AS stage, CAST({a} AS BIGINT) AS rows_in, "
    f"CAST({b} AS BIGINT) AS rows_out, CAST({a} - {b} AS BIGINT) AS rows_removed FROM per_day"
    for i, name, a, b in ((1, "read", "n_read", "n_read"), (2, "dedup", "n_read", "n_dedup"),
                          (3, "null_drop", "n_dedup", "n_clean"),
                          (4, "write", "n_clean", "n_clean"))]))

_SESSION_FACTS = _with(SILVER_CTE + """,
s1 AS (SELECT session_id, min(event_timestamp) AS t1 FROM clean WHERE event_type = 'page_view' GROUP BY 1),
s2 AS (SELECT c.session_id, min(c.event_timestamp) AS t2 FROM clean c JOIN s1 USING (session_id)
       WHERE c.event_type = 'add_to_cart' AND c.event_timestamp > t1 GROUP BY 1),
s3 AS (SELECT c.session_id, min(c.event_timestamp) AS t3 FROM clean c JOIN s2 USING (session_id)
       WHERE c.event_type = 'checkout_complete' AND c.event_timestamp > t2 GROUP BY 1),
ordered AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY event_timestamp, event_id) AS up,
                   row_number() OVER (PARTITION BY session_id ORDER BY event_timestamp DESC, event_id DESC) AS down FROM clean),
facts AS (
  SELECT session_id, max(user_id) AS user_id, min(event_timestamp) AS session_start, max(event_timestamp) AS session_end,
    count(*) AS events, count(*) FILTER (WHERE event_type = 'page_view') AS page_views,
    count(*) FILTER (WHERE event_type = 'checkout_complete' AND order_value IS NOT NULL) AS orders,
    coalesce(sum(CAST(order_value AS DECIMAL(18,2))) FILTER (WHERE event_type = 'checkout_complete'), 0) AS revenue,
    max(page_path) FILTER (WHERE up = 1) AS entry_page, max(page_path) FILTER (WHERE down = 1) AS exit_page
  FROM ordered GROUP BY session_id)""", """
SELECT f.session_id, user_id, CAST(session_start AS DATE) AS start_date, session_start, session_end,
  date_diff('second', session_start, session_end) AS duration_secs, events, page_views, orders,
  CAST(revenue AS DECIMAL(28,2)) AS revenue, entry_page, exit_page, events = 1 AS is_bounce,
  CAST(CASE WHEN t3 IS NOT NULL THEN 3 WHEN t2 IS NOT NULL THEN 2 WHEN t1 IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS funnel_step,
  CASE WHEN t3 IS NOT NULL THEN 'checkout_complete' WHEN t2 IS NOT NULL THEN 'add_to_cart'
       WHEN t1 IS NOT NULL THEN 'page_view' END AS funnel_stage
FROM facts f LEFT JOIN s1 USING (session_id) LEFT JOIN s2 USING (session_id) LEFT JOIN s3 USING (session_id)""")


_VERSIONS = _with(BRONZE_CTE, """
SELECT kafka_offset, schema_id, decode_status,
  CASE WHEN ok THEN event_id END AS event_id, CASE WHEN ok THEN event_type END AS event_type,
  CASE WHEN ok THEN os END AS os, CASE WHEN ok THEN price END AS price,
  CASE WHEN ok THEN CAST(scroll_depth_pct AS BIGINT) * CASE WHEN schema_id = 2 THEN 10000000000 ELSE 1 END END AS scroll_depth_pct,
  CASE WHEN ok AND schema_id = 2 THEN 'x' || CAST(id % 5 AS VARCHAR) END AS experiment
FROM (
  SELECT *, decode_status = 'ok' AS ok FROM (
    SELECT *, CASE WHEN schema_id IS NULL THEN 'no_header' WHEN schema_id = 9 THEN 'unknown_schema'
                   WHEN id % 101 = 0 THEN 'corrupt' ELSE 'ok' END AS decode_status
    FROM (SELECT *, CAST(CASE WHEN id % 103 = 0 THEN NULL WHEN id % 31 = 0 THEN 9 WHEN id % 3 = 0 THEN 2 ELSE 1 END AS BIGINT)
                      AS schema_id FROM bronze_id)))""")

_REJECTS = _with(BRONZE_CTE, f"""
SELECT session_id AS key, kafka_partition, kafka_offset,
  CASE WHEN {_CORRUPT} THEN 'not_decoded' ELSE 'before_floor' END AS reason
FROM bronze_id WHERE {_CORRUPT} OR {_ms('event_timestamp')} <= TIMESTAMP '{LATE_FLOOR}'""")

_FLOOR = f"{_ms('event_timestamp')} > TIMESTAMP '{schema.DEFAULT_TIMESTAMP_FLOOR}'"

_REST = _with(BRONZE_CTE, f"""
SELECT event_id, event_type, os, kafka_offset,
  CASE WHEN browser IS NOT NULL THEN 'v' || CAST(id % 7 AS VARCHAR) END AS browser_version,
  CASE WHEN source <> 'web' THEN 'a' || CAST(id % 4 AS VARCHAR) END AS app_version,
  CASE WHEN id % 3 <> 0 THEN '1080x' || CAST(id % 5 AS VARCHAR) END AS screen_resolution,
  '10.0.0.' || CAST(id % 250 AS VARCHAR) AS ip_address,
  'T' || anonymous_id AS title,
  'N' || product_id AS product_name,
  CASE WHEN product_id IS NOT NULL THEN 'C' || CAST(id % 3 AS VARCHAR) END AS category,
  CASE WHEN event_type = 'click' THEN 'b' || CAST(id % 6 AS VARCHAR) END AS click_element,
  CASE WHEN event_type = 'error' THEN 'E' || CAST(id % 9 AS VARCHAR) END AS error_message,
  CASE WHEN id % 2 = 0 THEN CAST(id % 5 AS BIGINT) END AS arm,
  CAST(NULL AS VARCHAR) AS os_again
FROM bronze_id WHERE {_FLOOR}""")

_REPLAYS = _with(BRONZE_CTE, f"""
SELECT DISTINCT event_id, event_type, {_ms('event_timestamp')} AS event_timestamp, device_type, city, price, order_value, event_date
FROM bronze_id WHERE NOT ({_CORRUPT}) AND {_FLOOR}""")

_LOADS = BRONZE_CTE + """,
now AS (SELECT event_date, CASE WHEN kafka_offset >= 1000000000 THEN 'late-' ELSE 'load-' END || CAST(kafka_partition AS VARCHAR) AS load_id,
               count(*) AS n FROM bronze WHERE event_date IS NOT NULL GROUP BY ALL),
ledger AS (SELECT event_date, load_id, n + CASE WHEN dayname(event_date) = 'Monday' AND load_id = 'load-2' THEN 1 ELSE 0 END AS n
           FROM now WHERE load_id NOT IN ('late-1', 'late-2', 'late-3'))"""
_STALE = _with(_LOADS, """
SELECT event_date, count(*) FILTER (WHERE b.n IS NULL) AS new_loads, count(*) FILTER (WHERE a.n IS NULL) AS gone_loads,
  count(*) FILTER (WHERE a.n <> b.n) AS changed_loads, CAST(coalesce(sum(a.n), 0) AS BIGINT) AS rows_now,
  CAST(coalesce(sum(b.n), 0) AS BIGINT) AS rows_then
FROM now a FULL JOIN ledger b USING (event_date, load_id) GROUP BY event_date
HAVING count(*) FILTER (WHERE a.n IS DISTINCT FROM b.n) > 0""")

_ROW_RULES = ([(f"{name}_outside_domain", f"{name} IS NOT NULL AND {name} NOT IN ({', '.join(repr(v) for v in domain)})")
               for name, domain in schema.ENUM_DOMAINS] + list(_COND_RULES)
              + [(f"{f}_missing", f"{f} IS NULL") for f in schema.REQUIRED_FIELDS])
_BITS = ", ".join(f"CASE WHEN {pred} THEN {1 << i} ELSE 0 END AS b{i}" for i, (_, pred) in enumerate(_ROW_RULES))
_MASK = " + ".join(f"b{i}" for i in range(len(_ROW_RULES)))
_NAMES = "concat_ws(',', " + ", ".join(f"CASE WHEN b{i} > 0 THEN '{name}' END" for i, (name, _) in enumerate(_ROW_RULES)) + ")"
_VIOLATIONS = _with(BRONZE_CTE, f"""
SELECT event_id, kafka_offset, CAST({_MASK} AS BIGINT) AS violations, CAST(bit_count(CAST({_MASK} AS BIGINT)) AS INTEGER) AS n_violations,
  {_NAMES} AS rules FROM (SELECT *, {_BITS} FROM bronze) WHERE {_MASK} > 0""")


def _kpis(days: int) -> str:
    return _with(SILVER_CTE + f""",
ends AS (SELECT DISTINCT event_date AS range_end FROM clean),
inside AS (SELECT range_end, clean.* FROM ends JOIN clean
           ON event_date <= range_end AND event_date > range_end - INTERVAL {days} DAY),
sess AS (SELECT range_end, event_date, session_id, count(*) AS n FROM inside GROUP BY ALL),
per AS (SELECT range_end, count(*) AS sessions, count(*) FILTER (WHERE n = 1) AS bounces FROM sess GROUP BY 1)""", """
SELECT range_end, count(DISTINCT event_date) AS days, count(*) AS events, any_value(sessions) AS sessions,
  any_value(bounces) AS bounces,
  count(*) FILTER (WHERE event_type = 'checkout_complete' AND order_value IS NOT NULL) AS orders,
  CAST(coalesce(sum(CAST(order_value AS DECIMAL(18,2))) FILTER (WHERE event_type = 'checkout_complete'), 0)
       AS DECIMAL(28,2)) AS revenue,
  count(DISTINCT user_id) AS users, round(CAST(any_value(bounces) AS DOUBLE) / any_value(sessions), 6) AS bounce_rate
FROM inside JOIN per USING (range_end) GROUP BY range_end""")


ORACLE_SQL: dict[str, str] = {
    "bronze_all": _with(BRONZE_CTE, f"SELECT {_BRONZE_OUT} FROM bronze"),
    "bronze_day": _with(BRONZE_CTE, f"SELECT {_BRONZE_OUT} FROM bronze "
                                    f"WHERE event_date = DATE '{SAMPLE_DAY}'"),
    "bronze_floor": _with(BRONZE_CTE, f"SELECT {_BRONZE_OUT} FROM bronze "
                                      f"WHERE event_timestamp > TIMESTAMP '{LATE_FLOOR}'"),
    "decode_envelope": _DECODE,
    "encode_envelope": _ENCODE,
    "bronze_flatten": _FLATTEN,
    "silver_dedup": _with(SILVER_CTE, f"SELECT {_BRONZE_OUT} FROM dedup"),
    "silver_not_null": _with(SILVER_CTE, f"SELECT {_BRONZE_OUT} FROM clean"),
    "silver_keep_good_copy": _with(SILVER_CTE, f"SELECT {_BRONZE_OUT} FROM good_first"),
    "silver_enrich": _with(SILVER_CTE, "SELECT * FROM enriched"),
    "silver_sessions": _with(SILVER_CTE, f"SELECT {_SESSION_OUT} FROM ("
                                         f"{_sessions('event_date, session_id')})"),
    "silver_sessions_window": _with(SILVER_CTE, f"SELECT {_SESSION_OUT} FROM ("
                                                f"{_sessions('event_date, session_id')})"),
    "silver_sessions_mixed": _with(SILVER_CTE, f"SELECT {_SESSION_OUT} FROM ("
                                               f"{_sessions('event_date, session_id')})"),
    "silver_sessions_span_mixed": _with(SILVER_CTE, f"SELECT {_SESSION_OUT} FROM ("
                                                    f"{_sessions('session_id')})"),
    "silver_sessions_span": _with(SILVER_CTE, f"SELECT {_SESSION_OUT} FROM ("
                                              f"{_sessions('session_id')})"),
    "silver_full": _with(SILVER_CTE, f"SELECT {_SILVER_OUT} FROM ("
                                     f"{_sessions('event_date, session_id')})"),
    "silver_day": _with(SILVER_CTE, f"SELECT {_SILVER_OUT} FROM ("
                                    f"{_sessions('event_date, session_id')}) "
                                    f"WHERE event_date = DATE '{SAMPLE_DAY}'"),
    "silver_day_mixed": _with(SILVER_CTE, f"SELECT {_SILVER_OUT} FROM ("
                                          f"{_sessions('event_date, session_id')}) "
                                          f"WHERE event_date = DATE '{SAMPLE_DAY}'"),
    "silver_audit": _AUDIT,
    "profile_total": _with(BRONZE_CTE, "SELECT count(*) AS total_events FROM bronze"),
    "profile_event_types": _with(BRONZE_CTE, "SELECT event_type, count(*) AS event_count "
                                             "FROM bronze GROUP BY event_type"),
    "profile_top_cities": _with(BRONZE_CTE, "SELECT city, count(*) AS event_count FROM bronze "
                                            "GROUP BY city ORDER BY event_count DESC, "
                                            "city ASC NULLS LAST LIMIT 10"),
    "dq_enum_domains": _ENUMS,
    "dq_conditional_fields": _CONDITIONAL,
    "dq_required_fields": _REQUIRED_Q,
    "event_mix": _EVENT_MIX,
    "ingestion_lag": _INGESTION_LAG,
    "auth_share": _AUTH,
    "session_facts": _SESSION_FACTS,
    "silver_sessions_carry": _with(SILVER_CTE, f"SELECT {_SESSION_OUT} FROM ({_sessions('session_id')})"),
    "silver_stale_days": _STALE,
    "decode_by_schema_id": _VERSIONS,
    "bronze_rejects": _REJECTS,
    "dq_row_violations": _VIOLATIONS,
    "bronze_rest": _REST,
    "stream_without_replays": _REPLAYS,
    "daily_kpis": _kpis(1),
    "weekly_kpis": _kpis(7),
}
