"""URL filter against a dated list: a temporal join.

A list entry says from which date on a pattern is blocked or allowed. Entries
of one pattern follow each other: each is valid from its date to the next
entry's (a validity interval; of entries with one date the last action in
code-point order counts). A pattern is a host name, which also matches its
subdomains, or a host and a path prefix. A capture is judged by the entries
active when it was fetched: it is looked up under its host, every parent
domain and every prefix of its path, and the most specific active entry
decides (paths before hosts, longer before shorter). Later changes of the list
do not touch earlier captures.

Native: DataFrame functions only. Only keys and dates meet the list, as an
equi-join with the interval as a condition, salted so that a host with a third
of all captures is spread; intervals of a pattern do not overlap, so a key
gives one row at most.

Defined results: a null or malformed URL has no host and is kept (action null);
a capture without a time meets no entry; entries without pattern, date or
action are ignored; host names are compared in lower case, paths as they are;
rows equal in id, URL and time are returned as often as they occur; an empty
table gives an empty result, an empty list keeps all; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.llm.common import checkpointed, read_table

SALTS = 32
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def intervals(entries: DataFrame) -> DataFrame:
    """entries (pattern, listed_on, action) -> pattern, action, valid_from,
    valid_to (null: still valid), the last not included."""
    slash = F.instr("pattern", "/")
    pattern = F.when(slash > 0, F.concat(F.lower(F.substring_index("pattern", "/", 1)), F.expr("substring(pattern, instr(pattern, '/'))"))
                     ).otherwise(F.lower("pattern"))
    days = (entries.where("pattern IS NOT NULL AND listed_on IS NOT NULL AND action IS NOT NULL")
            .select(pattern.alias("pattern"), "listed_on", "action")
            .groupBy("pattern", "listed_on").agg(F.max("action").alias("action")))
    w = Window.partitionBy("pattern").orderBy("listed_on")
    return days.select("pattern", "action", F.col("listed_on").alias("valid_from"), F.lead("listed_on").over(w).alias("valid_to"))


def keys(host: Column, path: Column) -> Column:
    """The patterns under which a capture is looked up, least specific first."""
    labels = F.split(host, r"\.")
    steps = F.filter(F.split(path, "/"), lambda s: s != "")
    n = F.size(labels)
    domains = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, n - i + 1, i), "."))
    prefixes = F.when(F.size(steps) > 0, F.transform(
        F.sequence(F.lit(1), F.size(steps)), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(steps, F.lit(1), i), "/")))
    ).otherwise(F.array().cast("array<string>"))
    return F.when(host != "", F.concat(domains, prefixes)).otherwise(F.array().cast("array<string>"))


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """captures (page_id, url, fetched_on) -> the same with host, action,
    pattern and valid_from of the deciding entry, and kept."""
    rows = (captures.select("page_id", "url", "fetched_on").groupBy("page_id", "url", "fetched_on").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("key", F.xxhash64("page_id", "url", "fetched_on"))
            .withColumn("host", host_of(F.col("url"))))
    rows = checkpointed(rows)
    path = F.regexp_extract(F.coalesce("url", F.lit("")), PATH, 1)
    looked = (rows.select("key", "fetched_on", F.posexplode(keys(F.col("host"), path)).alias("rank", "pattern"))
              .withColumn("salt", F.pmod("key", F.lit(SALTS)).cast("int")))
    listed = intervals(entries).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    active = (F.col("fetched_on") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("fetched_on") < F.col("valid_to")))
    decided = (looked.join(listed, ["pattern", "salt"]).where(active)
               .groupBy("key").agg(F.max(F.struct("rank", "pattern", "action", "valid_from")).alias("b")))
    return (rows.join(decided, "key", "left")
            .withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
            .select("page_id", "url", "fetched_on", F.when(F.col("host") != "", F.col("host")).alias("host"),
                    F.col("b.action").alias("action"), F.col("b.pattern").alias("pattern"), F.col("b.valid_from").alias("valid_from"),
                    (F.coalesce(F.col("b.action"), F.lit("allow")) != "block").alias("kept")))


def _number(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("int")


def dated_list(pages: DataFrame) -> DataFrame:
    """The query's list, derived from all hosts of the pages: hosts, parent
    domains and path prefixes are listed and delisted on dates in 2024."""
    hosts = pages.select(host_of(F.col("url")).alias("host")).where("host <> ''").distinct()
    domain = F.regexp_extract("host", r"([^.]+[.][^.]+)$", 1)
    patterns = (hosts.select(F.col("host").alias("pattern"))
                .unionByName(hosts.select(domain.alias("pattern")).where("pattern <> ''"))
                .unionByName(hosts.select(F.concat("host", F.lit("/en")).alias("pattern")))).distinct()
    x = patterns.withColumn("x", _number(F.col("pattern")))
    day = lambda shift: F.date_add(F.lit("2024-01-01").cast("date"), shift)
    return (x.where("x % 3 < 2").select("pattern", day(F.expr("x % 300")).alias("listed_on"),
                                        F.when(F.col("x") % 3 == 0, "block").otherwise("allow").alias("action"))
            .unionByName(x.where("x % 3 = 0").select("pattern", day(F.expr("x % 300 + 1 + x % 61")).alias("listed_on"), F.lit("allow").alias("action")))
            .unionByName(x.where("x % 4 = 1").select("pattern", day(F.expr("x % 300 + 62")).alias("listed_on"), F.lit("block").alias("action"))))


def op5_url_filter(spark, sf_dir):
    """All pages, fetched on the 366 days of 2024 by turns, against the list."""
    pages = read_table(spark, sf_dir, "pages")
    fetched = F.date_add(F.lit("2024-01-01").cast("date"), F.expr("CAST(page_id % 366 AS INT)"))
    return judge(pages.select("page_id", "url", fetched.alias("fetched_on")), dated_list(pages))


_HOST_SQL = f"lower(regexp_extract(coalesce(url, ''), '{HOST}', 1))"
OP5_SQL = f"""
WITH c AS (SELECT page_id, url, DATE '2024-01-01' + (page_id % 366)::INT AS fetched_on, {_HOST_SQL} AS host,
                  list_filter(string_split(regexp_extract(coalesce(url, ''), '{PATH}', 1), '/'), lambda s: s <> '') AS steps FROM pages),
hosts AS (SELECT DISTINCT host FROM c WHERE host <> ''),
p AS (SELECT host AS pattern FROM hosts UNION SELECT regexp_extract(host, '([^.]+[.][^.]+)$', 1) FROM hosts
      WHERE regexp_extract(host, '([^.]+[.][^.]+)$', 1) <> '' UNION SELECT host || '/en' FROM hosts),
x AS (SELECT pattern, ('0x' || substr(md5(pattern), 1, 6))::INT AS x FROM p),
e AS (SELECT pattern, DATE '2024-01-01' + (x % 300) AS listed_on, CASE WHEN x % 3 = 0 THEN 'block' ELSE 'allow' END AS action FROM x WHERE x % 3 < 2
      UNION ALL SELECT pattern, DATE '2024-01-01' + (x % 300 + 1 + x % 61), 'allow' FROM x WHERE x % 3 = 0
      UNION ALL SELECT pattern, DATE '2024-01-01' + (x % 300 + 62), 'block' FROM x WHERE x % 4 = 1),
d AS (SELECT pattern, listed_on, max(action) AS action FROM e GROUP BY pattern, listed_on),
v AS (SELECT pattern, action, listed_on AS valid_from, lead(listed_on) OVER (PARTITION BY pattern ORDER BY listed_on) AS valid_to FROM d),
m AS (SELECT c.page_id, v.pattern, v.action, v.valid_from
      FROM c JOIN v ON c.host = v.pattern OR ends_with(c.host, '.' || v.pattern)
        OR (c.host = split_part(v.pattern, '/', 1) AND c.steps[1] = split_part(v.pattern, '/', 2) AND contains(v.pattern, '/'))
      WHERE c.fetched_on >= v.valid_from AND (v.valid_to IS NULL OR c.fetched_on < v.valid_to)
      QUALIFY row_number() OVER (PARTITION BY c.page_id ORDER BY contains(v.pattern, '/') DESC, length(v.pattern) DESC) = 1)
SELECT c.page_id, c.url, c.fetched_on, nullif(c.host, '') AS host, m.action, m.pattern, m.valid_from,
       coalesce(m.action, 'allow') <> 'block' AS kept
FROM c LEFT JOIN m ON m.page_id = c.page_id
"""
