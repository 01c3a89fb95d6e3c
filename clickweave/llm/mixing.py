"""Mix sources to target weights by Pareto order sampling.

Every source has a target number of words: the total is shared by weight,
no target exceeds ``cap`` times its source's words, and what is cut off is
shared again by weight (water filling, in closed form over one row per
source). A row's expected number of copies is e = target / source words, times
its share of an optional weight column. Rows equal in id, text and source form
a unit of n rows, whose expected copies are n times e. The whole part of that
is taken for certain; for the rest p = E - floor(E) the units are ranked by

    random odds / inclusion odds = (U / (1 - U)) / (p / (1 - p)),

and taken in that order, one more copy each (a sample of fixed size in words);
a unit longer than the words still free is passed over, and the order goes on
behind it. The last place goes to the unit, of those left, whose size fills the
rest best, if that brings the total nearer. U comes from an MD5 of the document
id and a seed, so reruns agree.

Native: DataFrame functions only, in one pass of jobs without a loop. The order
of a source's units is cut into ``ORDER_BUCKETS`` slices of the Pareto rank;
word sums per slice are pre-aggregated and summed up over the slices, and the
running sum inside a slice is a window over that slice alone, so a source with
a third of all rows is spread over the slices and never meets in one task.
Rows about a source reach its units through a salted join or by slice.

That settles all units before the first that does not fit; the room R left is
less than the words of that one. Behind it only few units can still be taken.
Take those of sizes from L up to 2L (``_class``) in the order of the rank: as
long as the sum of the class before a unit is R or less, it is a candidate, at
most R / L + 1 of them. Behind these at least one has not fit, so less than 2L
is free, and one more of the class can be taken at most; that can't be a unit
with an earlier one of the same or a smaller size among them, which fits whenever
it does. So only new minima are candidates. ``candidates`` finds a superset by
sums and minima per slice, and one array of them for each source, of some three
numbers per word of the longest document at most and mostly a few, is gone
through in the order of the rank.

Defined results: null text has size 0, and takes 0 words; very long texts are
counted whole; a null source is a source of its own, last in code-point order;
the copies of a unit are dealt evenly to its rows; a tie in the rank goes to
the smaller id; an empty table gives an empty result. Other columns, whatever
their names, are ignored by ``mix`` and kept by ``apply_mix``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickweave.llm.common import WORD_PATTERN, checkpointed, prefix_sums, text_key

ORDER_BUCKETS = 1024
SALTS = 64
CAP = 3
WEIGHTS = (1, 2, 3)
SEED = "mix-1"


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """``sources`` (source, source_size) -> the same with weight and target.

    Sorted by cap/weight, the sources that hit their cap come first; with
    ``level`` = (total - caps before) / (weights from here on), a source is
    capped while cap/weight < level, and the final level is the largest.
    One row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    n = len(weights)
    return (sources
            .withColumn("_pos", F.row_number().over(by_name) - 1)
            .withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                                               (F.col("_pos") % n + 1).cast("int")))
            .withColumn("_cap", (F.col("source_size") * cap).cast("double"))
            .withColumn("_ratio", F.col("_cap") / F.col("weight"))
            .withColumn("_total", F.sum("source_size").over(everything).cast("double"))
            .withColumn("_level", (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
                        / F.sum("weight").over(after))
            .withColumn("_best", F.max("_level").over(everything))
            .withColumn("target", F.least("_cap", F.col("_best") * F.col("weight")))
            .withColumnRenamed("_pos", "source_no")
            .drop("_cap", "_ratio", "_total", "_level", "_best"))


def uniform(doc_id, seed: str = SEED):
    """U in (0, 1) from an MD5: 52 bits plus a half."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def _spread(rows: DataFrame, slices: DataFrame, per_source: DataFrame) -> DataFrame:
    """Join rows about a source to its units: through one row per slice, so
    that the key is (source, slice) and a large source stays spread."""
    return rows.join(slices.select("source_no", "_slice").join(per_source, "source_no"), ["source_no", "_slice"])


def candidates(left: DataFrame, order) -> DataFrame:
    """Of ``left`` (source_no, _slice, size, _rest and the columns of ``order``;
    sizes of the source's room _rest at most) a superset of the units that are
    taken when each is taken if it fits what is left of the room (see above)."""
    left = left.withColumn("_class", F.length(F.bin("size")) - 1)
    by_slice = Window.partitionBy("source_no", "_class").orderBy("_slice")
    before = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    late = F.col("_before") > F.col("_rest")  # all units of the slice come behind the first ones
    classes = (prefix_sums(left.groupBy("source_no", "_class", "_slice").agg(
                   F.sum("size").alias("_words"), F.min("size").alias("_min"), F.max("_rest").alias("_rest")),
                   ["source_no", "_class"], "_slice", "_words", "_before")
               .withColumn("_least", F.min(F.when(late, F.col("_min"))).over(before))
               .select("source_no", "_class", "_slice", "_before", "_least"))
    earlier = (Window.partitionBy("source_no", "_class", "_slice").orderBy(*order)
               .rowsBetween(Window.unboundedPreceding, -1))
    summed = (left.join(classes, ["source_no", "_class", "_slice"])
              .withColumn("_sum", F.col("_before") + F.coalesce(F.sum("size").over(earlier), F.lit(0)))
              .withColumn("_first", F.col("_sum") <= F.col("_rest")))
    smaller = F.least("_least", F.min(F.when(~F.col("_first"), F.col("size"))).over(earlier))
    return (summed.withColumn("_smaller", smaller)
            .where(F.col("_first") | F.col("_smaller").isNull() | (F.col("size") < F.col("_smaller")))
            .drop("_class", "_before", "_least", "_sum", "_first", "_smaller"))


def decide(docs: DataFrame, weights=WEIGHTS, cap: int = CAP, seed: str = SEED,
           doc_weight: str | None = None) -> DataFrame:
    """One row per distinct (doc_id, text, source): doc_id, _key, source, n_rows,
    size (of one row), source_size, target, copies (how often its rows are taken
    in all, ``cap`` times n_rows at most)."""
    w = F.lit(1.0) if doc_weight is None else F.when(F.col(doc_weight) > 0, F.col(doc_weight).cast("double")).otherwise(1.0)
    units = checkpointed(
        docs.select("doc_id", text_key().alias("_key"), "source", word_count(F.col("text")).alias("size"), w.alias("_w"))
        .groupBy("doc_id", "_key", "source").agg(
            F.count(F.lit(1)).alias("n_rows"), F.max("size").alias("size"), F.max("_w").alias("_w")))
    all_words = F.col("size") * F.col("n_rows")
    per_source = checkpointed(targets(
        units.groupBy("source").agg(F.sum(all_words).alias("source_size"),
                                    F.sum(all_words * F.col("_w")).alias("_weighted")), weights, cap))

    # salted: a source with a third of all rows is spread over SALTS keys
    spread = per_source.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    u = units.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "_key"), F.lit(SALTS)).cast("int")).alias("u")
    expected = F.when(F.col("_weighted") > 0,
                      F.least(F.lit(float(cap)), F.col("target") * F.col("_w") / F.col("_weighted"))).otherwise(0.0)
    rows = (u.join(spread.alias("t"), F.col("u._salt").eqNullSafe(F.col("t._salt"))
                   & F.col("u.source").eqNullSafe(F.col("t.source")))
            .select("u.doc_id", "u._key", "u.source", "u.n_rows", "u.size", "t.source_no", "t.source_size", "t.target",
                    (expected * F.col("u.n_rows")).alias("_e"), uniform(F.col("u.doc_id"), seed).alias("_u")))
    p = F.col("_e") - F.floor("_e")
    rows = (rows.withColumn("_whole", F.floor("_e").cast("long"))
            .withColumn("_open", (F.col("_whole") < F.col("n_rows") * cap) & (F.col("size") > 0))
            # units with no fractional part come last in the order
            .withColumn("_rank", F.when(p > 0, (F.col("_u") / (1 - F.col("_u"))) / (p / (1 - p))).otherwise(float("inf")))
            .withColumn("_slice", F.when(p > 0, F.floor(F.col("_rank") / (1 + F.col("_rank")) * ORDER_BUCKETS))
                        .otherwise(ORDER_BUCKETS).cast("long")))
    order = [F.col("_rank"), F.col("doc_id").asc_nulls_last(), F.col("_key")]

    # all before the first that does not fit
    open_words = F.when(F.col("_open"), F.col("size")).otherwise(F.lit(0))
    slices = rows.groupBy("source_no", "_slice").agg(
        F.sum(open_words).alias("_words"), F.sum(F.col("size") * F.col("_whole")).alias("_certain"))
    slices = checkpointed(prefix_sums(slices, ["source_no"], "_slice", "_words", "_before")
                          .withColumn("_certain", F.sum("_certain").over(Window.partitionBy("source_no"))))
    running = (Window.partitionBy("source_no", "_slice").orderBy(*order)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = checkpointed(
        rows.join(slices.drop("_words"), ["source_no", "_slice"])
        .withColumn("_upto", F.col("_before") + F.sum(open_words).over(running))
        .withColumn("_room", F.col("target") - F.col("_certain"))
        .withColumn("_taken", F.col("_open") & (F.col("_upto") <= F.col("_room")))
        .drop("_e", "_u", "_before", "_certain"))
    room = placed.groupBy("source_no").agg(
        (F.max("_room") - F.coalesce(F.max(F.when(F.col("_taken"), F.col("_upto"))), F.lit(0))).alias("_rest"))

    # behind it: those that fit
    at = F.struct(F.col("_rank").alias("rank"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("d"),
                  F.col("_key").alias("k"), F.col("_slice").alias("s"))
    left = (_spread(placed.where(F.col("_open") & ~F.col("_taken")), slices, room).where(F.col("size") <= F.col("_rest"))
            .select("source_no", "_slice", "doc_id", "_key", "_rank", "size", "_rest"))
    found = candidates(left, order).groupBy("source_no").agg(
        F.sort_array(F.collect_list(F.struct(at.alias("at"), "size"))).alias("found"))
    fits = lambda acc, x: x["size"] <= acc["rest"]
    nothing = F.filter(F.col("found"), lambda _: F.lit(False))
    ends = checkpointed(
        room.join(found, "source_no", "left")
        .select("source_no", F.coalesce(F.aggregate(
            "found", F.struct(F.col("_rest").alias("rest"), nothing.alias("taken")),
            lambda acc, x: F.struct(
                F.when(fits(acc, x), acc["rest"] - x["size"]).otherwise(acc["rest"]).alias("rest"),
                F.when(fits(acc, x), F.concat(acc["taken"], F.array(x))).otherwise(acc["taken"]).alias("taken"))),
            F.struct(F.col("_rest").alias("rest"), nothing.alias("taken"))).alias("_end"))
        .select("source_no", F.col("_end.rest").alias("_rest"), F.col("_end.taken.at").alias("_at")))
    filled = (ends.select("source_no", F.explode("_at").alias("_at"))
              .select("source_no", F.col("_at.s").alias("_slice"), F.col("_at.d").alias("_d"), F.col("_at.k").alias("_k"),
                      F.lit(True).alias("_filled")))
    same = ((placed["source_no"] == filled["source_no"]) & (placed["_slice"] == filled["_slice"])
            & placed["doc_id"].eqNullSafe(filled["_d"]) & (placed["_key"] == filled["_k"]))
    placed = checkpointed(
        placed.join(filled, same, "left")
        .select(*[placed[c] for c in placed.columns if c not in ("_taken", "_upto", "_room")],
                (placed["_taken"] | F.col("_filled").isNotNull()).alias("_taken")))

    # the last one: of those left, the one that fills the rest best
    off = F.abs(F.col("_rest") - F.col("size"))
    last = (_spread(placed.where(F.col("_open") & ~F.col("_taken")), slices, ends.select("source_no", "_rest"))
            .where(off < F.col("_rest"))
            .groupBy("source_no").agg(F.min(F.struct(off.alias("off"), at.alias("at"))).alias("_l"))
            .select("source_no", F.col("_l.at.s").alias("_slice"), F.col("_l.at.d").alias("_d"), F.col("_l.at.k").alias("_k")))
    extra = F.col("_taken") | (F.col("_k").isNotNull() & F.col("doc_id").eqNullSafe(F.col("_d"))
                               & (F.col("_key") == F.col("_k")))
    return placed.join(last, ["source_no", "_slice"], "left").select(
        "doc_id", "_key", "source", "n_rows", "size", "source_size", "target",
        (F.col("_whole") + F.when(extra, 1).otherwise(0)).alias("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per distinct (doc_id, text, source) and number of copies: doc_id,
    _key, source, n_rows (so many equal rows), size, source_size, target, copies
    (how often each of these rows is taken, ``cap`` times at most). Options:
    ``weights``, ``cap``, ``seed``, and ``doc_weight``, a positive column that
    scales a document's expected copies within its source (null or non-positive
    counts as 1)."""
    n, more = F.col("n_rows"), F.col("copies") % F.col("n_rows")
    each = F.floor(F.col("copies") / n)
    part = lambda n, copies: F.struct(n.alias("n_rows"), copies.alias("copies"))
    return (decide(docs, **options)
            .withColumn("_part", F.explode(F.array(part(n - more, each), part(more, each + 1))))
            .drop("n_rows", "copies").select("*", "_part.n_rows", "_part.copies").drop("_part").where("n_rows > 0")
            .select("doc_id", "_key", "source", "n_rows", "size", "source_size", "target", "copies"))


def op9_mixing(spark, sf_dir):
    """The mix of all documents, one row per document."""
    from clickweave.llm.common import read_table

    rows = mix(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return (rows.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_rows"))))
            .select("doc_id", F.col("size"), "source_size", "target",
                    (F.col("size") * F.col("copies")).alias("taken"), "source", "copies"))


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: each row as often as the mix takes it, all columns
    kept. Documents of size 0 carry no words and follow the whole copies of
    their source. Rows of a unit of several are numbered in ``SALTS`` shares,
    so that one with very many rows is spread too."""
    names = docs.columns
    whole = F.struct(*[docs[c] for c in names]).alias("_row")  # columns of any name stay apart
    keyed = docs.select(whole).select(
        "_row", F.col("_row.doc_id").alias("_d"), text_key(F.col("_row.text")).alias("_k"), F.col("_row.source").alias("_s"))
    decided = checkpointed(decide(docs, **options).where("copies > 0").select(
        F.col("doc_id").alias("_d2"), F.col("_key").alias("_k2"), F.col("source").alias("_s2"), "n_rows", "copies"))

    def of(units: DataFrame) -> DataFrame:
        return keyed.join(units, keyed["_d"].eqNullSafe(F.col("_d2")) & (keyed["_k"] == F.col("_k2"))
                          & keyed["_s"].eqNullSafe(F.col("_s2"))).drop("_d2", "_k2", "_s2")

    single = of(decided.where("n_rows = 1")).withColumn("_copies", F.col("copies"))
    out = single
    if not decided.where("n_rows > 1").isEmpty():
        unit = ["_d", "_k", "_s"]
        many = checkpointed(of(decided.where("n_rows > 1")).withColumn("_salt", F.floor(F.rand(7) * SALTS)))
        shares = prefix_sums(many.groupBy(*unit, "_salt").agg(F.count(F.lit(1)).alias("_n")), unit, "_salt", "_n", "_before")
        shares = shares.select(*[F.col(c).alias(f"{c}2") for c in (*unit, "_salt")], "_before")
        index = F.col("_before") + F.row_number().over(Window.partitionBy(*unit, "_salt").orderBy("_salt")) - 1
        joined = many.join(shares, many["_d"].eqNullSafe(F.col("_d2")) & (many["_k"] == F.col("_k2"))
                           & many["_s"].eqNullSafe(F.col("_s2")) & (many["_salt"] == F.col("_salt2")))
        numbered = joined.withColumn(
            "_copies", F.floor(F.col("copies") / F.col("n_rows")) + F.when(index < F.col("copies") % F.col("n_rows"), 1).otherwise(0))
        out = single.select("_row", "_copies").unionByName(numbered.select("_row", "_copies"))
    return (out.where("_copies > 0")
            .select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy"))
            .select(*[F.col("_row").getField(c).alias(c) for c in names]))


OP9_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, text, count(*) AS n_rows,
         coalesce(len(regexp_extract_all(text, '{WORD_PATTERN}')), 0)::BIGINT AS size
  FROM documents GROUP BY doc_id, source, text),
s AS (SELECT source, sum(size * n_rows)::BIGINT AS source_size FROM d GROUP BY source),
o AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS pos FROM s),
w AS (SELECT source, pos, source_size, (pos % 3 + 1)::INT AS weight, (source_size * 3)::DOUBLE AS cap FROM o),
l AS (SELECT *, (sum(source_size) OVER ()::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
             / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, pos, source_size, least(cap, max(level) OVER () * weight) AS target FROM l),
e AS (SELECT d.*, t.pos, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN least(3.0::DOUBLE, t.target * 1.0 / t.source_size) ELSE 0 END * d.n_rows AS e,
             (('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5)
               / {float(1 << 52)!r} AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
r AS (SELECT *, floor(e)::BIGINT AS whole, floor(e)::BIGINT < 3 * n_rows AND size > 0 AS open,
             CASE WHEN e - floor(e) > 0 THEN (u / (1 - u)) / ((e - floor(e)) / (1 - (e - floor(e)))) END AS rnk FROM e),
k AS (SELECT *, row_number() OVER (PARTITION BY pos ORDER BY rnk NULLS LAST, doc_id NULLS LAST) AS rn,
             target - sum(size * whole) OVER (PARTITION BY pos) AS room FROM r),
f(pos, rn, rest, took) AS (
  SELECT pos, 0::BIGINT, max(room), false FROM k GROUP BY pos
  UNION ALL
  SELECT f.pos, k.rn, CASE WHEN k.open AND k.size <= f.rest THEN f.rest - k.size ELSE f.rest END,
         k.open AND k.size <= f.rest
  FROM f JOIN k ON k.pos = f.pos AND k.rn = f.rn + 1),
m AS (SELECT k.*, f.took AS taken0, min(f.rest) OVER (PARTITION BY k.pos) AS last_rest FROM k JOIN f USING (pos, rn)),
v AS (SELECT *, open AND NOT taken0 AND abs(last_rest - size) < last_rest AS may FROM m),
z AS (SELECT *, may AND row_number() OVER (PARTITION BY pos, may ORDER BY abs(last_rest - size), rnk NULLS LAST,
             doc_id NULLS LAST) = 1 AS final FROM v),
n AS (SELECT *, whole + CASE WHEN taken0 OR final THEN 1 ELSE 0 END AS copies,
             unnest(generate_series(0, n_rows - 1)) AS i FROM z),
b AS (SELECT *, (copies // n_rows + CASE WHEN i < copies % n_rows THEN 1 ELSE 0 END)::BIGINT AS own FROM n)
SELECT doc_id, size, source_size, target, size * own AS taken, source, own AS copies FROM b
"""
