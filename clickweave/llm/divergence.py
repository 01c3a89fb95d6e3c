"""Audit of how far the sources of a language differ in their use of words.

Terms are runs of ASCII letters and non-ASCII characters, with A-Z lower-cased.
A language keeps the terms found in at least ``MIN_DOCS`` of its documents (V of
them). A group (language, source), and each language as a whole, gives every
kept term, with ``count`` occurrences there of N kept ones in all,

    p = 1 + floor(SCALE * (count + 2) / (N + 2 V)),

and two such numbers differ by f(p, q) = floor((p - q)^2 / (p + q)). The audit
lists, for each group, the sum of f over all kept terms against each other
source of its language (``pair``), and the terms it uses more than its language
(``term``). All numbers are integers.

A term's price between two groups depends on its two counts only, so it is
enough to know how many terms have each pair of counts. The terms' counts are
one-hot: a row for each term, an indicator column for each (group, count level),
and the product of that matrix with its transpose holds in every cell how many
terms have both levels: all joint tables of all pairs of groups at once. Spark
deals the terms of a language to tasks, a task takes them in blocks whose
matrices have about ``COLUMNS`` columns, multiplies tile by tile in numpy
(sums of at most ``ROWS`` ones: exact in 32-bit floats), and Spark adds up the
cells of all blocks. Level 0 (a term that a group lacks) has no column: its cells
are the margins less the others, which the pricing uses in the form

    sum over cells of f(a, b) - f(a, 0) - f(0, b) + f(0, 0)
      + for either group, sum over its levels of f(a, 0) - f(0, 0)  + V f(0, 0).

So nothing of the size of groups x terms is built, and no two terms meet. Terms
are counted in Python per batch of texts and leave it as sums per (language,
source, term); the exchange is on (language, term).

Defined results: null text, language and source are ''; equal rows count each;
a very long text is counted in parts of ``PART`` bytes; a group without kept
terms takes part with count 0 throughout; a language with one source has no
pairs; without kept terms all pairs are 0 and there is no ``term`` row; ties go
to the item first in UTF-8 order; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.llm.common import checkpointed, read_table, releasing, ship, shuffle_parts

MIN_DOCS = 10
SCALE = 1_000_000_000
TOP = 10
ROWS = 2048          # terms of a block at most
COLUMNS = 1024       # indicator columns at which a block is closed, and of a tile
HELD = 400_000       # terms a counting task holds before it hands their sums on
PART = 1 << 22

# every byte that ends a term becomes a blank, A-Z become a-z
_TERMS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def term_lists(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text (as UTF-8 bytes), in parts."""
    data = (text or "").encode()
    at = 0
    while at < len(data):
        end = at + PART
        if end < len(data):  # on to the end of a term
            rest = data[end:end + PART].translate(_TERMS)
            while b" " not in rest and end + len(rest) < len(data):
                end += len(rest)
                rest = data[end:end + PART].translate(_TERMS)
            end += rest.index(b" ") if b" " in rest else len(rest)
        yield data[at:end].translate(_TERMS).split()
        at = end


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents with the term)."""
    ship(docs.sparkSession)
    names = ["lang", "source", "term", "n", "docs"]

    def batch_of(lang: str, source: str, total: Counter, within: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(total), pa.string()), pa.array([source] * len(total), pa.string()),
             pa.array(list(total), pa.binary()).cast(pa.string()), pa.array(total.values(), pa.int64()),
             pa.array(map(within.__getitem__, total), pa.int64())], names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))
        size = 0
        for batch in batches:
            for lang, source, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                total, within = held[lang or "", source or ""]
                before = len(total)
                seen: set[bytes] = set()
                for terms in term_lists(text):
                    total.update(terms)
                    seen.update(terms)
                within.update(seen)
                size += len(total) - before
            if size > HELD:
                for group, counters in held.items():
                    yield batch_of(*group, *counters)
                held.clear()
                size = 0
        for group, counters in held.items():
            yield batch_of(*group, *counters)

    out = docs.select("lang", "source", "text").mapInArrow(
        releasing(count), "lang string, source string, term string, n long, docs long")
    # dealt by (lang, term), so that the count of documents needs no exchange of its own
    return (out.repartition(shuffle_parts(docs.sparkSession), "lang", "term")
            .groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def kept_terms(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Rows of the terms in at least ``min_docs`` documents of their language,
    with lang_n, the term's occurrences there, and ``first`` on one row a term."""
    w = Window.partitionBy("lang", "term")
    return (counts.withColumns({
                "_docs": F.sum("docs").over(w), "lang_n": F.sum("n").over(w),
                "first": F.row_number().over(w.orderBy("source")) == 1})
            .where(F.col("_docs") >= min_docs).drop("_docs", "docs"))


def joint_tables(kept: DataFrame, columns: int = COLUMNS) -> DataFrame:
    """lang, g, a, h, b, n: so many terms occur a > 0 times in source g and
    b > 0 times in source h, for g < h."""
    ship(kept.sparkSession)
    names = ["lang", "g", "a", "h", "b", "n"]

    def product(lang: str, terms: list[list[tuple[str, int]]]) -> Iterator[pa.RecordBatch]:
        """Cells of the block's indicator matrix times its transpose."""
        levels = sorted({x for t in terms for x in t})
        column = {x: i for i, x in enumerate(levels)}
        row = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
        col = np.array([column[x] for t in terms for x in t])
        source = np.array([x[0] for x in levels], dtype=object)
        count = np.array([x[1] for x in levels], dtype=np.int64)
        number = np.unique(source, return_inverse=True)[1]

        def tile(at: int) -> np.ndarray:
            out = np.zeros((len(terms), min(columns, len(levels) - at)), dtype=np.float32)
            inside = (col >= at) & (col < at + columns)
            out[row[inside], col[inside] - at] = 1
            return out

        for i in range(0, len(levels), columns):
            left = tile(i)
            for j in range(i, len(levels), columns):
                cells = left.T @ (left if i == j else tile(j))
                x, y = np.nonzero(cells)
                other = number[x + i] < number[y + j]
                x, y = x[other], y[other]
                if len(x):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(x), pa.string()), pa.array(source[x + i], pa.string()), pa.array(count[x + i]),
                         pa.array(source[y + j], pa.string()), pa.array(count[y + j]),
                         pa.array(cells[x, y].astype(np.int64))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[list[tuple[str, int]]] = []
        levels: set = set()
        at: tuple = (None, None)
        for batch in batches:
            for lang, term, source, n in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (lang, term) != at:
                    if block and (lang != at[0] or len(block) == ROWS or len(levels) >= columns):
                        yield from product(at[0], block)
                        block, levels = [], set()
                    at = (lang, term)
                    block.append([])
                block[-1].append((source, n))
                levels.add((source, n))
        if block:
            yield from product(at[0], block)

    # terms of like frequency share levels: they are dealt at random, but meet
    # in one block of their task in the order of their count
    cells = (kept.repartition(shuffle_parts(kept.sparkSession), "lang", "term")
             .sortWithinPartitions("lang", "lang_n", "term", "source").select("lang", "term", "source", "n")
             .mapInArrow(releasing(run), "lang string, g string, a long, h string, b long, n long"))
    return cells.groupBy("lang", "g", "h", "a", "b").agg(F.sum("n").alias("n"))


def share(count: Column, total: Column, v: Column) -> Column:
    """p of a count, in integers (the product can pass 64 bits)."""
    wide = lambda c: c.cast("decimal(28,0)")
    return F.lit(1) + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * wide(count + 2), wide(total + 2 * v))


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank (see the module's docstring)."""
    docs = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), "text")
    kept = checkpointed(kept_terms(term_counts(docs), min_docs))
    per_lang = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_if("first").alias("v"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # one row per source and language
    groups = checkpointed(
        docs.select("lang", "source").distinct().join(per_lang, "lang", "left").join(totals, ["lang", "source"], "left")
        .fillna(0, ["lang_total", "v", "total"])
        .withColumn("p0", F.when(F.col("v") > 0, share(F.lit(0), F.col("total"), F.col("v"))).otherwise(0)))

    def side(letter: str) -> DataFrame:
        return groups.select("lang", F.col("source").alias(letter), F.col("total").alias(f"total_{letter}"),
                             F.col("p0").alias(f"p0_{letter}"), *([F.col("v")] if letter == "g" else []))

    g0, h0 = F.col("p0_g"), F.col("p0_h")
    pairs = side("g").join(side("h"), "lang").where("g <> h")
    pg = share(F.col("a"), F.col("total_g"), F.col("v"))
    ph = share(F.col("b"), F.col("total_h"), F.col("v"))
    cells = (joint_tables(kept).join(F.broadcast(side("g")) if _few(groups) else side("g"), ["lang", "g"])
             .join(F.broadcast(side("h")) if _few(groups) else side("h"), ["lang", "h"])
             .withColumns({"pg": pg, "ph": ph})
             .groupBy("lang", "g", "h").agg(F.sum(F.col("n") * (
                 distance(F.col("pg"), F.col("ph")) - distance(F.col("pg"), h0)
                 - distance(g0, F.col("ph")) + distance(g0, h0))).alias("cells")))
    levels = kept.groupBy("lang", F.col("source").alias("g"), F.col("n").alias("a")).agg(F.count(F.lit(1)).alias("n"))
    margins = (levels.join(pairs, ["lang", "g"]).withColumn("pg", pg)
               .groupBy("lang", "g", "h").agg(F.sum(F.col("n") * (distance(F.col("pg"), h0) - distance(g0, h0))).alias("margin")))
    margins = checkpointed(margins)
    flip = lambda df: df.select("lang", F.col("g").alias("h"), F.col("h").alias("g"), *df.columns[3:])
    cells = checkpointed(cells)
    zero = F.lit(0).cast("long")
    base = F.when(F.col("v") > 0, F.col("v") * distance(g0, h0)).otherwise(zero)
    pair = (pairs.withColumn("base", base).select("lang", "g", "h", "base")
            .join(cells.unionByName(flip(cells)), ["lang", "g", "h"], "left")
            .join(margins, ["lang", "g", "h"], "left")
            .join(flip(margins).withColumnRenamed("margin", "margin_h"), ["lang", "g", "h"], "left")
            .select("lang", F.col("g").alias("source"), F.lit("pair").alias("part"), F.col("h").alias("item"),
                    (F.col("base") + F.coalesce("cells", zero) + F.coalesce("margin", zero) + F.coalesce("margin_h", zero)).alias("value")))
    order = (F.col("value").desc(), F.col("item"))
    pair = pair.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))

    p, q = share(F.col("n"), F.col("total"), F.col("v")), share(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    small = groups.select("lang", "source", "total", "lang_total", "v")
    term = (kept.join(F.broadcast(small) if _few(groups) else small, ["lang", "source"])
            .withColumns({"p": p, "q": q}).where("p > q")
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                    distance(F.col("p"), F.col("q")).alias("value")))
    # a group's best terms: per share of the terms first, so that a large group isn't sorted in one task
    salted = Window.partitionBy("lang", "source", "_salt").orderBy(*order)
    term = (term.withColumn("_salt", F.pmod(F.xxhash64("item"), F.lit(64)))
            .withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
            .drop("rank", "_salt")
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))
            .where(F.col("rank") <= top))
    return pair.unionByName(term).select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), "rank")


FEW_GROUPS = 20_000  # rows of some 100 bytes that may be broadcast


def _few(groups: DataFrame) -> bool:
    return groups.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS


def op13_divergence(spark, sf_dir):
    """Divergence of the sources of every language, over all documents."""
    return audit(read_table(spark, sf_dir, "documents"))


OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
t AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*)::BIGINT AS lang_n FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= {MIN_DOCS}),
c AS (SELECT t.lang, t.source, t.term, count(*)::BIGINT AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
l AS (SELECT lang, count(*)::HUGEINT AS v, sum(lang_n)::HUGEINT AS lang_total FROM k GROUP BY lang),
s AS (SELECT DISTINCT lang, source FROM d),
g AS (SELECT s.lang, s.source, coalesce((SELECT sum(n) FROM c WHERE c.lang = s.lang AND c.source = s.source), 0)::HUGEINT AS total FROM s),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.lang_n, l.v, l.lang_total,
             (1 + {SCALE}::HUGEINT * (coalesce(c.n, 0) + 2) // (g.total + 2 * l.v))::BIGINT AS p
      FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
x AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))::BIGINT AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
         FROM s a JOIN s b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
w AS (SELECT *, (1 + {SCALE}::HUGEINT * (lang_n + 2) // (lang_total + 2 * v))::BIGINT AS q FROM p WHERE n > 0),
term AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM w WHERE p > q),
u AS (SELECT * FROM pair UNION ALL SELECT * FROM term)
SELECT lang, source, part, item, value, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM u)
WHERE part = 'pair' OR rank <= {TOP}
"""
