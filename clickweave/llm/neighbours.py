"""Approximate nearest neighbours by stable projections and kd-trees.

Largest inner product is made nearest Euclidean distance by one more
coordinate, sqrt(M^2 - |x|^2) for an indexed vector (M: the largest norm) and 0
for a query. ``PROJECTED`` Gaussian (2-stable) projections make a low-
dimensional copy: the squared distance of two projections over the true one is
chi-square distributed with PROJECTED degrees of freedom.

The projections are cut into cells by a kd-tree over a bounded sample (it sets
the cells' limits; every vector is indexed), a cell has a kd-tree of its own,
and a query takes its projected neighbours leaf by leaf, nearest box first,
verifying each in full. It stops as soon as the next box at projected distance
r satisfies  chi2(r^2 / d^2) >= CONFIDENCE,  d being the true distance of its
k-th best so far: a better vector beyond that is less likely than 1 -
CONFIDENCE. First every query searches the cell it lies in; that gives d, and
only cells whose box fails the test are visited next.

Equal vectors are one entry with its k + 1 smallest ids (no further id can be
among k nearest, ties going to the smaller id, and one may be the query's own).
A query searches k places and one for each vector of its own id. So a very common
vector is neither a large group nor a large result. Cells hold ``CELL`` vectors or so,
and the queries that visit a cell are cut into blocks, so that no group grows
with the data.

Defined results: vectors that are null, empty, zero, of another length than
most, or that hold nulls or non-finite numbers take no part, as queries or
candidates; a query with fewer candidates than k gets them all; rows equal in
id and vector are one candidate and one query; an id with several vectors is a
candidate and a query with each, and never among its own neighbours; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickweave.llm.common import checkpointed, global_index, read_table, ship

K = 20
PROJECTED = 8        # even, so that the chi-square distribution has a short form
CONFIDENCE = 0.99
SAMPLE = 16_384
CELL = 4_096
CELLS = 4_096        # at most; cells grow beyond
LEAF = 32
QUERY_BLOCK = 2_048  # queries that visit a cell in one task
SALTS = 16
SEED = 8


def chi_square(x: np.ndarray, freedom: int = PROJECTED) -> np.ndarray:
    """Distribution function for an even number of degrees of freedom."""
    half = np.minimum(np.asarray(x, dtype=np.float64) / 2, 700.0)
    term, total = np.ones_like(half), np.ones_like(half)
    for j in range(1, freedom // 2):
        term = term * half / j
        total = total + term
    return 1.0 - np.exp(-half) * total


def chi_square_bound(confidence: float, freedom: int = PROJECTED) -> float:
    """x with chi_square(x) = confidence."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, freedom) < confidence else (low, mid)
    return high


def split(points: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Leaves of a kd-tree (row numbers), halved by the widest dimension."""
    todo, out = [np.arange(len(points))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= leaf:
            out.append(rows)
            continue
        spread = points[rows].max(axis=0) - points[rows].min(axis=0)
        order = rows[np.argsort(points[rows, int(np.argmax(spread))], kind="stable")]
        todo += [order[:len(order) // 2], order[len(order) // 2:]]
    return out


class Cells:
    """A kd-tree that sends points to numbered cells."""

    def __init__(self, points: np.ndarray, cells: int):
        self.nodes: list[tuple[int, float, int, int]] = []
        self.count = 0
        self.root = self._grow(points, cells)

    def _grow(self, points: np.ndarray, cells: int) -> int:
        if cells < 2 or len(points) < 2:
            self.count += 1
            return -self.count
        dim = int(np.argmax(points.max(axis=0) - points.min(axis=0)))
        cut = float(np.quantile(points[:, dim], (cells // 2) / cells))
        low = points[:, dim] < cut
        if not low.any() or low.all():
            self.count += 1
            return -self.count
        at = len(self.nodes)
        self.nodes.append((0, 0.0, 0, 0))
        self.nodes[at] = (dim, cut, self._grow(points[low], cells // 2), self._grow(points[~low], cells - cells // 2))
        return at

    def of(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), dtype=np.int32)
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -node - 1
                continue
            dim, cut, low, high = self.nodes[node]
            left = points[rows, dim] < cut
            todo += [(low, rows[left]), (high, rows[~left])]
        return out


def _box_distance(low: np.ndarray, high: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Squared distance of a point to each box."""
    off = np.maximum(np.maximum(low - point, point - high), 0.0)
    return (off * off).sum(axis=1)


def search(vectors: np.ndarray, projected: np.ndarray, queries: np.ndarray, query_points: np.ndarray, worst: np.ndarray,
           places: np.ndarray, top: float, bound: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, rows, scores) of the best rows for each query, ``places`` at
    most; ``worst`` is a score below which a row is of no use, ``top`` the squared largest
    norm, ``bound`` the chi-square value at which the search ends."""
    leaves = split(projected, LEAF)
    low = np.stack([projected[x].min(axis=0) for x in leaves])
    high = np.stack([projected[x].max(axis=0) for x in leaves])
    for q in range(len(queries)):
        distance = _box_distance(low, high, query_points[q])
        base = top + float(queries[q] @ queries[q])
        k = int(places[q])
        rows, scores, least = np.empty(0, np.int64), np.empty(0), float(worst[q])
        order = np.argsort(distance)
        at = 0
        while at < len(order):
            # true squared distance of the k-th best so far
            if least > -math.inf and distance[order[at]] >= bound * max(base - 2 * least, 0.0):
                break
            step = order[at:at + 4]
            at += len(step)
            new = np.concatenate([leaves[i] for i in step])
            rows = np.concatenate([rows, new])
            scores = np.concatenate([scores, vectors[new] @ queries[q]])
            if len(rows) > k:
                keep = np.argpartition(-scores, k - 1)[:k]
                rows, scores = rows[keep], scores[keep]
            if len(rows) == k:
                least = max(least, float(scores.min()))
        if len(rows):
            yield q, rows, scores


def usable(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, vector array<double>) of the vectors that take part."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    good = (F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
            & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("v", lambda x: x != 0.0))
    rows = rows.select("vec_id", v.alias("v")).where(good)
    usual = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.col("c").desc(), "n").limit(1).collect()
    return rows.where(F.size("v") == (usual[0]["n"] if usual else 0))


def nearest(rows: DataFrame, is_query, k: int = K, confidence: float = CONFIDENCE, vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each row for
    which ``is_query`` (a condition on vec_id) holds."""
    spark = rows.sparkSession
    ship(spark)
    valid = checkpointed(usable(rows, vector).dropDuplicates(["vec_id", "v"]))
    first = Window.partitionBy("v").orderBy("vec_id")
    ids = (valid.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
           .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    # numbered in the order of the smallest ids, which can repeat
    numbered, _ = global_index(ids.withColumn("low", F.element_at("ids", 1)), ["low", "v"], "vid")
    distinct = checkpointed(numbered.select("vid", "ids", "v"))
    asked = valid.where(is_query)
    own = asked.groupBy("vec_id").agg((F.count(F.lit(1)) + k).cast("int").alias("places"))
    asked = checkpointed(asked.join(own, "vec_id").join(distinct.select("v", "vid"), "v")
                         .select(F.col("vec_id").alias("query_id"), "vid", "places"))
    facts = distinct.agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("top"),
                         F.max(F.size("v")).alias("d")).first()
    total, top, width = facts["n"], facts["top"] or 0.0, facts["d"] or 1
    rng = np.random.default_rng(SEED)
    directions = rng.standard_normal((width + 1, PROJECTED))
    bound = chi_square_bound(confidence)

    def project(v: np.ndarray, indexed: bool) -> np.ndarray:
        out = v @ directions[:-1]
        if indexed:
            out += np.sqrt(np.maximum(top - (v * v).sum(axis=1), 0.0))[:, None] * directions[-1]
        return out

    sample = distinct.orderBy(F.xxhash64("v"), "vid").limit(SAMPLE).select("v").toPandas()["v"]
    points = project(np.stack(sample.to_list()), True) if len(sample) else np.zeros((0, PROJECTED))
    cells = Cells(points, min(CELLS, max(1, -(-total // CELL))))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                p = project(np.stack(pdf["v"].to_list()), True)
                yield pd.DataFrame({"vid": pdf["vid"], "v": pdf["v"], "p": list(p), "cell": cells.of(p)})

    index = checkpointed(distinct.select("vid", "v").mapInPandas(place, "vid long, v array<double>, p array<double>, cell int"))
    sides = [f(F.col("p")[i]).alias(f"{n}{i}") for i in range(PROJECTED) for n, f in (("low", F.min), ("high", F.max))]
    boxes = index.groupBy("cell").agg(*sides).collect()  # CELLS rows at most
    numbers = np.array([r["cell"] for r in boxes], dtype=np.int32)
    low = np.array([[r[f"low{i}"] for i in range(PROJECTED)] for r in boxes]).reshape(-1, PROJECTED)
    high = np.array([[r[f"high{i}"] for i in range(PROJECTED)] for r in boxes]).reshape(-1, PROJECTED)

    def nearest_cell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                p = project(np.stack(pdf["v"].to_list()), False)
                at = [int(numbers[np.argmin(_box_distance(low, high, x))]) for x in p]
                yield pd.DataFrame({"vid": pdf["vid"], "v": pdf["v"], "cell": np.array(at, np.int32), "worst": -math.inf,
                                    "places": pdf["places"]})

    def further_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            v = np.stack(pdf["v"].to_list())
            p = project(v, False)
            for i, (home, worst) in enumerate(zip(pdf["cell"], pdf["worst"], strict=True)):
                limit = bound * max(top + float(v[i] @ v[i]) - 2 * worst, 0.0) if worst > -math.inf else math.inf
                visit = numbers[(_box_distance(low, high, p[i]) < limit) & (numbers != home)]
                if len(visit):
                    yield pd.DataFrame({"vid": pdf["vid"].iloc[i], "v": [pdf["v"].iloc[i]] * len(visit), "cell": visit, "worst": worst,
                                        "places": pdf["places"].iloc[i]})

    def verify(key, candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        if len(candidates) and len(queries):
            vids, vectors = candidates["vid"].to_numpy(), np.stack(candidates["v"].to_list())
            q = np.stack(queries["v"].to_list())
            asking = queries["vid"].to_numpy()
            for i, rows_, scores in search(vectors, np.stack(candidates["p"].to_list()), q, project(q, False),
                                           queries["worst"].to_numpy(), queries["places"].to_numpy(), top, bound):
                out.append(pd.DataFrame({"qid": asking[i], "vid": vids[rows_], "score": scores}))
        return pd.concat(out) if out else pd.DataFrame({"qid": np.empty(0, np.int64), "vid": np.empty(0, np.int64), "score": np.empty(0)})

    def visit(queries: DataFrame) -> DataFrame:
        counts = {r["cell"]: -(-r["n"] // QUERY_BLOCK) for r in queries.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
        blocks = spark.createDataFrame(list(counts.items()) or [(-1, 1)], "cell int, blocks int")  # CELLS rows at most
        held = (index.join(F.broadcast(blocks), "cell")
                .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
        queries = (queries.join(F.broadcast(blocks), "cell")
                   .withColumn("block", F.pmod(F.xxhash64("vid"), F.col("blocks")).cast("int")))
        return checkpointed(held.select("cell", "block", "vid", "v", "p").groupBy("cell", "block")
                            .cogroup(queries.select("cell", "block", "vid", "v", "worst", "places").groupBy("cell", "block"))
                            .applyInPandas(verify, "qid long, vid long, score double"))

    schema = "vid long, v array<double>, cell int, worst double, places int"
    places = checkpointed(asked.groupBy("vid").agg(F.max("places").alias("places")))
    wanted = distinct.join(places, "vid").select("vid", "v", "places")
    home = checkpointed(wanted.mapInPandas(nearest_cell, schema))
    near = visit(home)
    worst = near.groupBy(F.col("qid").alias("vid")).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    worst = worst.join(places.select("vid", F.col("places").alias("p")), "vid").select(
        "vid", F.when(F.col("n") >= F.col("p"), F.col("least")).otherwise(float("-inf")).alias("worst"))
    again = checkpointed(home.drop("worst").join(worst, "vid").select("vid", "v", "cell", "worst", "places")
                         .mapInPandas(further_cells, schema))
    every = near.unionByName(visit(again))

    best = Window.partitionBy("qid").orderBy(F.col("score").desc(), "vid")
    limits = places.select(F.col("vid").alias("qid"), "places")
    lists = (every.withColumn("r", F.row_number().over(best)).join(limits, "qid").where(F.col("r") <= F.col("places"))
             .join(distinct.select("vid", "ids"), "vid")
             .withColumn("vec_id", F.explode("ids")))
    ranked = Window.partitionBy("qid").orderBy(F.col("score").desc(), "vec_id")
    lists = (lists.withColumn("r", F.row_number().over(ranked)).where(F.col("r") <= F.col("places"))
             .groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("r", "vec_id", "score"))).alias("found"))
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    answered = (asked.withColumn("salt", F.pmod(F.xxhash64("query_id"), F.lit(SALTS)).cast("int"))
                .join(lists.withColumnRenamed("qid", "vid"), ["vid", "salt"]))
    return (answered.select("query_id", F.posexplode(F.slice(F.filter(
                "found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)).alias("rank", "hit"))
            .select("query_id", (F.col("rank") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score")))


def op8_neighbours(spark, sf_dir):
    """The 20 nearest vectors of every 20th vector."""
    return nearest(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)
