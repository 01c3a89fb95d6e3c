"""Quality scores by the votes of the nearest labelled texts.

A text is a vector of two parts. Its terms (words, lower-cased, and runs of
other marks as they stand) are hashed to ``TERMS`` places, weighted by
(1 + log tf) * idf and brought to length 1; the document frequencies behind the
idf are counted over all documents. Its style is a short vector of square roots
of shares: upper-case words, repeated words and lines, digits, marks by kind, blanks
and word lengths; it is scaled by ``STYLE``.

Latent-semantic space: the leading ``DIMS`` right singular vectors of the
labelled sample's matrix, by subspace iteration on a part of the sample
(``FIT_DOCS`` rows, each with its ``FIT_TERMS`` heaviest places). Every text is
projected into it and brought to length 1.

Voting: the projected labelled texts (``LABELLED`` at most, so the broadcast is
bounded by that times DIMS numbers) are compared with every document by exact
blocked cosine products; the ``NEIGHBOURS`` nearest vote with their labels,
each with the weight (1 + cosine)^POWER / 2^POWER, and ``PRIOR`` votes are added
for the mean label. No index, no pruning: every document meets every labelled
vector.

Only the label's text and label are learned, from rows of ``labels`` outside the
held-out fold; of more, those with the smallest hash of the id are taken. An id
with several labels counts with their mean, one with several texts with one of
them. Language, source and id are never inputs of a score.

Defined results: a null text is an empty one; a text without terms has no
direction and scores the mean label; without any labels all score 0.5; equal
texts score alike; a very long text is counted in parts of ``PART`` characters;
an empty table gives an empty result; other columns are kept by ``score``, those
named like a result are replaced.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave.llm.common import checkpointed, read_table, releasing, ship

LABELLED = 8_192     # labelled texts that vote
FIT_DOCS = 3_072     # of them, those that the space is fitted on
FIT_TERMS = 256
TERMS = 1 << 14
DIMS = 64
STYLE = 2.5
NEIGHBOURS = 32
POWER = 24
PRIOR = 0.05
THRESHOLD = 0.3
BLOCK = 512          # documents of one product
CACHE = 200_000      # terms whose place a task remembers
PART = 1 << 20

# A run of letters, of digits, of other marks or of underscores. Most words are of
# the letters listed, which are told faster than by exclusion; blanks go with the
# term before them.
_TERM = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]++(?![^\W\d_])|[^\W\d_]+|\d+|[^\w\s]+|_+)\s*")
_MARKS = 32          # places of runs of marks, by hash
_LENGTHS = 12
_FIRST_MARK = 5
STYLES = _FIRST_MARK + _MARKS + _LENGTHS


def place(term: str) -> int:
    return zlib.crc32(term.encode("utf-8", "surrogatepass")) % TERMS


class Codes(dict):
    """Term -> its place, its style slot (of the length or the marks) and whether
    it is upper case, in one number: (upper * STYLES + slot) * TERMS + place."""

    def __missing__(self, term: str) -> int:
        if len(self) > CACHE:
            self.clear()
        first = term[0]
        if first.isalpha():
            slot = _FIRST_MARK + _MARKS + min(len(term), _LENGTHS) - 1
        elif first.isdigit():
            slot = 3
        else:
            slot = _FIRST_MARK + zlib.crc32(term.encode("utf-8", "surrogatepass")) % _MARKS
        # digits count by their number only
        lower = "0" * min(len(term), 8) if slot == 3 else term.lower()
        upper = len(term) > 1 and term.isupper()
        code = self[term] = (upper * STYLES + slot) * TERMS + place(lower)
        return code


class Reader:
    """Texts -> places, counts, and style. A text's terms are looked up and
    counted as a whole, without a step of Python for each."""

    def __init__(self):
        self.known = Codes()

    def parts(self, text: str) -> Iterator[tuple[list[str], np.ndarray]]:
        """The terms and their codes; a term across two parts counts as two."""
        for start in range(0, len(text), PART):
            terms = _TERM.findall(text, start, min(len(text), start + PART))
            yield terms, np.fromiter(map(self.known.__getitem__, terms), np.int64, len(terms))

    def places(self, text: str | None) -> np.ndarray:
        """Sorted places of the terms."""
        found = [np.unique(codes % TERMS) for _, codes in self.parts(text or "")]
        return found[0] if len(found) == 1 else np.unique(np.concatenate([np.zeros(0, np.int64), *found]))

    def read(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted places, their counts, and the style vector."""
        text = text or ""
        count, kind = np.zeros(TERMS, np.int64), np.zeros(2 * STYLES, np.int64)
        repeated = 0
        last = None
        for terms, codes in self.parts(text):
            key, where = np.divmod(codes, TERMS)
            count += np.bincount(where, minlength=TERMS)
            kind += np.bincount(key, minlength=2 * STYLES)
            # equal terms have equal codes
            repeated += sum(terms[i] == terms[i + 1] for i in np.flatnonzero(codes[1:] == codes[:-1]).tolist())
            repeated += bool(terms) and terms[0] == last
            last = terms[-1] if terms else last
        total = kind.sum()
        if not total:
            return np.zeros(0, np.int64), np.zeros(0), np.zeros(STYLES)
        lower, upper = kind.reshape(2, STYLES)
        style = (lower + upper).astype(np.float64)
        style[0] = upper.sum()
        style[1] = repeated
        style /= total
        lines = text.split("\n")
        style[2] = 1 - len(set(lines)) / len(lines)
        style[4] = sum(map(text.count, " \t\n")) / len(text)
        found = np.flatnonzero(count)
        return found, count[found].astype(np.float64), STYLE * np.sqrt(style)


def fold(doc_id: str = "doc_id") -> Column:
    """Held out of the learning: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """For each place the number of documents with one of its terms, and the
    number of documents; a task sends a row for each place at most."""
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, seen, n = Reader(), np.zeros(TERMS, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen[reader.places(text)] += 1
            n += batch.num_rows
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, TERMS)), pa.array(np.append(seen[at], n))], ["place", "n"])

    out = np.zeros(TERMS + 1, np.int64)
    for r in (docs.select("text").mapInArrow(releasing(count), "place long, n long")
              .groupBy("place").agg(F.sum("n").alias("n")).collect()):  # TERMS + 1 rows at most
        out[r["place"]] = r["n"]
    return out[:TERMS], int(out[TERMS])


class Vectors:
    """Weighted sparse vectors of TERMS + STYLES places."""

    def __init__(self, seen: np.ndarray, n: int):
        self.idf = np.log((1 + n) / (1 + seen)) + 1
        self.reader = Reader()

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        places, counts, style = self.reader.read(text)
        weights = (1 + np.log(counts)) * self.idf[places]
        length = math.sqrt(float(weights @ weights)) or 1.0
        slots = np.flatnonzero(style)
        return np.concatenate([places, TERMS + slots]), np.concatenate([weights / length, style[slots]])


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int = LABELLED) -> DataFrame:
    """doc_id, label, text of ``limit`` labelled ids outside the held-out fold."""
    chosen = (labels.where(F.col("quality").isin(0, 1) & ~fold() & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.avg("quality").alias("label"))
              .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
              .orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").limit(limit))
    return (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # ``limit`` ids
            .groupBy("doc_id").agg(F.max("label").alias("label"), F.min_by("text", F.xxhash64("text")).alias("text")))


def subspace(rows: list[tuple[np.ndarray, np.ndarray]], dims: int = DIMS, rounds: int = 6) -> np.ndarray:
    """Leading right singular vectors of the sparse rows, places x dims."""
    width = TERMS + STYLES
    if not rows:
        return np.zeros((width, dims), np.float32)
    size = np.array([len(p) for p, _ in rows])
    place_of = np.concatenate([p for p, _ in rows])
    weight = np.concatenate([w for _, w in rows]).astype(np.float32)
    row_of = np.repeat(np.arange(len(rows)), size)
    by_place = np.argsort(place_of, kind="stable")

    def product(to: np.ndarray, by: np.ndarray, w: np.ndarray, dense: np.ndarray, height: int) -> np.ndarray:
        """Sum of w * dense[by] for each value of ``to`` (sorted), in slices."""
        out = np.zeros((height, dense.shape[1]), np.float32)
        for at in range(0, len(to), 1 << 15):
            t, b, v = to[at:at + (1 << 15)], by[at:at + (1 << 15)], w[at:at + (1 << 15)]
            first = np.flatnonzero(np.diff(t, prepend=-1))
            out[t[first]] += np.add.reduceat(dense[b] * v[:, None], first, axis=0)
        return out

    basis = np.random.default_rng(7).standard_normal((width, min(dims + 8, len(rows)))).astype(np.float32)
    for _ in range(rounds):
        left = np.linalg.qr(product(row_of, place_of, weight, basis, len(rows)))[0]
        basis, scale, _ = np.linalg.svd(
            product(place_of[by_place], row_of[by_place], weight[by_place], left, width), full_matrices=False)
    out = np.zeros((width, dims), np.float32)
    keep = min(dims, int((scale > 1e-4).sum()))
    out[:, :keep] = basis[:, :keep]
    return out


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """The space and the labelled vectors in it; bounded by LABELLED, TERMS and DIMS."""
    seen, n = document_frequencies(docs)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = Vectors(seen, n)
        for batch in batches:
            rows = [vectors(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([r[0] for r in rows], pa.list_(pa.int64())),
                 pa.array([r[1].astype(np.float32) for r in rows], pa.list_(pa.float32()))], ["doc_id", "label", "places", "weights"])

    sample = labelled_sample(docs, labels)
    kind = sample.schema["doc_id"].dataType.simpleString()
    rows = checkpointed(sample.mapInArrow(
        releasing(read), f"doc_id {kind}, label double, places array<long>, weights array<float>").where("size(places) > 0"))
    heavy = F.slice(F.sort_array(F.zip_with("weights", "places", lambda w, p: F.struct(w.alias("w"), p.alias("p"))), False), 1, FIT_TERMS)
    part = (rows.orderBy(F.xxhash64("doc_id", F.lit(6)), "doc_id").limit(FIT_DOCS)
            .select("doc_id", heavy.alias("heavy"))
            .select("doc_id", F.col("heavy.p").alias("p"), F.col("heavy.w").alias("w")).toArrow()).sort_by("doc_id")
    space = subspace([(np.asarray(p.values), np.asarray(w.values)) for p, w in
                      zip(part.column("p").combine_chunks(), part.column("w").combine_chunks(), strict=True)])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [directed(np.asarray(w.values) @ space[np.asarray(p.values)])
                     for p, w in zip(batch.column(2), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.float32()))], ["doc_id", "label", "vector"])

    got = rows.mapInArrow(project, f"doc_id {kind}, label double, vector array<float>").toArrow().sort_by("doc_id")
    label = got.column("label").to_numpy()
    vector = got.column("vector").combine_chunks().values.to_numpy().reshape(-1, DIMS) if len(label) else np.zeros((0, DIMS), np.float32)
    return {"seen": seen, "n": n, "space": space, "vectors": np.ascontiguousarray(vector), "labels": label,
            "mean": float(label.mean()) if len(label) else 0.5}


def directed(vector: np.ndarray) -> np.ndarray:
    length = float(np.sqrt((vector.astype(np.float64) ** 2).sum()))
    return (vector / length if length > 1e-9 else vector * 0).astype(np.float32)


def vote(block: np.ndarray, model: dict) -> np.ndarray:
    """Scores of a block of directed vectors. Cosines are compared to five
    digits, and all that equal the last of the nearest vote, so the result
    doesn't depend on the block."""
    labelled, label, mean = model["vectors"], model["labels"], model["mean"]
    if not len(labelled):
        return np.full(len(block), mean)
    cosine = block @ labelled.T
    k = min(NEIGHBOURS, len(labelled))
    # rounding keeps the order, so only what may vote is rounded
    least = np.round(np.partition(cosine, len(labelled) - k, axis=1)[:, len(labelled) - k], 5)
    row, col = np.nonzero(cosine >= (least - 1e-4)[:, None])
    near = np.round(cosine[row, col], 5)
    voting = near >= least[row]
    row, col, near = row[voting], col[voting], near[voting]
    weight = ((1 + near.astype(np.float64)) / 2) ** POWER
    votes = np.bincount(row, weight, len(block))
    score = (np.bincount(row, weight * label[col], len(block)) + PRIOR * mean) / (votes + PRIOR)
    return np.where(np.abs(block).sum(axis=1) > 0, np.clip(score, 0, 1), mean)


def score(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with columns score and predicted (replaced if present)."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*[c for c in docs.columns if c not in ("score", "predicted")])
    at = kept.columns.index("text")
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        vectors, space = Vectors(model["seen"], model["n"]), model["space"]
        for batch in batches:
            block = np.zeros((batch.num_rows, DIMS), np.float32)
            for i, text in enumerate(batch.column(at).to_pylist()):
                places, weights = vectors(text)
                block[i] = directed(weights.astype(np.float32) @ space[places])
            scores = np.concatenate([vote(block[i:i + BLOCK], model) for i in range(0, len(block), BLOCK)] or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], names=schema.names)

    return kept.mapInArrow(releasing(run), schema)


def op11_quality(spark, sf_dir):
    """Quality score of every document, learned outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", fold().alias("held_out"), "score", "predicted")
