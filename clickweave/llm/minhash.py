"""Document fingerprints by MinHash, and near duplicates from them.

Shingles are ``SHINGLE`` words (runs of anything but ASCII blanks, A-Z lower-
cased) joined by single spaces; a shorter text is one shingle, and a text
without words has none (its signature is all ones). A whole batch of texts is
cut and hashed at once in numpy: every byte is mixed with its place in its word,
prefix sums give the words' hashes, and words mixed with their place in the
shingle the shingles'. Each of
``PERMUTATIONS`` universal hash permutations x -> (a x + b) mod 2**64 (a odd)
keeps its smallest image of the shingles, of which the upper 32 bits are one
value of the signature. The share of equal values estimates the Jaccard
similarity of two shingle sets.

``near_duplicates`` joins signatures band by band in Spark: ``BANDS`` bands of
``PERMUTATIONS // BANDS`` values. Equal shingle sets are one node from the
start, and every candidate pair is verified by its exact Jaccard similarity.

Defined results: a null text is an empty one; a text is its own next document
if it is the only one; rows follow each other by (doc_id, text), null ids
first (ids are numbers); a very long text is hashed in parts of ``CHUNK`` bytes,
with 8 bytes kept a word; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import checkpointed, components, read_table, ship, shuffle_parts, text_key

SHINGLE = 5
PERMUTATIONS = 128
BANDS = 32
THRESHOLD = 0.8
SEED = 20_240_101
CHUNK = 1 << 18  # bytes that are hashed at once
SLICES = 4       # id ranges per shuffle partition

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x7FB5D329728EA185)
    x = (x ^ (x >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i mod 2**64 for i <= n."""
    have = _powers.get(base)
    if have is None or len(have[0]) <= n:
        size = max(n, CHUNK) + 1
        have = tuple(np.multiply.accumulate(np.concatenate(([_U(1)], np.full(size, _U(x)))))
                     for x in (base, pow(base, -1, 1 << 64)))
        _powers[base] = have
    return have


_STEP = _U(0x9E3779B97F4A7C15)


def _runs(data: np.ndarray, before: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and sums of the words in lower-cased bytes. A word's sum is
    that of its bytes, each mixed with its place in the word, so no two words
    share it by an identity of polynomials. ``before``: bytes of a first word
    that stand in the part before."""
    word = ~_BLANK[data]
    edge = np.diff(np.concatenate(([False], word, [False])).astype(np.int8))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sizes = stop - start
    at = np.flatnonzero(word)
    place = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    if before and len(start) and start[0] == 0:
        place[:sizes[0]] += before
    values = _mix(data[at].astype(np.uint64) + place.astype(np.uint64) * _STEP)
    total = np.zeros(len(at) + 1, dtype=np.uint64)
    np.cumsum(values, out=total[1:])
    ends = np.cumsum(sizes)
    return start, stop, total[ends] - total[ends - sizes]


def _closed(sums: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return _mix(sums ^ (sizes.astype(np.uint64) * _STEP))


def _long_words(text: bytes) -> np.ndarray:
    """Word hashes of a long text, read in parts of CHUNK bytes; a word across
    parts carries its sum and length on."""
    out: list[np.ndarray] = []
    sum_, size = _U(0), 0
    for at in range(0, len(text), CHUNK):
        data = _LOWER[np.frombuffer(text, np.uint8, min(CHUNK, len(text) - at), at)]
        start, stop, sums = _runs(data, size)
        sizes = stop - start
        if size and len(start) and start[0] == 0:
            sums[:1] += sum_
            sizes[0] += size
        elif size:
            sums, sizes, stop = np.append(sum_, sums), np.append(size, sizes), np.append(0, stop)
        size, sum_ = 0, _U(0)
        if len(stop) and stop[-1] == len(data):  # open
            sum_, size = sums[-1], int(sizes[-1])
            sums, sizes = sums[:-1], sizes[:-1]
        out.append(_closed(sums, sizes))
    if size:
        out.append(_closed(np.array([sum_]), np.array([size])))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


class Permutations:
    def __init__(self, count: int = PERMUTATIONS, width: int = SHINGLE, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.a = rng.integers(0, 1 << 63, count, dtype=np.uint64) * _U(2) + _U(1)
        self.b = rng.integers(0, 1 << 63, count, dtype=np.uint64) * _U(2) + _U(1)
        self.count, self.width = count, width

    def shingles(self, texts: list[bytes]) -> list[np.ndarray]:
        """64-bit hashes of each text's shingles, in order."""
        out: list[np.ndarray] = []
        group: list[bytes] = []
        size = 0
        for t in texts:
            if group and size + len(t) > CHUNK:
                out += self._hash(group)
                group, size = [], 0
            if len(t) > CHUNK:
                words = _long_words(t)
                out += self._shingled(words, np.array([0]))
                continue
            group.append(t)
            size += len(t) + 1
        return out + (self._hash(group) if group else [])

    def _hash(self, texts: list[bytes]) -> list[np.ndarray]:
        data = _LOWER[np.frombuffer(b" ".join(texts), dtype=np.uint8)]
        text_start = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
        start, stop, sums = _runs(data)
        return self._shingled(_closed(sums, stop - start), np.searchsorted(start, text_start))

    def _shingled(self, words: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
        """Shingle hashes of each text, whose words begin at ``first``."""
        if not len(words):
            return [np.empty(0, np.uint64) for _ in first]
        last = np.append(first[1:], len(words))
        at = np.arange(len(words))
        # every word starts a shingle unless fewer than ``width`` are left
        left = np.repeat(last, last - first) - at
        keep = np.flatnonzero((left >= self.width) | (at == np.repeat(first, last - first)))
        every = np.zeros(len(keep), dtype=np.uint64)
        for k in range(self.width):  # each word is mixed with its place
            has = left[keep] > k
            every[has] += _mix(words[keep[has] + k] + _U((k + 1) * int(_STEP) % (1 << 64)))
        every = _mix(every)
        cut = np.searchsorted(keep, np.append(first, len(words)))
        return [every[cut[i]:cut[i + 1]] for i in range(len(first))]

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        best = np.full(self.count, 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
        for at in range(0, len(shingles), 2048):
            part = shingles[at:at + 2048]
            images = self.a[:, None] * part[None, :]
            images += self.b[:, None]
            np.minimum(best, images.min(axis=1), out=best)
        return (best >> _U(32)).astype(np.uint32)

    def signatures(self, texts: list[bytes]) -> list[np.ndarray]:
        return [self.signature(s) for s in self.shingles(texts)]


def written(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edit(text: str, following: str) -> str:
    """The last quarter replaced by the following text's beginning."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n] if n else text


def with_next(docs: DataFrame) -> DataFrame:
    """Rows in slices of ascending (doc_id, text), each slice in one partition
    and followed by the first rows of the next slice (column ``ahead``), so
    that every document meets its successor in one shuffle of the texts. The
    last slice is followed by the first one."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    parts = shuffle_parts(spark) * SLICES
    kind = docs.schema["doc_id"].dataType.simpleString()
    bounds = docs.select(F.percentile_approx(
        "doc_id", F.array(*[F.lit(i / parts) for i in range(1, parts + 1)]), 20 * parts)).first()[0]
    bounds = np.array(sorted(set((bounds or [])[:-1])))  # one for each slice at most

    def slices(ids: pa.Array) -> np.ndarray:
        """Bounds below each id; null ids come first."""
        values = ids.to_numpy(zero_copy_only=False)
        missing = ids.is_null().to_numpy(zero_copy_only=False)
        return np.where(missing, 0, np.searchsorted(bounds, np.where(missing, 0, values), side="left")).astype(np.int32)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(slices(batch.column(0))), batch.column(0)], ["slice", "doc_id"])

    first = (docs.select("doc_id").mapInArrow(number, f"slice int, doc_id {kind}").groupBy("slice")
             .agg(F.min("doc_id").alias("low"), F.count_if(F.col("doc_id").isNull()).alias("none"))
             .orderBy("slice").collect())  # a row for each slice
    opens = {r["slice"]: (None if r["none"] else r["low"], first[i - 1]["slice"]) for i, r in enumerate(first)}

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = slices(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.zeros(len(at), bool)), *batch.columns], names)
            ids = batch.column(0).to_pylist()
            ahead = [i for i, (s, x) in enumerate(zip(at.tolist(), ids, strict=True)) if x == opens[s][0]]
            if ahead:
                back = pa.array([opens[at[i]][1] for i in ahead], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [back, pa.array(np.ones(len(ahead), bool)), *batch.take(pa.array(ahead)).columns], names)

    names = ["slice", "ahead", "doc_id", "text"]
    return (docs.mapInArrow(route, f"slice int, ahead boolean, doc_id {kind}, text string")
            .repartition("slice").sortWithinPartitions("slice", "ahead", "doc_id", "text"))


def compare_edited(docs: DataFrame, width: int = SHINGLE, count: int = PERMUTATIONS) -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness."""
    ship(docs.sparkSession)
    rows = with_next(docs)
    kind = rows.schema["doc_id"].dataType
    schema = (f"doc_id {kind.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")

    def results(waiting: list, permutations: Permutations) -> Iterator[list]:
        """Rows for all of ``waiting`` but the last, which has no successor yet."""
        plain = permutations.signatures([w[3].encode() for w in waiting])
        pairs = [(i, edit(a[3], b[3])) for i, (a, b) in enumerate(zip(waiting, waiting[1:], strict=False))
                 if a[0] == b[0] and not a[1]]
        for (i, text), signature in zip(pairs, permutations.signatures([e.encode() for _, e in pairs]), strict=True):
            yield [waiting[i][2], len(waiting[i][3]), hashlib.sha256(text.encode()).hexdigest(), written(plain[i]),
                   written(signature), likeness(plain[i], signature), likeness(plain[i], plain[i + 1])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        permutations = Permutations(count, width)
        out = pa.schema([("doc_id", fields[0]), ("n_chars", pa.int64()), *[(n, pa.string()) for n in (
            "edited_sha256", "fingerprint", "edited_fingerprint")], ("near_edited", pa.float64()), ("near_next", pa.float64())])
        waiting: list = []
        size = 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                waiting.append(row)
                size += len(row[3])
                if size > 16 * CHUNK:
                    yield pa.RecordBatch.from_pylist(
                        [dict(zip(out.names, r, strict=True)) for r in results(waiting, permutations)], schema=out)
                    waiting, size = waiting[-1:], 0
        yield pa.RecordBatch.from_pylist(
            [dict(zip(out.names, r, strict=True)) for r in results(waiting, permutations)], schema=out)

    from pyspark.sql.pandas.types import to_arrow_type

    fields = [to_arrow_type(kind)]
    return rows.mapInArrow(run, schema)


def signatures(docs: DataFrame, width: int = SHINGLE, count: int = PERMUTATIONS) -> DataFrame:
    """(doc_id, key, signature array<int>, shingles array<long>): the distinct
    shingle hashes are carried for the exact Jaccard similarity."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        permutations = Permutations(count, width)
        for batch in batches:
            sets = [np.unique(s) for s in permutations.shingles(
                [(t or "").encode() for t in batch.column(2).to_pylist()])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([permutations.signature(s).view(np.int32) for s in sets], pa.list_(pa.int32())),
                 pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                ["doc_id", "key", "signature", "shingles"])

    return docs.select("doc_id", text_key().alias("key"), "text").mapInArrow(
        run, f"doc_id {kind}, key long, signature array<int>, shingles array<long>")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS) -> DataFrame:
    """(doc_id, key, class_id, links): class_id is the smallest doc_id of the
    documents reachable over links (Jaccard similarity of the word shingles of
    ``threshold`` or more), links counts a document's links to other sets.

    Documents with the same shingle set are one node. Candidates share a band
    of the signature; a candidate pair is kept once, under the first band both
    share, and its exact Jaccard similarity decides. Texts without words are
    one node without links to others."""
    rows = checkpointed(signatures(docs).withColumn("node", F.xxhash64("shingles")))
    per = PERMUTATIONS // bands
    nodes = checkpointed(rows.groupBy("node").agg(F.min("doc_id").alias("low"), F.first("signature").alias("signature"),
                                                  F.first("shingles").alias("shingles"))
                         .where(F.size("shingles") > 0))
    cut = [F.xxhash64(F.slice("signature", i * per + 1, per), F.lit(i)) for i in range(bands)]
    banded = nodes.select("node", F.array(*cut).alias("cut")).select("node", "cut", F.posexplode("cut").alias("band", "bucket"))
    a = banded.select(F.col("node").alias("a"), F.col("cut").alias("ca"), "band", "bucket")
    b = banded.select(F.col("node").alias("b"), F.col("cut").alias("cb"), "band", "bucket")
    same = F.zip_with("ca", "cb", lambda x, y: x == y)
    pairs = a.join(b, ["band", "bucket"]).where("a < b").where(F.array_position(same, True) == F.col("band") + 1).select("a", "b")
    sets = nodes.select("node", "shingles")
    common = F.size(F.array_intersect("sa", "sb"))
    checked = checkpointed(
        pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
        .where(common >= threshold * (F.size("sa") + F.size("sb") - common)).select("a", "b"))
    roots = components(checked)
    degree = (checked.select(F.col("a").alias("node")).unionByName(checked.select(F.col("b").alias("node")))
              .groupBy("node").agg(F.count(F.lit(1)).alias("links")))
    named = (rows.select("doc_id", "key", "node").join(roots, "node", "left").join(degree, "node", "left")
             .withColumn("root", F.coalesce("root", "node")))
    lows = named.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return named.join(lows, "root").select("doc_id", "key", "class_id", F.coalesce("links", F.lit(0)).alias("links"))


def op2_minhash(spark, sf_dir):
    """Fingerprints of all documents and of their edited forms."""
    return compare_edited(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
