"""Near duplicates by SimHash, linked through vantage-point trees.

Fingerprint: A-Z is lower-cased in the whole text, words are runs of anything
but ASCII blanks, shingles are ``SHINGLE`` words joined by single spaces with
repeats (a shorter text is one shingle, none gives fingerprint 0). A bit is 1
if it is set in over half of the shingles' XXH64 (seed 42).

Links: two fingerprints at ``MAX_BITS`` or fewer differing bits. Distances of
unrelated 64-bit fingerprints crowd around 32, so one tree over all bits could
prune little within 4 bits of a boundary. The fingerprint is therefore cut
into ``BLOCKS`` blocks: fingerprints within d bits agree in some block up to
d // BLOCKS bits. Every block has a vantage-point tree, built on a bounded
sample (``SAMPLE`` fingerprints; it only sets the shard limits, no result).
A node sends what is nearer to its vantage point than its radius to one child
and the rest to the other, and by the triangle inequality only fingerprints
within the block radius of the boundary are also sent to the other child as
guests. Each leaf is a shard, its members are compared with each other and
with the guests in full 64-bit distance, in numpy blocks. A shard that holds
more than ``SHARD_ROWS`` rows is cut into chunks that meet pairwise, so no
group is unbounded. The number of shards grows with the data.

Equal fingerprints are one node from the start (partial aggregation), so a
group of copies never forms pairs. A shard returns a spanning forest of its
links, not all pairs: components stay the same. The components of the whole
come from alternating large-star and small-star rounds in Spark.

Defined results: a null text is an empty one (fingerprint 0); every document
without words has fingerprint 0 and is linked like any other; component_id is
the smallest non-null doc_id reachable, null if there is none; repeated rows
are returned once each; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickweave.llm.common import checkpointed, components, read_table, release, releasing, ship, text_key

SHINGLE = 4
MAX_BITS = 4
BLOCKS = 4
BLOCK_BITS = 64 // BLOCKS
SAMPLE = 16_384
LEAF = 512          # members a shard should have
SHARD_ROWS = 8_192  # members and guests that are compared in one group
MAX_DEPTH = 14
_BITS = np.uint64((1 << BLOCK_BITS) - 1)


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """The fingerprint of one text, as an unsigned 64-bit integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    flat = b" ".join(words)
    n = max(1, len(words) - width + 1)
    stops = ends[width - 1:] if len(words) >= width else ends[-1:]
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 65_536):  # bounded memory for very long texts
        part = range(at, min(n, at + 65_536))
        hashes = np.fromiter((xxhash.xxh64_intdigest(flat[a:b], 42) for a, b in
                              zip(starts[at:part.stop].tolist(), stops[at:part.stop].tolist(), strict=True)),
                             np.uint64, len(part))
        ones += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """(doc_id, key, fp): key hashes the text, fp is the fingerprint as a
    signed long."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), width) for t in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], ["doc_id", "key", "fp"])

    return docs.select("doc_id", text_key().alias("key"), "text").mapInArrow(releasing(run), f"doc_id {kind}, key long, fp long")


class Tree:
    """A vantage-point tree over block values; leaves are numbered."""

    def __init__(self, values: np.ndarray, depth: int, seed: int):
        self.rng = np.random.default_rng(seed)
        self.nodes: list[tuple[int, int, int, int]] = []  # vantage, radius, near child, far child
        self.leaves = 0
        self.root = self._grow(values, depth)

    def _grow(self, values: np.ndarray, depth: int) -> int:
        if depth == 0 or len(np.unique(values)) < 2:
            self.leaves += 1
            return -self.leaves
        best = None
        for vantage in self.rng.choice(values, 8):
            d = np.bitwise_count(values ^ vantage)
            radius = int(np.median(d))
            for r in (radius - 1, radius):
                share = float((d <= r).mean())
                crowd = float(((d == r) | (d == r + 1)).mean())
                if 0 < share < 1 and (best is None or (score := abs(share - 0.5) + crowd) < best[0]):
                    best = (abs(share - 0.5) + crowd, vantage, r, d <= r)
        if best is None:
            self.leaves += 1
            return -self.leaves
        _, vantage, radius, near = best
        at = len(self.nodes)
        self.nodes.append((0, 0, 0, 0))
        self.nodes[at] = (int(vantage), radius, self._grow(values[near], depth - 1), self._grow(values[~near], depth - 1))
        return at

    def route(self, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, leaf, is a member): each value is a member of one leaf, and a
        guest where a member within ``radius`` may be that it has not met."""
        out, todo = [], [(self.root, np.arange(len(values)), np.ones(len(values), dtype=bool))]
        while todo:
            node, rows, home = todo.pop()
            if not len(rows):
                continue
            if node < 0:
                out.append((rows, np.full(len(rows), -node - 1), home))
                continue
            vantage, limit, near, far = self.nodes[node]
            d = np.bitwise_count(values[rows] ^ np.uint64(vantage)).astype(np.int64)
            inside = d <= limit
            to_near = inside | (d - radius <= limit)
            # members inside need not visit the far side: its members near the
            # boundary come here as guests
            to_far = ~inside | (~home & (d + radius > limit))
            todo.append((near, rows[to_near], home[to_near] & inside[to_near]))
            todo.append((far, rows[to_far], home[to_far] & ~inside[to_far]))
        if not out:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _block(fp: np.ndarray, i: int) -> np.ndarray:
    return (fp >> np.uint64(i * BLOCK_BITS)) & _BITS


def forest(fp: np.ndarray, member: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest (as index pairs) of the links between rows of which at
    least one is a member."""
    label = np.arange(len(fp))
    left = np.flatnonzero(member)
    for at in range(0, len(left), 256):
        rows = left[at:at + 256]
        near = np.bitwise_count(fp[rows][:, None] ^ fp[None, :]) <= max_bits
        i, j = np.nonzero(near)
        i = rows[i]
        while True:
            a, b = label[i], label[j]
            open_ = a != b
            if not open_.any():
                break
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while (label[label] != label).any():
                label = label[label]
    linked = np.flatnonzero(label != np.arange(len(fp)))
    return linked, label[linked]


def link(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) whose components
    are those of all pairs within ``max_bits``."""
    ship(fps.sparkSession)
    nodes = checkpointed(fps.select("fp").distinct())
    total = nodes.count()
    sample = np.array([r["fp"] for r in nodes.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()], dtype=np.int64)
    depth = min(MAX_DEPTH, max(0, int(np.ceil(np.log2(max(1, total / LEAF))))))
    trees = [Tree(_block(sample.view(np.uint64), i), depth, i) for i in range(BLOCKS)]
    radius = max_bits // BLOCKS

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            for i, tree in enumerate(trees):
                rows, leaf, home = tree.route(_block(fp.view(np.uint64), i), radius)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf * BLOCKS + i, pa.int64()), pa.array(fp[rows]), pa.array(home)],
                    ["shard", "fp", "member"])

    routed = nodes.repartition("fp").mapInArrow(releasing(route), "shard long, fp long, member boolean")
    routed = checkpointed(routed)
    # shards over the bound are cut into chunks that meet pairwise
    large = (routed.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SHARD_ROWS)
             .select("shard", F.ceil(F.col("n") * 2 / SHARD_ROWS).cast("int").alias("chunks")))
    chunked = (routed.join(large, "shard", "left")
               .withColumn("chunks", F.coalesce("chunks", F.lit(1)))
               .withColumn("chunk", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("chunks")).cast("int"))
               .withColumn("meets", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
               .select("shard", F.least("chunk", "meets").alias("c1"), F.greatest("chunk", "meets").alias("c2"),
                       "fp", "member"))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        fp = pdf["fp"].to_numpy()
        a, b = forest(fp.view(np.uint64), pdf["member"].to_numpy(), max_bits)
        release()
        return pd.DataFrame({"a": fp[a], "b": fp[b]})

    return checkpointed(chunked.groupBy("shard", "c1", "c2").applyInPandas(compare, "a long, b long").distinct())


def near_duplicates(docs: DataFrame, width: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, key, fp, root, component_id), one row per document; root is a
    fingerprint that stands for the component."""
    fps = checkpointed(fingerprints(docs, width))
    roots = components(link(fps, max_bits)).withColumnRenamed("node", "fp")
    smallest = fps.groupBy("fp").agg(F.min("doc_id").alias("low"))
    named = smallest.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lows = checkpointed(named.groupBy("root").agg(F.min("low").alias("component_id")))
    per_fp = named.select("fp", "root").join(lows, "root")
    return fps.join(per_fp, "fp").select("doc_id", "key", "fp", "root", "component_id")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One document of each group: that with the smallest id (nulls last)."""
    found = near_duplicates(docs, **options)
    kept = found.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("d"), F.col("key").alias("k"))).alias("m"))
    kept = kept.select(F.col("m.d").alias("_near_id"), F.col("m.k").alias("_near_text"))
    keyed = docs.withColumn("_near_key", text_key())
    one = Window.partitionBy("_near_key", "doc_id").orderBy(F.lit(1))
    return (keyed.join(kept, keyed["doc_id"].eqNullSafe(kept["_near_id"]) & (keyed["_near_key"] == kept["_near_text"]),
                       "left_semi")
            .withColumn("_near_row", F.row_number().over(one)).where("_near_row = 1")
            .select(*docs.columns))


def op1_simhash(spark, sf_dir):
    """Fingerprint and component of every document."""
    rows = near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
