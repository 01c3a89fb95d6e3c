"""Cut documents into shards along a Hilbert curve through their metadata.

Each dimension (here source, language and size) is quantised to ``BITS`` bits
by its own quantiles over all rows (numbers: approximate ones; strings: exact
ones of whole values, from counts per distinct value), so a skewed dimension
still spreads over the grid. The cell's index on the Hilbert curve orders the rows;
neighbours on the curve are neighbours in every dimension, so a run of the
curve has a narrow range in each of them and a filter on any of them skips
most shards (``manifest`` gives the ranges). The run is cut by rows:
``shard = index * shards / N``, so shard counts differ by one at most, however
many rows share a cell, a source or a text.

The text is read once for its size and CRC; only the metadata is shuffled.
Rows of one cell are ordered by text CRC, then id, so equal texts with equal
metadata stay side by side, and a hot cell is split across range partitions.

Defined results: null text has size 8 and CRC 0 (as the empty text); nulls of
any dimension come first in it; rows equal in everything are interchangeable;
a very long text counts by its bytes and stays one row (a shard may then be
much larger than another: the law is that of rows); other columns are ignored
by ``shard`` and kept by ``write_shards``, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave.llm.common import checkpointed, global_index, read_table, ship, shuffle_parts

BITS = 8
SHARDS = 24
OVERHEAD = 8  # bytes that a row takes besides its text
QUANTILE_ACCURACY = 10_000
DIMS = ("source", "lang", "size")


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Curve index of each row of ``cells`` (n x dims, values below 2**bits):
    Gray-code rotations undone bit plane by bit plane, for all rows at once."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where((x[-1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            index = (index << 1) | ((x[i] >> b) & 1)
    return index


def _string_bounds(df: DataFrame, name: str, parts: int) -> list[bytes]:
    """The values at the ``parts`` - 1 inner quantiles of the rows, by UTF-8
    bytes; whole values, however long their common prefixes. Counts per distinct
    value are placed by one range exchange; only a sum per partition and the
    bounds themselves come to the driver."""
    counts = df.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    placed = checkpointed(counts.repartitionByRange(shuffle_parts(df.sparkSession), "value")
                          .withColumn("_part", F.spark_partition_id()))
    starts, total = [], 0
    for part, n in sorted(placed.groupBy("_part").agg(F.sum("n")).collect()):
        starts.append((part, total))
        total += n
    if not total:
        return []
    start = df.sparkSession.createDataFrame(starts, "_part int, _start long")  # a row per partition
    upto = F.col("_start") + F.sum("n").over(Window.partitionBy("_part").orderBy("value"))
    # the first quantile above what lies before the value: is it in the value?
    quantile = F.expr(f"(upto - n) * {parts} div {total} + 1")
    return sorted(r["value"].encode() for r in
                  placed.join(F.broadcast(start), "_part").withColumn("upto", upto)
                  .where((quantile < parts) & (quantile * total <= F.col("upto") * parts)).select("value").collect())


def _bounds(df: DataFrame, dims: Sequence[str], parts: int) -> list:
    """Per dimension at most ``parts`` - 1 bounds: doubles, or bytes of strings."""
    text = [d for d in dims if isinstance(df.schema[d].dataType, T.StringType)]
    fractions = F.array(*[F.lit((i + 1) / parts) for i in range(parts - 1)])
    numbers = [d for d in dims if d not in text]
    row = df.select(*[F.percentile_approx(F.col(d).cast("double"), fractions, QUANTILE_ACCURACY).alias(d)
                      for d in numbers]).first() if numbers else {}
    return [_string_bounds(df, d, parts) if d in text else np.unique(np.asarray(row[d] or [], dtype=np.float64))
            for d in dims]


def _cells(values: pd.Series, edges, side: int) -> np.ndarray:
    """Cell of each value between the edges; few distinct values are spread
    over the whole side; nulls take cell 0."""
    if isinstance(edges, list):
        codes, distinct = pd.factorize(values)  # nulls: -1
        found = np.array([*(bisect_right(edges, v.encode()) for v in distinct), 0], dtype=np.int64)[codes]
        missing = codes < 0
    else:
        number = values.to_numpy(dtype=np.float64, na_value=np.nan)
        found, missing = np.searchsorted(edges, number, side="right"), np.isnan(number)
    return np.where(missing, 0, (found + 1) * side // (len(edges) + 1))


def curve(df: DataFrame, dims: Sequence[str], bits: int = BITS) -> DataFrame:
    """Add ``curve``: the Hilbert index of the row's quantised dimensions."""
    ship(df.sparkSession)
    bounds = _bounds(df, dims, 1 << bits)

    @F.pandas_udf("long")
    def index(parts: pd.DataFrame) -> pd.Series:
        cells = np.empty((len(parts), len(bounds)), dtype=np.int64)
        for i, edges in enumerate(bounds):
            cells[:, i] = _cells(parts.iloc[:, i], edges, (1 << bits) - 1)
        return pd.Series(hilbert_index(cells, bits))

    return df.withColumn("curve", index(F.struct(*[
        (F.col(d) if isinstance(b, list) else F.col(d).cast("double")).alias(f"d{i}")
        for i, (d, b) in enumerate(zip(dims, bounds, strict=True))])))


def _metadata(docs: DataFrame, dims: Sequence[str], *more: Column) -> DataFrame:
    return docs.select(
        "doc_id", *[d for d in dims if d not in ("size", "doc_id")],
        (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"), *more)


def _place(meta: DataFrame, shards: int, dims: Sequence[str], bits: int) -> DataFrame:
    order = ["curve", "text_crc32", "doc_id", "size"]
    rows, total = global_index(curve(meta, dims, bits), order)
    number = F.expr(f"index * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")
    return (rows.withColumn("shard", number.cast("int"))
            .withColumn("slot", (F.col("index") - first).cast("long")).drop("index"))


def shard(docs: DataFrame, shards: int = SHARDS, dims: Sequence[str] = DIMS, bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, the dimensions, curve, shard, slot."""
    return _place(checkpointed(_metadata(docs, dims)), shards, dims, bits)


def manifest(sharded: DataFrame, dims: Sequence[str] = DIMS) -> DataFrame:
    """Per shard: rows, bytes and the range of each dimension."""
    return sharded.groupBy("shard").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"),
        *[f(d).alias(f"{n}_{d}") for d in dims for n, f in (("min", F.min), ("max", F.max))])


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, dims: Sequence[str] = DIMS, bits: int = BITS) -> DataFrame:
    """Write the documents as one folder per shard, in curve order; returns the
    manifest. All columns are kept, repeated ids and rows too. The folders'
    column is ``shard``, with as many ``_`` behind it as it takes to differ from
    the documents' own columns. Whole rows go through one range exchange."""
    folder = "shard"
    while folder in {c.lower() for c in docs.columns}:
        folder += "_"
    placed = _place(_metadata(docs, dims, F.struct("*").alias("document")), shards, dims, bits)
    placed.select("document.*", F.col("shard").alias(folder)).write.partitionBy(folder).parquet(path)
    return manifest(placed, dims)


def op7_sharding(spark, sf_dir):
    """All documents in 24 shards along the curve, by the law of equal rows."""
    rows = shard(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"), "curve")
