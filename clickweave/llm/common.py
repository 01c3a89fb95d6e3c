"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickweave.session import shared_dir

# A word is a run of anything but space and the ASCII control blanks.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

# Texts go to Python in batches of about so many bytes: Spark's own limit counts
# rows, and 10,000 long texts would fill a worker.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Make the session fit for Python workers over texts: batches limited by
    bytes, and this package sent to the executors once per application, as
    ``spark-submit --py-files`` would."""
    sc = spark.sparkContext
    if sc.getConf().get(_BATCH_SETTING) is None:  # a configured limit stays
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    if getattr(sc, "_clickweave_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="clickweave-"), "clickweave.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    at = os.path.join(folder, name)
                    z.write(at, os.path.relpath(at, os.path.dirname(package)))
    sc.addPyFile(archive)
    sc._clickweave_shipped = True


def release() -> None:
    """Give freed memory back to the system. Python workers are kept for later
    tasks, and what one of them holds on to is missing to the executor."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def releasing(run):
    """``run`` (batches -> batches), followed by ``release``."""
    def wrapped(batches):
        yield from run(batches)
        release()

    return wrapped


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def text_key(text: str | Column = "text") -> Column:
    """64-bit hash of a text; with ``doc_id`` it identifies a row's content,
    so rows that share an id but not a text stay apart."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def global_index(df: DataFrame, order: Sequence[str], name: str = "index") -> tuple[DataFrame, int]:
    """Number the rows 0..N-1 in the given order; returns (numbered frame, N).

    One range exchange and a sort within partitions. Only the row count of
    each partition comes to the driver. Rows equal in every order column are
    interchangeable; their order is arbitrary.
    """
    spark = df.sparkSession
    placed = checkpointed(
        df.repartitionByRange(shuffle_parts(spark), *order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    counts = sorted((r["_part"], r["n"]) for r in
                    placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect())
    starts, total = [], 0
    for part, n in counts:
        starts.append((part, total))
        total += n
    # one row per partition: bounded by the number of shuffle partitions
    start = spark.createDataFrame(starts, "_part int, _start long")
    return (placed.join(F.broadcast(start), "_part")
            .withColumn(name, F.col("_start") + F.col("_row"))
            .drop("_part", "_row", "_start")), total


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b): one row (node, root) for each
    node on an edge; root is the smallest node of its component.

    Alternating large-star and small-star steps; every round is two
    aggregations and joins on the node, cut by a checkpoint. Nothing but the
    change counter reaches the driver. ``max_rounds`` only guards against an
    endless loop (it raises); the rounds needed grow with the logarithm of the
    longest chain.
    """
    cur = checkpointed(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                       .where("a <> b").distinct())
    for _ in range(max_rounds):
        large = _star(cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b"))), large=True)
        nxt = checkpointed(_star(large, large=False))
        changed = nxt.exceptAll(cur).limit(1).count() + cur.exceptAll(nxt).limit(1).count()
        cur = nxt
        if not changed:
            return (cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
                    .unionByName(cur.select(F.col("b").alias("node"), F.col("b").alias("root")))
                    .distinct())
    raise RuntimeError("components did not converge")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link neighbours of a node to the smallest node of its neighbourhood:
    those above the node (large star; ``edges`` holds both directions), or
    those below it and the node itself (small star; a > b throughout)."""
    low = edges.groupBy("a").agg(F.min("b").alias("low")).select(
        "a", (F.least("a", "low") if large else F.col("low")).alias("low"))
    joined = edges.join(low, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        out = (joined.select(F.col("b").alias("a"), F.col("low").alias("b"))
               .unionByName(low.select("a", F.col("low").alias("b"))))
    return out.where("a <> b").distinct()


def prefix_sums(df: DataFrame, keys: Sequence[str], order: str, value: str, name: str) -> DataFrame:
    """Running total of ``value`` before each row, per ``keys`` in ``order``;
    meant for pre-aggregated rows (a bounded number per key)."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.coalesce(F.sum(value).over(w), F.lit(0)))
