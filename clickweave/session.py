"""Session construction (K11) and shared-storage locations.

Nothing here hard-codes endpoints or credentials: callers pass a ``conf``
mapping (from their own config or environment) and it is applied verbatim.
"""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Defaults every job relies on. Calendar fields are computed on UTC wall-clock
# timestamps, ANSI stays on (bad literals fail instead of matching nothing),
# AQE re-plans joins and coalesces/splits partitions at runtime.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.compression.codec": "snappy",
    # keyed stream state outside the heap, stored as changes at each batch
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app_name: str = "clickweave", master: str | None = None,
                  conf: Mapping[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the base settings plus ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in BASE_CONF.items():
        if key.startswith("spark.sql.") and not (conf and key in conf):
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A location under the cluster's shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` from the session. Only when it is unset
    (local tests) a directory is chosen and registered, so that
    ``DataFrame.checkpoint()`` and stream checkpoints land in the same place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        # an application of one process; local-cluster counts as a cluster
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="clickweave-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    else:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(base)
    return os.path.join(base, *parts) if parts else base


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SHUFFLE_TARGET_BYTES = 128 << 20


def initial_partitions(size: int, least: int, target: int = SHUFFLE_TARGET_BYTES) -> int:
    """Shuffle partitions so that one holds ``target`` bytes of ``size``."""
    return max(least, min(200_000, -(-size // target)))


@contextmanager
def sized_shuffles(df: DataFrame) -> Iterator[int]:
    """Run a job with as many initial shuffle partitions as the size of its
    input asks for. AQE merges small partitions, but it does not split large
    ones of an aggregate or a window, so the start must be high enough."""
    spark = df.sparkSession
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    n = initial_partitions(size, int(spark.conf.get("spark.sql.shuffle.partitions")))
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    spark.conf.set(INITIAL_PARTITIONS, str(n))
    try:
        yield n
    finally:
        if before is None:
            spark.conf.unset(INITIAL_PARTITIONS)
        else:
            spark.conf.set(INITIAL_PARTITIONS, before)
