"""Streaming sources for broker records.

``kafka`` is the production source. Any file format Spark streams
(``parquet``, ``json``...) works as a stand-in carrying the same envelope
columns (``key``, ``value``, ``partition``, ``offset``), which is how tests
run without a broker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickweave import schema

def read_records(
    spark: SparkSession,
    source: str = "kafka",
    *,
    topic: str | None = None,
    bootstrap_servers: str | None = None,
    path: str | None = None,
    starting_offsets: str = "earliest",
    max_records_per_trigger: int | None = None,
    max_files_per_trigger: int | None = None,
    fail_on_data_loss: bool = True,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """An unbounded frame of envelope records.

    S1 subscribe, S2 ``startingOffsets`` (earliest by default), S3 rate limit
    (none by default, so a busy topic never falls behind; records for the
    broker, files for a file source), S4 ``failOnDataLoss`` -- on by default; pass ``False`` to tolerate offsets
    lost to retention, as the original did.
    """
    reader = spark.readStream.format(source)
    if source == "kafka":
        if not (topic and bootstrap_servers):
            raise ValueError("kafka source needs topic and bootstrap_servers")
        reader = (reader.option("kafka.bootstrap.servers", bootstrap_servers)
                        .option("subscribe", topic)
                        .option("startingOffsets", starting_offsets)
                        .option("failOnDataLoss", str(fail_on_data_loss).lower()))
        if max_files_per_trigger:
            raise ValueError("max_files_per_trigger is for file sources")
        if max_records_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", int(max_records_per_trigger))
    else:
        if not path:
            raise ValueError(f"{source} source needs a path")
        reader = reader.schema(schema.ENVELOPE)
        if max_records_per_trigger:
            raise ValueError("max_records_per_trigger is for the broker source")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    try:
        return reader.load(path) if path else reader.load()
    except Exception as exc:
        if source == "kafka" and "kafka" in str(exc).lower():
            raise RuntimeError(
                "the kafka source needs the spark-sql-kafka package on the classpath"
            ) from exc
        raise
