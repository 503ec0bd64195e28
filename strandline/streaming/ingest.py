"""Streaming a change log into the raw append-only table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

# The columns a Kafka source delivers, for file sources that stand in for one.
LOG_SCHEMA = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
)
# What the raw table holds.
BRONZE_SCHEMA = (
    "key string, value string, topic string, partition int, offset bigint, "
    "kafka_timestamp timestamp, ingested_at timestamp"
)


def kafka_options(servers: str, topics: Sequence[str], per_trigger: int | None = None) -> dict[str, str]:
    """Options to subscribe from the earliest offset; ``per_trigger`` bounds a batch.

    Security settings are the caller's to add (``kafka.security.protocol`` …).
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
    }
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def stream_source(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str],
    schema: str | StructType | None = None,
    path: str | None = None,
) -> DataFrame:
    """An unbounded log from any streaming format (``kafka``, ``parquet``, ``json`` …)."""
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def bronze_projection(log: DataFrame) -> DataFrame:
    return log.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
    )


def stamp_ingest(log: DataFrame) -> DataFrame:
    """Add the time of the micro-batch, the same for all of its rows."""
    return log.withColumn("ingested_at", F.current_timestamp())


def append_to_table(
    stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Append what there is to a parquet table and stop.

    The checkpoint holds the offsets, and the file sink's log names the files
    of finished batches, so a restarted query neither loses nor repeats rows.
    """
    writer = stream.writeStream.format("parquet").outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return (
        writer.option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_once(
    stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """The whole step: project, stamp, append all that is available, wait."""
    query = append_to_table(stamp_ingest(bronze_projection(stream)), path, checkpoint, partition_by)
    query.awaitTermination()
    return query
