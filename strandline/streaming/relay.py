"""Forwarding a log under other topic names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def relay(log: DataFrame, topic_map: Mapping[str, str]) -> DataFrame:
    """Key and value unchanged, topic renamed; an unlisted topic keeps its name."""
    topic = F.col("topic")
    if topic_map:
        pairs = F.create_map(*[F.lit(x) for pair in topic_map.items() for x in pair])
        topic = F.coalesce(F.try_element_at(pairs, topic), topic)
    return log.select("key", "value", topic.alias("topic"))


def start_relay(
    log: DataFrame,
    topic_map: Mapping[str, str],
    fmt: str,
    options: Mapping[str, str],
    checkpoint: str,
    ledger: str,
    path: str | None = None,
) -> StreamingQuery:
    """Relay what is available, batch by batch (``kafka`` reads the topic column).

    With a ``path`` each micro-batch has its own folder ``batch_id=N``. Its number
    of events goes into the ``ledger`` likewise; a batch that is run again replaces
    both, so the ledger counts every event once.
    """

    def forward(batch: DataFrame, batch_id: int) -> None:
        passed = Observation()
        writer = (
            batch.observe(passed, F.count("*").alias("events")).write.format(fmt).options(**options)
        )
        if path:
            writer.mode("overwrite").save(f"{path.rstrip('/')}/batch_id={batch_id}")
        else:
            writer.mode("append").save()
        counted = batch.sparkSession.range(1).select(F.lit(passed.get["events"]).alias("events"))
        counted.write.mode("overwrite").parquet(f"{ledger.rstrip('/')}/batch_id={batch_id}")

    return (
        relay(log, topic_map)
        .writeStream.foreachBatch(forward)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def forwarded(spark: SparkSession, ledger: str) -> DataFrame:
    """(batch_id, events): what the relay has passed on, in all its runs."""
    return spark.read.parquet(ledger).select("batch_id", "events")
