"""Typed changes as a stream: the duplicate guard and the replay-safe log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strandline.operators.envelope import WRITES, Entity, read_changes


def guard_duplicates(log: DataFrame, within: str = "1 hour") -> DataFrame:
    """Drop events a relay delivered again under new offsets.

    A message without a value is no copy of another and always passes. Else
    the same key and text is the same change: the text holds the operation,
    the source time and both images. What has been seen is remembered for
    ``within``. The clock is that of the micro-batches, so no event is ever too
    late and none is lost; ``history.drop_redelivered`` removes copies that
    come back after that time.
    """
    place = F.concat_ws("/", *[F.col(c).cast("string") for c in ("topic", "partition", "offset")])
    return (
        log.withColumn("__digest", F.coalesce(F.unhex(F.sha2(F.col("value"), 256)), place.cast("binary")))
        .withColumn("__seen_at", F.current_timestamp())
        .withWatermark("__seen_at", within)
        .dropDuplicatesWithinWatermark(["topic", "key", "__digest"])
        .drop("__digest", "__seen_at")
    )


def append_changes(
    log: DataFrame,
    entity: Entity,
    path: str,
    checkpoint: str,
    operations: tuple[str, ...] = WRITES,
) -> StreamingQuery:
    """Decode each micro-batch into its own folder ``batch_id=N``.

    A batch that is run again after a failure replaces its own folder, so
    repeats leave no trace. The history stays a fold over all folders.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        read_changes(batch, entity, operations).write.mode("overwrite").parquet(
            f"{path.rstrip('/')}/batch_id={batch_id}"
        )

    return (
        log.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
