"""Versioned history while events arrive: versions open and close in each micro-batch.

The state of a key is its changes of the last while, and the last one before. A new change
goes to its place among them, so a late one splits the version it falls into. Each batch
gives out the versions that are new or end at another time than before, numbered by how
often the key has been told; the highest number of a version is its state (``latest``).
Timers follow the watermark: once it has passed a change, nothing can come before that any
more, and of the changes passed the key keeps only the last, which a next one will close.

What comes later than ``lateness`` allows is left out by Spark, and counted there; the fold
over the raw log (``operators.history``) has it all the same.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import IntegralType, StructType, TimestampNTZType, TimestampType

from strandline.operators.envelope import DELETE, LOG_ORDER

REVISION = "revision"
_ROW, _PLACE, _APART, _FROM, _TO = "__row", "__place", "__apart", "__from", "__to"
# All digits of a time, so that rows come out of the state as they went in.
_EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _comparable(schema: StructType, column: str) -> Column:
    """A value whose order survives JSON: times and whole numbers as numbers, others as text."""
    kind = schema[column].dataType
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    return F.col(column).cast("long" if isinstance(kind, IntegralType) else "string")


def _sortable(place: list) -> tuple:
    """NULL before all values, as Spark sorts it."""
    return tuple((x is not None, 0 if x is None else x) for x in place)


def _ends(places: list[list]) -> dict[tuple, int | None]:
    """When the version of each place ends."""
    following = [*(place[0] for place, _ in places[1:]), None]
    return {tuple(place): end for (place, _), end in zip(places, following)}


def _fold(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    places, revision = json.loads(state.get[0]) if state.exists else ([], 0)  # [[place, row], …], in order
    told = []
    if not state.hasTimedOut:
        before = _ends(places)
        seen = set(before)
        for frame in frames:
            for text, row in zip(frame[_PLACE], frame[_ROW], strict=True):
                place = list(json.loads(text).values())
                if tuple(place) not in seen:
                    seen.add(tuple(place))
                    places.append([place, row])
        places.sort(key=lambda p: _sortable(p[0]))
        revision += 1
        now = _ends(places)
        for place, row in places:
            end = now[tuple(place)]
            if before.get(tuple(place), -1) != end:
                told.append((row, place[0], end, revision))
    mark = state.getCurrentWatermarkMs()
    passed = sum(place[0] // 1000 < mark for place, _ in places)
    places = places[max(0, passed - 1) :]
    if pd.isna(group[-1]):  # rows without a key follow nothing and need no state
        state.update((json.dumps([places, revision]),))
        if len(places) > 1:
            state.setTimeoutTimestamp(max(mark, places[-1][0][0] // 1000) + 1)
    if told:
        yield pd.DataFrame(told, columns=[_ROW, _FROM, _TO, REVISION]).astype({_TO: "Int64"})


def stream_versions(
    changes: DataFrame,
    key: str | Sequence[str],
    order_by: Sequence[str] = LOG_ORDER,
    *,
    lateness: str = "1 day",
) -> DataFrame:
    """The versions that each micro-batch opens, closes or splits, with ``revision``.

    ``changes`` is a stream. ``order_by`` is a total order within a key and starts with the
    change's time, a timestamp; text columns in it are compared as text. A change that
    comes again is no new one. Deletes close a version and are among the rows; ``latest``
    leaves them out. Rows without a key are each their own version; rows without a time
    are in no history.
    """
    keys, order_by = [key] if isinstance(key, str) else list(key), list(order_by)
    at, schema = order_by[0], changes.schema
    place = F.struct(*[_comparable(schema, c).alias(f"p{i}") for i, c in enumerate(order_by)])
    unknown = F.lit(False)
    for name in keys:
        unknown = unknown | F.col(name).isNull()
    rows = changes.where(F.col(at).isNotNull()).select(
        *keys,
        F.col(at).cast("timestamp").alias("__at"),
        F.when(unknown, F.xxhash64(*order_by)).alias(_APART),
        F.to_json(place, {"ignoreNullFields": "false"}).alias(_PLACE),
        F.to_json(F.struct(*changes.columns), {"ignoreNullFields": "false", **_EXACT}).alias(_ROW),
    )
    told = (
        rows.withWatermark("__at", lateness)
        .groupBy(*keys, _APART)
        .applyInPandasWithState(
            _fold,
            f"{_ROW} string, {_FROM} long, {_TO} long, {REVISION} long",
            "kept string",
            "append",
            GroupStateTimeout.EventTimeTimeout,
        )
    )
    row = F.from_json(_ROW, schema, _EXACT)
    return told.select(
        *[row[c].alias(c) for c in changes.columns],
        F.timestamp_micros(_FROM).alias("valid_from"),
        F.timestamp_micros(_TO).alias("valid_to"),
        F.col(_TO).isNull().alias("is_current"),
        REVISION,
    )


def follow(versions: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write what each micro-batch tells into its own folder ``batch_id=N`` and stop.

    A batch that is run again after a failure replaces its own folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")

    writer = versions.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def latest(
    spark: SparkSession,
    path: str,
    key: str | Sequence[str],
    order_by: Sequence[str] = LOG_ORDER,
    *,
    operation: str | None = "operation",
) -> DataFrame:
    """The versions as last told: what the fold over all changes gives."""
    keys = [key] if isinstance(key, str) else list(key)
    told = spark.read.parquet(path).drop("batch_id")
    identity = list(dict.fromkeys([*keys, *order_by]))
    rest = [c for c in told.columns if c not in identity]
    newest = told.groupBy(*identity).agg(F.max_by(F.struct(*rest), REVISION).alias("newest"))
    rows = newest.select(*[F.col(c) if c in identity else F.col("newest")[c].alias(c) for c in told.columns]).drop(REVISION)
    return rows.where(F.col(operation) != DELETE) if operation else rows
