"""Finding keys that hold too much of a table, and cutting them into slices.

A window partitioned by key puts a whole key into one task. That is right for
almost every key and hopeless for one that holds a third of the table. The
functions here find such keys with a sketch (one pass over the key columns)
and choose cut points in the key's whole order, so that its rows form
consecutive slices of about equal size, also where many of them share one time.
``ordered.py`` computes within slices and hands the few values at the slice
edges across.

A slice has a 20,000th of the table, and a million rows at least, so there are
about 20,000 slices at most; a key may have any number of them. What reaches the
driver is the list of crowded keys, no more than ``_TRACKED_KEYS``. Cut points
are taken from a sample of the crowded keys and written to the shared folder, so
a lost executor that is recomputed finds the same slices.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.session import shared_dir

_TRACKED_KEYS = 10_000
_SKETCH_ITEMS = 100_000
_MAX_SLICES = 20_000
_CUTS_PER_GROUP = 64
# Rows of a slice that are looked at to place its end.
_SAMPLE_PER_SLICE = 256
MIN_ROWS_PER_SLICE = 1_000_000

SLICE = "__slice"
HOT = "__hot"
_HASH = "__key_hash"
_FINE = "__fine_cuts"
_COARSE = "__coarse_cuts"


@dataclass(frozen=True)
class HotKeys:
    """Cut points per hot key; ``cuts`` is None where no key is hot."""

    keys: tuple[str, ...]
    order_by: tuple[str, ...]
    cuts: DataFrame | None


def _key_hash(keys: Sequence[str]) -> Column:
    # Two keys that share a hash only share cut points, which is harmless.
    return F.xxhash64(*[F.col(k) for k in keys])


def _hashed(df: DataFrame, keys: Sequence[str], *columns: Column) -> DataFrame:
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    return df.where(known).select(_key_hash(keys).alias(_HASH), *columns)


def _slice_counts(hashed: DataFrame, rows_per_slice: int | None) -> tuple[int, dict[int, int]]:
    """Rows of a slice, and key hash to number of slices for the crowded keys."""
    sketch = hashed.agg(
        F.count("*").alias("total"),
        F.expr(f"approx_top_k({_HASH}, {_TRACKED_KEYS}, {_SKETCH_ITEMS})").alias("top"),
    )
    if rows_per_slice:
        limit = F.lit(rows_per_slice)
    else:
        limit = F.greatest(F.lit(MIN_ROWS_PER_SLICE), F.floor(F.col("total") / _MAX_SLICES))
    crowded = F.filter("top", lambda item: item["count"] > limit)
    found = sketch.select(limit.alias("limit"), crowded.alias("crowded")).first()
    counts = {
        item["item"]: math.ceil(item["count"] / found["limit"]) for item in found["crowded"] or ()
    }
    return int(found["limit"] or 0), counts


def find_hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str | Sequence[str],
    rows_per_slice: int | None = None,
    log: DataFrame | None = None,
    message_key: str = "key",
) -> HotKeys:
    """Find the keys with more than ``rows_per_slice`` rows and cut them up.

    ``order_by`` is the order of a key's rows. The default slice size is a
    20,000th of the table, and at least a million rows.

    Where ``df`` is decoded from a ``log``, its message keys are looked at
    first: they name the same rows, and reading them parses nothing. Only if
    one of them is crowded is the decoded side looked at.
    """
    keys = tuple(keys)
    order_by = (order_by,) if isinstance(order_by, str) else tuple(order_by)
    if log is not None and not crowded(log, message_key, rows_per_slice):
        return HotKeys(keys, order_by, None)
    place = F.struct(*[F.col(c) for c in order_by])
    hashed = _hashed(df, keys, place.alias("at"))
    limit, slices = _slice_counts(hashed, rows_per_slice)
    if not slices:
        return HotKeys(keys, order_by, None)

    # The same rows are in the sample whenever it is taken. Every so many of
    # them, in order, end a slice.
    spark = df.sparkSession
    wanted = spark.createDataFrame(list(slices.items()), f"{_HASH} long, slices int")
    every = max(1, limit // _SAMPLE_PER_SLICE)
    in_order = Window.partitionBy(_HASH).orderBy("at")
    sample = (
        hashed.where(F.pmod(F.xxhash64("at"), F.lit(every)) == 0)
        .join(F.broadcast(wanted), _HASH)  # at most _TRACKED_KEYS rows
        .withColumn("n", F.count("*").over(Window.partitionBy(_HASH)))
        .withColumn("part", F.floor((F.row_number().over(in_order) - 1) * F.col("slices") / F.col("n")))
    )
    ends = (
        sample.groupBy(_HASH, "part")
        .agg(F.min("at").alias("cut"))
        .where(F.col("part") > 0)
        .groupBy(_HASH)
        .agg(F.array_sort(F.collect_set("cut")).alias("cut"))
    )
    grouped = F.transform(
        F.sequence(F.lit(0), ((F.size("cut") - 1) / _CUTS_PER_GROUP).cast("int")),
        lambda g: F.slice("cut", g * _CUTS_PER_GROUP + 1, _CUTS_PER_GROUP),
    )
    cuts = ends.select(_HASH, grouped.alias(_FINE)).withColumn(
        _COARSE, F.transform(_FINE, lambda group: F.get(group, F.lit(0)))
    )
    path = shared_dir(spark, "slices")
    cuts.write.parquet(path)
    return HotKeys(keys, order_by, spark.read.schema(cuts.schema).parquet(path))


def kept_small(spark, table: DataFrame, purpose: str) -> DataFrame:
    """A small table that tasks must agree on, written to the shared folder."""
    path = shared_dir(spark, purpose)
    table.write.parquet(path)
    return spark.read.schema(table.schema).parquet(path)


def crowded(log: DataFrame, message_key: str = "key", rows_per_slice: int | None = None) -> bool:
    """Whether a message key has more rows than one slice."""
    return bool(_slice_counts(_hashed(log, [message_key]), rows_per_slice)[1])


def with_slices(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], hot: HotKeys | None) -> DataFrame:
    """Add the slice number of each row, and whether its key is a hot one.

    Rows without a key follow nothing and precede nothing, so they are spread.
    """
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    spread = F.xxhash64(*[F.col(c) for c in order_by])
    if hot is None or hot.cuts is None:
        number = F.when(missing, spread).otherwise(F.lit(0).cast("long"))
        return df.withColumn(SLICE, number).withColumn(HOT, F.lit(False))

    at = F.struct(*[F.col(c) for c in hot.order_by])
    group = F.size(F.filter(_COARSE, lambda cut: cut <= at))  # groups begun so far
    inside = F.size(F.filter(F.get(F.col(_FINE), group - 1), lambda cut: cut <= at))
    number = F.when(group > 0, (group - 1) * _CUTS_PER_GROUP + inside).otherwise(F.lit(0))
    is_hot = F.col(_FINE).isNotNull()
    return (
        df.withColumn(_HASH, _key_hash(keys))
        .join(F.broadcast(hot.cuts), _HASH, "left")  # about _MAX_SLICES cut points in all
        .withColumn(SLICE, F.when(missing, spread).when(is_hot, number.cast("long")).otherwise(F.lit(0).cast("long")))
        .withColumn(HOT, is_hot & ~missing)
        .drop(_HASH, _FINE, _COARSE)
    )
