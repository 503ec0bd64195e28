"""Pairs of intervals that overlap, key by key.

``interval_join`` of two histories, say, gives for each version on one side the versions on
the other that were valid in the same time, and when. Two intervals overlap when the one
that starts later starts inside the other. So both sides are put in one table, sorted by
their starts, and swept once: a task keeps the intervals that are open, and each start meets
the open ones of the other side. Nothing is compared that doesn't overlap, and there is one
shuffle.

A crowded key is cut into slices of its starts (``skew.py``). An interval goes to the slice
it starts in, to be met and to meet, and is carried to the later slices it reaches into, to
be met only, and only to those in which the other side starts something: all but the last of
these copies are pairs of the result anyway. Where too many are open in a slice, they are
dealt out over lanes, each of which sees all starts, so that what a task keeps is bounded.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators import skew
from strandline.operators.sweeps import OUT_ROWS, Kept, batch_of, groups_of, swept

# Open intervals of a crowded key that one task keeps, about.
OPEN_PER_TASK = 1_000_000

_FROM, _TO, _SIDE, _TIE, _LANE, _MEETS, _STAYS = "__from", "__to", "__side", "__tie", "__lane", "__meets", "__stays"
_LEFT, _RIGHT = "__left", "__right"


def _stacked(side: DataFrame, number: int, keys, start, end, rows: dict[str, pa.DataType]) -> DataFrame:
    own = _LEFT if number == 0 else _RIGHT
    known = F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(end) > F.col(start)))
    for key in keys:
        known = known & F.col(key).isNotNull()
    payload = [c for c in side.columns if c not in keys]
    return side.where(known).select(
        *keys,
        F.col(start).alias(_FROM),
        F.col(end).alias(_TO),
        F.lit(number).alias(_SIDE),
        F.xxhash64(*side.columns).alias(_TIE),
        *[(F.struct(*payload) if name == own else F.lit(None).cast(kind)).alias(name) for name, kind in rows.items()],
    )


def _carried(stacked: DataFrame, keys: list[str], hot: skew.HotKeys) -> DataFrame:
    """The rows of crowded keys in all slices and lanes that need them."""
    spark = stacked.sparkSession
    first, last = "__first", "__last"
    # The slice of an end is that of the first start there could be at its moment.
    sliced = skew.with_slices(stacked, keys, hot.order_by, hot).withColumnRenamed(skew.SLICE, first).drop(skew.HOT)
    at_end = sliced.withColumnsRenamed({_FROM: "__f", _SIDE: "__s", _TIE: "__t"}).withColumns(
        {_FROM: F.col(_TO), _SIDE: F.lit(-1), _TIE: F.lit(0).cast("long")}
    )
    sliced = skew.with_slices(at_end, keys, hot.order_by, hot).drop(_FROM, _SIDE, _TIE).withColumnsRenamed(
        {"__f": _FROM, "__s": _SIDE, "__t": _TIE, skew.SLICE: last}
    )
    sliced = sliced.withColumn(last, F.when(F.col(_TO).isNull(), F.lit(1 << 40)).otherwise(F.col(last)))
    # In which slices a side starts something: about as many rows as there are slices.
    starts = (
        sliced.where(skew.HOT).groupBy(*keys).agg(*[
            F.sort_array(F.collect_set(F.when(F.col(_SIDE) == side, F.col(first)))).alias(f"__starts{side}") for side in (0, 1)
        ])
    )
    starts = skew.kept_small(spark, starts, "interval-starts")
    other = F.when(F.col(_SIDE) == 0, F.col("__starts1")).otherwise(F.col("__starts0"))
    later = F.filter(other, lambda s: (s > F.col(first)) & (s <= F.col(last)))
    slices = F.when(F.col(skew.HOT), F.concat(F.array(first), F.coalesce(later, F.array().cast("array<bigint>"))))
    everywhere = sliced.join(F.broadcast(starts), keys, "left").withColumn(
        skew.SLICE, F.explode(F.coalesce(slices, F.array(first)))
    )
    return everywhere.withColumn(_MEETS, F.col(skew.SLICE) == F.col(first)).drop(first, last, "__starts0", "__starts1")


def _laned(rows: DataFrame, keys: list[str], per_task: int) -> DataFrame:
    """Crowded slices dealt out: a row stays in one lane and meets what is open in all."""
    crowded = (
        rows.where(skew.HOT).groupBy(*keys, skew.SLICE).agg(F.ceil(F.count("*") / per_task).cast("int").alias("__lanes"))
        .where("__lanes > 1")
    )
    crowded = skew.kept_small(rows.sparkSession, crowded, "interval-lanes")
    lanes = F.coalesce("__lanes", F.lit(1))
    own = F.pmod(F.col(_TIE), lanes).cast("int")
    where = F.when(F.col(_MEETS), F.sequence(F.lit(0), lanes - 1)).otherwise(F.array(own))
    return (
        rows.join(F.broadcast(crowded), [*keys, skew.SLICE], "left")
        .withColumn("__own", own)
        .withColumn(_LANE, F.explode(where))
        .withColumn(_STAYS, F.col(_LANE) == F.col("__own"))
        .drop("__lanes", "__own")
    )


def _sweep(group: list[str], left_kind: pa.DataType, right_kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = (Kept(left_kind), Kept(right_kind))
        open_rows: tuple[dict, dict] = ({}, {})  # number of the row: nothing, in order of arrival
        ends: tuple[list, list] = ([], [])
        pairs: tuple[list, list] = ([], [])
        waiting, current = 0, None

        def out() -> pa.RecordBatch:
            columns = {}
            for side, name in enumerate((_LEFT, _RIGHT)):
                numbers = np.concatenate(pairs[side])
                columns[name] = kept[side].take(numbers)
                pairs[side].clear()
            return batch_of(columns)

        def let_go() -> None:
            for side in (0, 1):
                moved = kept[side].shrink(open_rows[side])
                if moved is not None:
                    held = [(end, moved[n]) for end, n in ends[side] if n in moved]
                    still = {moved[n]: None for n in open_rows[side]}
                    ends[side][:] = held
                    heapq.heapify(ends[side])
                    open_rows[side].clear()
                    open_rows[side].update(still)

        for batch in batches:
            base = (kept[0].add(batch.column(_LEFT)), kept[1].add(batch.column(_RIGHT)))
            columns = [batch.column(c).to_pylist() for c in (_FROM, _TO, _SIDE, _MEETS, _STAYS)]
            shift = [0, 0]
            for i, (own, start, end, side, meets, stays) in enumerate(
                zip(groups_of(batch, group), *columns, strict=True)
            ):
                if own != current:
                    current = own
                    for x in (*open_rows, *ends):
                        x.clear()
                number = base[side] + i + shift[side]
                if meets:
                    there, due = open_rows[1 - side], ends[1 - side]
                    while due and due[0][0] <= start:
                        there.pop(heapq.heappop(due)[1], None)
                    if there:
                        pairs[side].append(np.full(len(there), number))
                        pairs[1 - side].append(np.fromiter(there, np.int64, len(there)))
                        waiting += len(there)
                if stays:
                    open_rows[side][number] = None
                    if end is not None:
                        heapq.heappush(ends[side], (end, number))
                if waiting >= OUT_ROWS:
                    yield out()
                    waiting = 0
            if any(k.crowded for k in kept):
                if waiting:
                    yield out()
                    waiting = 0
                let_go()
        if waiting:
            yield out()

    return run


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str | Sequence[str],
    *,
    left_from: str = "valid_from",
    left_to: str = "valid_to",
    right_from: str = "valid_from",
    right_to: str = "valid_to",
    suffixes: tuple[str, str] = ("_left", "_right"),
    hot: skew.HotKeys | str | None = "find",
    rows_per_slice: int | None = None,
    open_per_task: int = OPEN_PER_TASK,
) -> DataFrame:
    """Each pair of rows with equal keys whose half-open intervals overlap.

    Columns: the keys, ``overlap_from`` and ``overlap_to`` (NULL: still open), then the
    other columns of both sides, with ``suffixes`` where a name is on both. An end that is
    NULL is open; an interval that ends where or before it starts, or has no start, overlaps
    nothing, and a NULL key equals no other. Equal rows count each.
    """
    keys = [key] if isinstance(key, str) else list(key)
    spark = left.sparkSession
    names = {}
    for own, side in ((_LEFT, left), (_RIGHT, right)):
        names[own] = [c for c in side.columns if c not in keys]
    kinds = {
        own: side.select(F.struct(*names[own]).alias("x")).schema["x"].dataType
        for own, side in ((_LEFT, left), (_RIGHT, right))
    }
    one = _stacked(left, 0, keys, left_from, left_to, kinds)
    two = _stacked(right, 1, keys, right_from, right_to, kinds)
    stacked = one.unionByName(two)
    if hot == "find" or rows_per_slice:
        hot = skew.find_hot_keys(stacked, keys, [_FROM, _SIDE, _TIE], rows_per_slice)
    if hot is not None and hot.cuts is not None:
        rows = _laned(_carried(stacked, keys, hot), keys, open_per_task)
    else:
        yes = F.lit(True)
        rows = stacked.withColumns({skew.SLICE: F.lit(0).cast("long"), _LANE: F.lit(0), _MEETS: yes, _STAYS: yes})
    group = [*keys, skew.SLICE, _LANE]
    # Carried rows started before all others of the slice; of equal starts the left side's is first.
    order = [F.col(_MEETS), F.col(_FROM), F.col(_SIDE)]
    rows = rows.select(*group, _FROM, _TO, _SIDE, _MEETS, _STAYS, _LEFT, _RIGHT)
    # Keys travel within the rows, as a task gives back rows only.
    keyed = F.struct(*keys).alias("__key")
    for own in (_LEFT, _RIGHT):
        boxed = F.struct(keyed, F.col(own).alias("row"))
        rows = rows.withColumn(own, F.when(F.col(own).isNotNull(), boxed))
    schema = rows.select(_LEFT, _RIGHT).schema
    arrow = spark_to_arrow(schema)
    pairs = swept(rows, group, order, _sweep(group, arrow.field(_LEFT).type, arrow.field(_RIGHT).type), schema)

    def end(own, column):
        return F.col(f"{own}.row")[column]

    both = set(names[_LEFT]) & set(names[_RIGHT])
    columns = [
        F.col(f"{own}.row")[c].alias(c + suffix if c in both else c)
        for own, suffix in ((_LEFT, suffixes[0]), (_RIGHT, suffixes[1]))
        for c in names[own]
    ]
    return pairs.select(
        *[F.col(f"{_LEFT}.__key")[k].alias(k) for k in keys],
        F.greatest(end(_LEFT, left_from), end(_RIGHT, right_from)).alias("overlap_from"),
        F.least(end(_LEFT, left_to), end(_RIGHT, right_to)).alias("overlap_to"),
        *columns,
    )


def spark_to_arrow(schema) -> pa.Schema:
    """The Arrow types in which tasks get the columns."""
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema, timestamp_utc=True)
