"""What each fact could have known: versions by valid time and by time of knowledge.

``scd2_as_known_at`` folds the log again for one date. Here every fact has its own pair of
times: the moment it asks about, and the moment whose knowledge counts. Its version is the
last change, in the key's order, at or before the first among those seen by the second.

Both sides are put in one table, sorted by the time of knowledge, and swept once per key,
many rows at a time. Of the changes seen before it, the last in the key's order answers a
fact, unless that lies after the fact's moment; then the last of those up to the moment is
searched in a tree over the order, whose nodes hold where the first of their changes
stands. So work grows with facts and changes and their logarithm, never with their product,
and there is one shuffle.

A crowded key is cut into slices of its order (``skew.py``). A fact looks in the slice of
its moment. If nothing there was known to it, its version is the last one known in some
slice before: the nearest one in which anything had been seen by then, which the first
time of knowledge of each slice tells. Those facts, and no others, are looked up again,
there.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators import skew
from strandline.operators.envelope import DELETE, LOG_ORDER
from strandline.operators.sweeps import OUT_ROWS, swept
from strandline.session import shared_dir

# A fact has no change. All that Spark hands to Python costs by the column, also where it
# is null, so a change is one flat struct: whether it deletes, its order, its version.
_SEEN, _AT = "__seen", "__at"
_CHANGE, _FACT, _FOUND = "__change", "__fact", "__found"
_GONE, _ORDER, _ROW = "gone", "o", "v"
# Rows and bytes looked up at once; more where a group keeps more changes than that.
_ROWS_AT_ONCE, _BYTES_AT_ONCE = 50_000, 32 << 20


def _sweep(group: list[str], bounded: bool, drop: bool):
    """Facts with what they find; not ``bounded``: whatever its moment. ``drop`` leaves out those without a version."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of the group that may go on one change of each moment, the last one.
        kept, waiting, rows, size = None, [], 0, 0
        for batch in batches:
            waiting.append(batch)
            rows, size = rows + batch.num_rows, size + batch.nbytes
            most, full = (kept.num_rows, kept.nbytes) if kept else (0, 0)
            if rows >= max(_ROWS_AT_ONCE, most) or size >= max(_BYTES_AT_ONCE, full):
                kept, found = _looked_up(kept, waiting, group, bounded, drop)
                waiting, rows, size = [], 0, 0
                yield from found.to_batches(max_chunksize=OUT_ROWS)
        if rows:
            yield from _looked_up(kept, waiting, group, bounded, drop)[1].to_batches(max_chunksize=OUT_ROWS)

    return run


def _looked_up(
    kept: pa.Table | None, waiting: list[pa.RecordBatch], group: list[str], bounded: bool, drop: bool
) -> tuple[pa.Table, pa.Table]:
    """What later rows need of the last group's changes, and the facts with what they found."""
    table = pa.Table.from_batches(waiting)
    table = (pa.concat_tables([kept, table]) if kept else table).combine_chunks()
    columns = {name: _whole(table[name]) for name in table.column_names}
    begins = np.zeros(table.num_rows, bool)
    for name in group:
        begins[1:] |= _differs(columns[name])
    number = np.cumsum(begins)
    is_fact, moment = columns[_CHANGE].is_null().to_numpy(zero_copy_only=False), _codes(columns[_AT])
    facts, changes = np.flatnonzero(is_fact), np.flatnonzero(~is_fact)

    # Changes by group and place, so a later group's rank is higher; of equals the one seen later.
    changed = columns[_CHANGE].take(pa.array(changes))
    parts = {field.name: part for field, part in zip(changed.type, changed.flatten(), strict=True)}
    order = [_codes(part) for name, part in parts.items() if name.startswith(_ORDER)]
    by_rank = np.lexsort([*order[::-1], moment[changes], number[changes]])
    place = changes[by_rank]  # where the change of a rank stands
    of_moment, of_group = moment[place], number[place]
    best = np.full(table.num_rows, -1)
    best[place] = np.arange(len(place))
    best = np.maximum.accumulate(best)[facts]
    if len(place):
        best[of_group[best] != number[facts]] = -1
    if bounded:
        late = np.flatnonzero((best >= 0) & (of_moment[best] > moment[facts])) if len(place) else facts[:0]
        if len(late):
            asking = facts[late]
            start = np.searchsorted(of_group, number[asking])
            upto = _count_upto(of_moment, start, best[late], moment[asking])
            found = _last_before(place, upto, asking)
            best[late] = np.where(found >= start, found, -1)

    if drop:
        gone = parts[_GONE].to_numpy(zero_copy_only=False)[by_rank]
        has = best >= 0
        has[has] = ~gone[best[has]]
        facts, best = facts[has], best[has]
    rank = pa.array(best, mask=best < 0)
    shown = [c for c in table.column_names if c not in (_CHANGE, skew.SLICE)]
    answers = pa.table({name: columns[name].take(pa.array(facts)) for name in shown})
    version = {name: part for name, part in parts.items() if not name.startswith(_ORDER)}
    found = pa.StructArray.from_arrays([*version.values()], [*version]).take(pa.array(by_rank).take(rank))
    last = np.flatnonzero(of_group == number[-1])
    last = last[np.append(of_moment[last][1:] != of_moment[last][:-1], True)] if len(last) else last
    return table.take(pa.array(place[last])), answers.append_column(_FOUND, found)


def _count_upto(moments: np.ndarray, start: np.ndarray, end: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """The first rank from ``start`` on, up to ``end``, whose moment is after the bound."""
    low, high = start.copy(), end.copy()
    while (low < high).any():
        middle = (low + high) >> 1
        early = (low < high) & (moments[middle] <= bound)
        low, high = np.where(early, middle + 1, low), np.where(early, high, np.minimum(middle, high))
    return low


def _last_before(place: np.ndarray, upto: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """For each ``upto`` and ``limit`` the last index below the one whose place is before the other; -1 if none is."""
    # Each level has the least of two neighbours of the one below.
    far = np.iinfo(place.dtype).max
    levels = [place]
    while len(levels[-1]) > 1:
        pairs = levels[-1] if len(levels[-1]) % 2 == 0 else np.append(levels[-1], far)
        levels.append(np.minimum(pairs[::2], pairs[1::2]))
    # Up, over blocks that end where the range does, to one that has such a place; down to the last one in it.
    node, height = upto.copy(), np.full(len(upto), -1)
    for k, least in enumerate(levels):
        whole = (height < 0) & (node % 2 == 1)
        hit = whole.copy()
        hit[whole] = least[node[whole] - 1] < limit[whole]
        height[hit] = k
        node = np.where(height < 0, node >> 1, np.where(hit, node - 1, node))
    for k in range(len(levels) - 2, -1, -1):
        going = np.flatnonzero(height > k)
        right = node[going] * 2 + 1
        inside = right < len(levels[k])
        least = np.where(inside, levels[k][np.where(inside, right, 0)], far)
        node[going] = np.where(least < limit[going], right, right - 1)
    return np.where(height < 0, -1, node)


def _whole(column: pa.ChunkedArray) -> pa.Array:
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks)


def _counted(column: pa.Array) -> bool:
    kind = column.type
    return not column.null_count and (
        pa.types.is_integer(kind) or pa.types.is_timestamp(kind) or pa.types.is_date32(kind)
    )


def _numbers(column: pa.Array) -> np.ndarray:
    if pa.types.is_date32(column.type):
        column = column.cast(pa.int32())
    return column.cast(pa.int64()).to_numpy()


def _codes(column: pa.Array) -> np.ndarray:
    """Whole numbers in the order of a column's values, NULL before all, as Spark sorts it."""
    if _counted(column):
        return _numbers(column)
    codes = np.zeros(len(column), np.int64)
    known = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
    values = column.take(pa.array(known))
    if pa.types.is_floating(column.type) or pa.types.is_boolean(column.type):
        codes[known] = np.unique(values.to_numpy(zero_copy_only=False), return_inverse=True)[1] + 1  # NaN last
        return codes
    try:
        codes[known] = pc.rank(values, tiebreaker="dense").to_numpy()
    except pa.ArrowNotImplementedError:
        own = values.to_pylist()
        at = {value: i for i, value in enumerate(sorted(set(own)), 1)}
        codes[known] = [at[value] for value in own]
    return codes


def _differs(column: pa.Array) -> np.ndarray:
    """Which rows from the second on have another value than the row before."""
    if _counted(column):
        numbers = _numbers(column)
        return numbers[1:] != numbers[:-1]
    try:
        if not column.null_count and not pa.types.is_floating(column.type):
            return pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    except pa.ArrowNotImplementedError:
        pass
    codes = _codes(column)
    return codes[1:] != codes[:-1]


def bitemporal_join(
    facts: DataFrame,
    changes: DataFrame,
    key: str | Sequence[str],
    valid_time: str,
    known_time: str,
    *,
    version_columns: Sequence[str],
    order_by: Sequence[str] = LOG_ORDER,
    seen_at: str = "ingested_at",
    operation: str | None = "operation",
    deletes: str = "close",
    how: str = "left",
    hot: skew.HotKeys | str | None = "find",
    rows_per_slice: int | None = None,
) -> DataFrame:
    """Add ``version_columns`` of the version valid at ``valid_time`` as known at ``known_time``.

    ``order_by`` is the order of a key's changes and starts with the time from which one is
    valid; of changes at one moment the last counts. A change seen at the very moment of
    knowledge is known. After a delete there is no version, unless ``deletes`` is
    ``"ignore"``. Facts or changes without a key or one of their times match nothing.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    if deletes not in ("close", "ignore"):
        raise ValueError("deletes must be 'close' or 'ignore'")
    keys, order_by = [key] if isinstance(key, str) else list(key), list(order_by)
    fact_rest = [c for c in facts.columns if c not in keys]
    clash = set(fact_rest) & set(version_columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    if operation and deletes == "ignore":
        changes = changes.where(F.col(operation) != DELETE)
    gone = F.col(operation) == DELETE if operation and deletes == "close" else F.lit(False)

    def kind(df, column):
        return df.select(column.alias("x")).schema["x"].dataType

    seen, moment = kind(changes, F.col(seen_at)), kind(changes, F.col(order_by[0]))
    parts = [F.coalesce(gone, F.lit(False)).alias(_GONE)]
    parts += [F.col(c).alias(f"{_ORDER}{i}") for i, c in enumerate(order_by[1:])]
    parts += [F.col(c).alias(f"{_ROW}{i}") for i, c in enumerate(version_columns)]
    change = F.struct(*parts)
    # A fact's times are not carried twice, where they need no cast.
    times = {n: c for n, c, t in ((valid_time, _AT, moment), (known_time, _SEEN, seen)) if kind(facts, F.col(n)) == t}
    plain = [c for c in fact_rest if c not in times]
    fact = [F.struct(*plain).alias(_FACT)] if plain else []
    nothing = [F.lit(None).cast(kind(facts, c)).alias(_FACT) for c in fact]
    no_change = F.lit(None).cast(kind(changes, change)).alias(_CHANGE)
    has_key = F.lit(True)
    for name in keys:
        has_key = has_key & F.col(name).isNotNull()
    filed = changes.where(has_key & F.col(seen_at).isNotNull() & F.col(order_by[0]).isNotNull()).select(
        *keys,
        F.col(seen_at).alias(_SEEN),
        F.col(order_by[0]).alias(_AT),
        change.alias(_CHANGE),
        *nothing,
    )
    # A fact without a time asks for what nothing is: it is spread, and finds nothing.
    asks = has_key & F.col(valid_time).isNotNull() & F.col(known_time).isNotNull()
    asked = facts.where(asks).select(
        *keys,
        F.col(known_time).cast(seen).alias(_SEEN),
        F.col(valid_time).cast(moment).alias(_AT),
        no_change,
        *fact,
    )
    spark = facts.sparkSession
    stacked = filed.unionByName(asked)
    # Changes and facts of one moment share a slice. A task keeps one change of a moment.
    if hot == "find" or rows_per_slice:
        hot = skew.find_hot_keys(stacked, keys, [_AT], rows_per_slice)
    cut = hot is not None and hot.cuts is not None
    rows = skew.with_slices(stacked, keys, [_AT], hot) if cut else stacked
    group = [*keys, skew.SLICE] if cut else keys
    carried = [*keys, _SEEN, _AT, *([_FACT] if plain else [])]
    version = [F.col(_CHANGE)[n].alias(n) for n in (_GONE, *[f"{_ROW}{i}" for i in range(len(version_columns))])]
    schema = rows.select(*carried, F.when(F.col(_CHANGE).isNotNull(), F.struct(*version)).alias(_FOUND)).schema
    empty = F.lit(None).cast(schema[_FOUND].dataType).alias(_FOUND)

    def look_up(table: DataFrame, bounded: bool, drop: bool) -> DataFrame:
        table = table.select(*group, *carried[len(keys) :], _CHANGE)
        changes_first = F.col(_CHANGE).isNull()
        return swept(table, group, [F.col(_SEEN), changes_first], _sweep(group, bounded, drop), schema)

    found = look_up(rows, True, how == "inner" and not cut)
    if cut:
        path = shared_dir(spark, "bitemporal")
        found.write.parquet(path)
        found = spark.read.schema(schema).parquet(path)
        missing = found.where(F.col(_FOUND).isNull()).select(*carried)
        again = missing.select(*carried, no_change)
        # When each slice of a crowded key was first seen anything of: a row for each slice.
        changed = rows.where(F.col(_CHANGE).isNotNull() & F.col(skew.HOT))
        first = changed.groupBy(*keys, skew.SLICE).agg(F.min(_SEEN).alias("seen"))
        slices = first.groupBy(*keys).agg(
            F.sort_array(F.collect_list(F.struct(F.col(skew.SLICE).alias("n"), "seen")), asc=False).alias("slices")
        )
        slices = F.broadcast(skew.kept_small(spark, slices, "bitemporal-slices"))
        placed = skew.with_slices(again, keys, [_AT], hot).withColumnRenamed(skew.SLICE, "__own").drop(skew.HOT)
        nearest = F.get(
            F.filter("slices", lambda s: (s["n"] < F.col("__own")) & (s["seen"] <= F.col(_SEEN))), F.lit(0)
        )
        placed = placed.join(slices, keys, "left").withColumn(skew.SLICE, nearest["n"]).drop("slices", "__own")
        never = placed.where(F.col(skew.SLICE).isNull()).select(*carried, empty)
        earlier = placed.where(F.col(skew.SLICE).isNotNull())
        second = look_up(changed.drop(skew.HOT).unionByName(earlier), False, False)
        found = found.where(F.col(_FOUND).isNotNull()).unionByName(second).unionByName(never)
    if how == "left":
        lone = [F.col(n) if times.get(n) == c else F.lit(None).cast(t) for n, c, t in ((known_time, _SEEN, seen), (valid_time, _AT, moment))]
        alone = facts.where(~F.coalesce(asks, F.lit(False)))
        found = found.unionByName(alone.select(*keys, lone[0].alias(_SEEN), lone[1].alias(_AT), *fact, empty))
    valid = F.col(_FOUND).isNotNull() & ~F.col(_FOUND)[_GONE]
    if how == "inner":
        found = found.where(valid)
    return found.select(
        *keys,
        *[F.col(times[c]).alias(c) if c in times else F.col(_FACT)[c].alias(c) for c in fact_rest],
        *[F.when(valid, F.col(_FOUND)[f"{_ROW}{i}"]).alias(c) for i, c in enumerate(version_columns)],
    )
