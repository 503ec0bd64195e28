"""Values from the rows before and after, per key, in one shuffle of the rows.

Each function hash-partitions by (key, slice) and sorts within; ordinary keys
have a single slice. For keys cut up by ``skew.find_hot_keys`` the first or
last row of a slice needs one value from a neighbouring slice. Those edge
values come from a grouped aggregate with map-side combining, one row per
slice, and are joined back by broadcast (about 20,000 rows at most).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators.skew import HOT, SLICE, HotKeys, with_slices

_EDGE = "__edge"


def _in_slice(keys: Sequence[str], order_by: Sequence[str]):
    return Window.partitionBy(*keys, SLICE).orderBy(*order_by)


def _across_slices(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(SLICE)


def _order_struct(order_by: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order_by])


def _has_key(keys: Sequence[str]) -> Column:
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return present


def _add(df, keys, order_by, hot, within, edge_value, edge_from_slices, combine, out, keep=False):
    # Rows that an earlier step has sliced stay where they are.
    sliced = df if SLICE in df.columns else with_slices(df, keys, order_by, hot)
    result = sliced.withColumn(out, F.when(_has_key(keys), within))
    if hot is not None and hot.cuts is not None:
        edges = (
            sliced.where(HOT)
            .groupBy(*keys, SLICE)
            .agg(edge_value.alias(_EDGE))
            .withColumn(_EDGE, edge_from_slices)
        )
        result = result.join(F.broadcast(edges), [*keys, SLICE], "left").withColumn(
            out, combine(F.col(out), F.col(_EDGE))
        )
    return result.drop(_EDGE) if keep else result.drop(SLICE, HOT, _EDGE)


def with_next(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    value: Column,
    out: str,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Add ``out``: a struct holding ``value`` of the key's next row, or NULL."""
    boxed = F.struct(value.alias("value"))
    return _add(
        df,
        keys,
        order_by,
        hot,
        within=F.lead(boxed).over(_in_slice(keys, order_by)),
        edge_value=F.min_by(boxed, _order_struct(order_by)),
        edge_from_slices=F.lead(_EDGE).over(_across_slices(keys)),
        combine=F.coalesce,
        out=out,
    )


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    value: Column,
    out: str,
    hot: HotKeys | None = None,
    keep_slices: bool = False,
) -> DataFrame:
    """Add ``out``: a struct holding ``value`` of the key's previous row, or NULL.

    With ``keep_slices`` the next step finds the rows sliced, and needs no shuffle.
    """
    boxed = F.struct(value.alias("value"))
    return _add(
        df,
        keys,
        order_by,
        hot,
        within=F.lag(boxed).over(_in_slice(keys, order_by)),
        edge_value=F.max_by(boxed, _order_struct(order_by)),
        edge_from_slices=F.lag(_EDGE).over(_across_slices(keys)),
        combine=F.coalesce,
        out=out,
        keep=keep_slices,
    )


def with_last_known(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    value: Column,
    out: str,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Add ``out``: the latest non-NULL ``value`` up to and including each row."""
    so_far = _in_slice(keys, order_by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = _across_slices(keys).rowsBetween(Window.unboundedPreceding, -1)
    order = F.when(value.isNotNull(), _order_struct(order_by))
    return _add(
        df,
        keys,
        order_by,
        hot,
        within=F.last(value, ignorenulls=True).over(so_far),
        edge_value=F.max_by(value, order),
        edge_from_slices=F.last(_EDGE, ignorenulls=True).over(earlier),
        combine=F.coalesce,
        out=out,
    )
