"""Joining facts to the version that was valid at each fact's time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators.ordered import with_last_known
from strandline.operators.skew import HotKeys, find_hot_keys

_AT, _SIDE, _TIE, _END, _APART = "__at", "__side", "__tie", "__end", "__apart"


def asof_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str | Sequence[str],
    fact_time: str,
    *,
    version_columns: Sequence[str],
    version_order: Sequence[str] = (),
    how: str = "left",
    hot: HotKeys | str | None = "find",
    rows_per_slice: int | None = None,
) -> DataFrame:
    """Add ``version_columns`` of the version valid at ``fact_time``.

    ``versions`` has ``valid_from`` and ``valid_to`` (half-open);
    ``version_order`` breaks ties between versions that start together; those
    it leaves tied go by their end, open ones last, so that of a version of no
    length and its successor the successor is found. A range join would pair every fact of a key with every version of it. Here
    both sides are stacked, sorted once per key, and each fact takes the last
    version above it: work grows with facts plus versions.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    keys = [key] if isinstance(key, str) else list(key)
    fact_rest = [c for c in facts.columns if c not in keys]
    clash = set(fact_rest) & set(version_columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")

    carried = F.struct("valid_to", *version_columns)
    tie = F.struct(*version_order) if version_order else F.struct(F.lit(0).alias("none"))
    end = F.struct(F.col("valid_to").isNull().alias("open"), F.col("valid_to").alias("at"))
    end_type = versions.select(end.alias("x")).schema["x"].dataType
    fact_type = facts.select(F.struct(*fact_rest).alias("x")).schema["x"].dataType
    version_type = versions.select(carried.alias("x")).schema["x"].dataType
    tie_type = versions.select(tie.alias("x")).schema["x"].dataType

    upper = versions.select(
        *keys,
        F.col("valid_from").alias(_AT),
        F.lit(0).alias(_SIDE),
        tie.alias(_TIE),
        end.alias(_END),
        F.lit(None).cast("long").alias(_APART),
        carried.alias("version"),
        F.lit(None).cast(fact_type).alias("fact"),
    )
    lower = facts.select(
        *keys,
        F.col(fact_time).alias(_AT),
        F.lit(1).alias(_SIDE),
        F.lit(None).cast(tie_type).alias(_TIE),
        F.lit(None).cast(end_type).alias(_END),
        # Facts of one moment have no order; a hash lets their number be cut up.
        F.xxhash64(*fact_rest).alias(_APART),
        F.lit(None).cast(version_type).alias("version"),
        F.struct(*fact_rest).alias("fact"),
    )
    stacked = upper.unionByName(lower)
    order_by = [_AT, _SIDE, _TIE, _END, _APART]
    if hot == "find" or rows_per_slice:
        hot = find_hot_keys(stacked, keys, order_by, rows_per_slice)
    matched = with_last_known(stacked, keys, order_by, F.col("version"), "__match", hot)
    valid = F.col("__match")["valid_to"].isNull() | (F.col("__match")["valid_to"] > F.col(_AT))
    found = F.when(valid, F.col("__match"))
    joined = matched.where(F.col(_SIDE) == 1).select(
        *keys,
        *[F.col("fact")[c].alias(c) for c in fact_rest],
        found.alias("__match"),
    )
    if how == "inner":
        joined = joined.where(F.col("__match").isNotNull())
    return joined.select(*keys, *fact_rest, *[F.col("__match")[c].alias(c) for c in version_columns])
