"""Versioned history (SCD Type 2) as a fold over the change log.

The log is append-only and the history is a pure function of it, so running
twice, late events and several changes of one key in one batch all give the
same, gap-free intervals. Nothing is merged into or rewritten.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators.envelope import DELETE, INSERTS, LOG_ORDER, UPDATE
from strandline.operators.ordered import with_next, with_previous
from strandline.operators.skew import HOT, SLICE, HotKeys, crowded, find_hot_keys
from strandline.session import shared_dir

_NEXT = "__next"
_PREVIOUS = "__previous"


def _as_list(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def drop_redelivered(
    changes: DataFrame,
    identity: Sequence[str],
    order_by: Sequence[str] = LOG_ORDER,
    *,
    key: str | Sequence[str] | None = None,
    log: DataFrame | None = None,
) -> DataFrame:
    """One row per change, however often the log holds it; the earliest position wins.

    A grouped minimum rather than a ranking window: copies collapse before the
    shuffle, even where they are a large part of the log. They are grouped by a
    digest of 128 bits, which is short to sort by.

    With ``key``, columns of the identity, and the ``log`` whose message keys name them,
    copies meet where ``history`` needs the key's changes: the rows are shuffled once for
    both, and ``history`` finds them sliced. Where a key of the log is crowded, they are
    grouped as without.
    """
    # NULL adds nothing to a hash, so which columns are NULL goes in as well.
    parts = [F.col(c) for c in identity] + [F.col(c).isNull() for c in identity]
    digest = {f"__digest_{i}": F.xxhash64(F.lit(i), *parts) for i in (0, 1)}
    place = [F.col(c) for c in order_by]
    if key is not None:
        keys = _as_list(key)
        if log is None or not set(keys) <= set(identity):
            raise ValueError("a key must be part of the identity and have a log")
        if not crowded(log):
            return _dropped_by_key(changes, keys, digest, place)
    first = F.min_by(F.struct(*changes.columns), F.struct(*place))
    return (
        changes.withColumns(digest)
        .groupBy(*digest)
        .agg(first.alias("first"))
        .select(*[F.col("first")[c].alias(c) for c in changes.columns])
    )


def _dropped_by_key(
    changes: DataFrame, keys: Sequence[str], digest: Mapping[str, Column], place: Sequence[Column]
) -> DataFrame:
    missing = reduce(or_, [F.col(k).isNull() for k in keys])
    # Rows without a key are spread, but so that copies stay together.
    slice_of = F.when(missing, F.col("__digest_0")).otherwise(F.lit(0).cast("long"))
    copies = Window.partitionBy(*keys, SLICE, *digest).orderBy(*place)
    return (
        changes.withColumns(digest)
        .withColumns({SLICE: slice_of, HOT: F.lit(False)})
        .repartition(*keys, SLICE)
        .withColumn("__copy", F.row_number().over(copies))
        .where(F.col("__copy") == 1)
        .drop("__copy", *digest)
    )


def open_versions(changes: DataFrame, at: str = "cdc_timestamp") -> DataFrame:
    """Every change as a version that is open and current."""
    return changes.select(
        "*",
        F.col(at).alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
        F.current_timestamp().alias("processed_at"),
    )


def history(
    changes: DataFrame,
    key: str | Sequence[str],
    order_by: Sequence[str] = LOG_ORDER,
    *,
    operation: str | None = "operation",
    deletes: str = "close",
    changed_columns: Sequence[str] | None = None,
    hot: HotKeys | str | None = "find",
    log: DataFrame | None = None,
) -> DataFrame:
    """All versions of each key with ``valid_from``, ``valid_to`` and ``is_current``.

    ``order_by`` is a total order within a key and starts with the change
    time. A version lasts until the key's next change, so two changes at the
    same moment leave a zero-length version. ``deletes="close"`` ends the
    version a delete follows; ``"ignore"`` keeps it current. With
    ``changed_columns`` a change that alters none of them opens no version.
    Rows without a key are each their own current version.

    One shuffle by key. ``hot`` is the result of ``find_hot_keys``; by default
    it is looked for, in the message keys of ``log`` first where that is given,
    and ``None`` skips that pass. Where one of those is crowded, the decoded
    changes are written to the shared folder, so that the log is decoded once.
    """
    if deletes not in ("close", "ignore"):
        raise ValueError("deletes must be 'close' or 'ignore'")
    keys, order_by = _as_list(key), list(order_by)
    at = order_by[0]
    if operation and deletes == "ignore":
        changes = changes.where(F.col(operation) != DELETE)
    if hot == "find" and SLICE in changes.columns:
        hot = None  # an earlier step has looked and found none
    if hot == "find":
        if log is not None and crowded(log):
            path = shared_dir(changes.sparkSession, "decoded-changes")
            changes.write.parquet(path)
            changes = changes.sparkSession.read.schema(changes.schema).parquet(path)
            log = None
            hot = find_hot_keys(changes, keys, order_by)
        else:
            hot = None if log is not None else find_hot_keys(changes, keys, order_by)
    if changed_columns:
        state = F.struct(*[F.col(c) for c in changed_columns])
        if operation:
            state = F.struct((F.col(operation) == DELETE).alias("gone"), state.alias("state"))
        changes = (
            with_previous(changes, keys, order_by, state, _PREVIOUS, hot, keep_slices=True)
            .where(F.col(_PREVIOUS).isNull() | ~F.col(_PREVIOUS)["value"].eqNullSafe(state))
            .drop(_PREVIOUS)
        )
    names = [c for c in changes.columns if c not in (SLICE, HOT)]
    versions = with_next(changes, keys, order_by, F.col(at), _NEXT, hot)
    if operation and deletes == "close":
        versions = versions.where(F.col(operation) != DELETE)
    return versions.select(
        *names,
        F.col(at).alias("valid_from"),
        F.col(_NEXT)["value"].alias("valid_to"),
        F.col(_NEXT).isNull().alias("is_current"),
    )


def stamp_processed(versions: DataFrame) -> DataFrame:
    return versions.withColumn("processed_at", F.current_timestamp())


def closed_versions(versions: DataFrame) -> DataFrame:
    return versions.where(~F.col("is_current"))


def appended_versions(versions: DataFrame) -> DataFrame:
    """Versions that came from an update, whether or not an insert came before."""
    return versions.where(F.col("operation") == UPDATE)


def inserted(changes: DataFrame) -> DataFrame:
    return changes.where(F.col("operation").isin(*INSERTS))


def current(versions: DataFrame) -> DataFrame:
    return versions.where("is_current")


def current_from_log(
    changes: DataFrame,
    key: str | Sequence[str],
    order_by: Sequence[str] = LOG_ORDER,
    *,
    operation: str | None = "operation",
) -> DataFrame:
    """The current version of each key straight from the log.

    Cheaper than the whole history: it combines before the shuffle and moves
    one row per key, so a key's length does not matter either.
    """
    keys, at = _as_list(key), order_by[0]
    rest = [c for c in changes.columns if c not in keys]
    known, unknown = F.lit(True), F.lit(None).cast("long")
    for name in keys:
        known = known & F.col(name).isNotNull()
    # A row without a key is its own version; its place in the log tells it apart.
    apart = F.when(known, unknown).otherwise(F.xxhash64(*[F.col(c) for c in order_by]))
    newest = (
        changes.withColumn("__apart", apart)
        .groupBy(*keys, "__apart")
        .agg(F.max_by(F.struct(*rest), F.struct(*[F.col(c) for c in order_by])).alias("newest"))
        .select(*keys, *[F.col("newest")[c].alias(c) for c in rest])
    )
    if operation:
        newest = newest.where(F.col(operation) != DELETE)
    return newest.select(
        *changes.columns,
        F.col(at).alias("valid_from"),
        F.lit(None).cast(changes.schema[at].dataType).alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def summary(versions: DataFrame) -> DataFrame:
    """Row counts, and closed versions per hundred current ones."""
    now, past = F.count_if("is_current"), F.count_if(~F.col("is_current"))
    rate = past.cast("decimal(19,0)") * 100 / F.nullif(now, F.lit(0)).cast("decimal(19,0)")
    return versions.agg(
        F.count("*").alias("total_rows"),
        now.alias("current_rows"),
        past.alias("historical_rows"),
        F.round(rate, 1).cast("decimal(18,1)").alias("correction_rate_pct"),
    )


def history_sample(versions: DataFrame, key: str, order_by: Sequence[str], keys_shown: int = 2) -> DataFrame:
    """The full history of the first few keys that ever changed."""
    changed = closed_versions(versions).select(key).distinct().orderBy(key).limit(keys_shown)
    return versions.join(changed, key, "left_semi").orderBy(key, "valid_from", *order_by)


def changed_keys(
    changes: DataFrame,
    key: str,
    order_by: Sequence[str] = LOG_ORDER,
    *,
    operation: str = "operation",
    keys_shown: int = 2,
) -> DataFrame:
    """The first few keys that have a closed version, without folding anything.

    A version is closed when any change of its key comes after it: when a key has
    more versions than the one its last change may be.
    """
    is_version = F.col(operation) != DELETE
    last = F.max_by(is_version, F.struct(*[F.col(c) for c in order_by])).cast("int")
    return (
        changes.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg((F.count_if(is_version) > last).alias("closed"))
        .where("closed")
        .select(key)
        .orderBy(key)
        .limit(keys_shown)
    )


def history_sample_from_log(
    changes: DataFrame, key: str, order_by: Sequence[str] = LOG_ORDER, keys_shown: int = 2, **options
) -> DataFrame:
    """``history_sample``, folding the changes of the keys shown only."""
    wanted = F.broadcast(changed_keys(changes, key, order_by, keys_shown=keys_shown))  # keys_shown rows
    few = changes.join(wanted, key, "left_semi")
    return history(few, key, order_by, hot=None, **options).orderBy(key, "valid_from", *order_by[1:])


def as_of(versions: DataFrame, moment: Column | dt.datetime | str) -> DataFrame:
    """The versions valid at one moment; intervals include their start only."""
    at = moment if isinstance(moment, Column) else F.lit(moment)
    return versions.where(
        (F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at))
    )


def as_known_at(
    changes: DataFrame,
    moment: Column | dt.datetime | str,
    key: str | Sequence[str],
    order_by: Sequence[str] = LOG_ORDER,
    *,
    seen_at: str = "ingested_at",
    **options,
) -> DataFrame:
    """The history as it stood when only events seen up to ``moment`` were known."""
    at = moment if isinstance(moment, Column) else F.lit(moment)
    return history(changes.where(F.col(seen_at) <= at), key, order_by, **options)
