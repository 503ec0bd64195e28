"""A history that is kept on disk and brought up to date with each new batch.

Folding the whole log for one day's events reads everything. Here versions lie in
folders by key bucket, deletes among them, so that a bucket alone holds all that
its keys' intervals depend on. A batch reads and folds again only the buckets it
has keys of, late events included, and writes them as a new generation; the
others are not opened. Which generation of a bucket counts is the highest in the
list of generations, to which one write adds all buckets of a batch at once:
readers see a batch whole or not at all, and a run that failed before it leaves
only files nobody reads. There is one writer at a time; old generations stay for
readers that began with them, until the caller removes them.

Buckets are of a hash of the key. Where keys of one time belong together (running
numbers), ``bucket`` can be a range of them, so that a batch touches few.

Tables that follow from the history (``plans/incremental.py``) lie beside it, in buckets of
their own, and are named in the same list, so that they move on together with it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strandline.operators.envelope import DELETE, LOG_ORDER
from strandline.operators.history import history
from strandline.operators.skew import SLICE, find_hot_keys, with_slices

BUCKET = "bucket"
HISTORY = "history"
# The bucket of rows whose own is NULL.
NO_BUCKET = -1
_LIST, _BEFORE = "generations", "__before"
_LISTED = f"store string, {BUCKET} int, folder string, generation long"
_FOLDED = ("valid_from", "valid_to", "is_current")


def folders(spark: SparkSession, root: str, store: str = HISTORY) -> dict[int, str]:
    """The folder of each bucket; one row per bucket, whatever the buckets hold."""
    try:
        listed = spark.read.schema(_LISTED).parquet(f"{root.rstrip('/')}/{_LIST}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}  # no batch yet
    newest = listed.where(F.col("store") == store).groupBy(BUCKET).agg(F.max_by("folder", "generation").alias("folder"))
    return {r[BUCKET]: r["folder"] for r in newest.collect()}


def rows_of(spark: SparkSession, root: str, paths: Iterable[str], schema: StructType | str) -> DataFrame:
    """The rows of some buckets' folders; none for no folder."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    paths = [path for path in paths if path]
    if not paths:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", root.rstrip("/")).parquet(*paths)
    return rows.select(*schema.names)


def staged(
    rows: DataFrame, root: str, store: str, touched: Iterable[int], dealt: bool = False
) -> list[tuple[str, int, str]]:
    """Write the new rows of the touched buckets; nobody reads them before ``publish``.

    Rows that are ``dealt`` lie in ranges of buckets already, and are written as they lie.
    """
    folder = f"{root.rstrip('/')}/{store}/generation={uuid.uuid4().hex}"
    (rows if dealt else rows.hint("rebalance", BUCKET)).write.partitionBy(BUCKET).parquet(folder)
    written = rows.sparkSession.read.schema(rows.schema).parquet(folder).select(BUCKET).distinct()
    there = {r[0] for r in written.collect()}  # the touched buckets, at most
    # A bucket that became empty has no folder, and is listed as having none.
    return [(store, b, f"{folder}/{BUCKET}={b}" if b in there else "") for b in touched]


def publish(spark: SparkSession, root: str, entries: list[tuple[str, int, str]]) -> None:
    """Name the new folders, all at once."""
    listed = spark.createDataFrame(entries, f"store string, {BUCKET} int, folder string")
    listed = listed.withColumn("generation", F.unix_micros(F.current_timestamp()))
    listed.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/{_LIST}")


def folded_batch(
    changes: DataFrame,
    root: str,
    key: str | Sequence[str],
    order_by: Sequence[str] = LOG_ORDER,
    *,
    buckets: int = 1024,
    bucket: Column | None = None,
) -> tuple[list[tuple[str, int, str]], list[str]]:
    """Fold a batch into the buckets it touches, without naming the result yet.

    The entries to ``publish``, and the folders that the same buckets had before. The batch
    is read several times: one that is costly to make (decoded from a log) should be written
    down by the caller.
    """
    spark, root = changes.sparkSession, root.rstrip("/")
    keys = [key] if isinstance(key, str) else list(key)
    number = F.pmod(F.xxhash64(*keys), F.lit(buckets)) if bucket is None else bucket
    batch = changes.withColumn(BUCKET, F.coalesce(number.cast("int"), F.lit(NO_BUCKET)))
    touched = [r[0] for r in batch.select(BUCKET).distinct().collect()]  # at most ``buckets``
    if not touched:
        return [], []
    kept = folders(spark, root)
    paths = [kept[b] for b in touched if kept.get(b)]
    rows = batch.unionByName(rows_of(spark, root, paths, batch.schema))
    hot = find_hot_keys(rows, keys, order_by)
    group, order_by = [BUCKET, *keys, SLICE], list(order_by)
    # Dealt by ranges, so that one shuffle and one sort serve the fold and the files: a task has
    # whole slices of keys, and the buckets it writes are next to each other.
    dealt = with_slices(rows, keys, order_by, hot).repartitionByRange(*group)
    place = F.struct(*order_by)
    before = F.lag(place).over(Window.partitionBy(*group).orderBy(*order_by))
    # The same change again stands right behind the first.
    once = dealt.withColumn(_BEFORE, before).where(~F.col(_BEFORE).eqNullSafe(place)).drop(_BEFORE)
    # Deletes stay among the rows, to close what a later batch brings; readers skip them.
    folded = history(once, [BUCKET, *keys], order_by, operation=None, hot=hot)
    return staged(folded, root, HISTORY, touched, dealt=True), paths


def apply_batch(
    changes: DataFrame,
    root: str,
    key: str | Sequence[str],
    order_by: Sequence[str] = LOG_ORDER,
    *,
    buckets: int = 1024,
    bucket: Column | None = None,
    operation: str = "operation",
) -> None:
    """Bring the history below ``root`` up to date with a batch of changes.

    A change that is there already, by key and place in the order, counts once, so
    a batch may be applied again. ``buckets`` and ``bucket`` are the same for all
    batches; each bucket should be small enough for one task. Rows whose bucket is NULL
    have one of their own.
    """
    entries, _ = folded_batch(changes, root, key, order_by, buckets=buckets, bucket=bucket)
    if entries:
        publish(changes.sparkSession, root, entries)


def kept_history(spark: SparkSession, root: str, operation: str = "operation") -> DataFrame:
    """All versions, from the newest generation of each bucket."""
    root = root.rstrip("/")
    paths = [path for path in folders(spark, root).values() if path]
    if not paths:
        raise ValueError(f"no history below {root}")
    kept = spark.read.option("basePath", root).parquet(*paths)
    return kept.where(F.col(operation) != DELETE).drop(BUCKET, "generation")
