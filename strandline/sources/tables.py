"""Reading, verifying and publishing tables.

Nothing here overwrites files a plan may still be reading: a full refresh goes
to a new versioned folder and a view is pointed at it once it is complete.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def read_table(
    spark: SparkSession, name_or_path: str, columns: Sequence[str] | None = None, fmt: str = "parquet"
) -> DataFrame:
    """A table by path (anything with a slash) or by catalog name."""
    if "/" in name_or_path:
        table = spark.read.format(fmt).load(name_or_path)
    else:
        table = spark.table(name_or_path)
    return table.select(*columns) if columns else table


def verify_table(table: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """One row: how many rows, which columns, and the first row as JSON text.

    The sample is a minimum, so that the same table always shows the same row.
    """
    sample = F.min_by(F.to_json(F.struct(*table.columns)), F.struct(*order_by))
    return table.agg(F.count("*").alias("row_count"), sample.alias("sample_row")).select(
        "row_count",
        F.lit(",".join(table.columns)).alias("columns"),
        F.lit(table.schema.simpleString()).alias("table_schema"),
        "sample_row",
    )


def _exists(spark: SparkSession, path: str) -> bool:
    # Spark's own reader answers for whatever file system the path is on.
    from pyspark.errors import AnalysisException

    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True


def balanced(table: DataFrame, *columns: str) -> DataFrame:
    """Bring the rows of a partition value together before a partitioned write.

    Without it every task writes a file per value. A crowded value is split
    over several tasks. Needs one shuffle, so other writes go without.
    """
    return table.hint("rebalance", *columns) if columns else table


def spread(table: DataFrame) -> DataFrame:
    """Give every core a part of a table stored in fewer pieces than there are cores.

    For work that is heavy per row. A table of many files is left as it is, and so is one
    of few files whose pieces give every core a task with rows: that is counted without
    reading a column, and saves a shuffle that sorts all rows.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    if len(table.inputFiles()) >= cores:
        return table
    filled = table.select(F.spark_partition_id().alias("task")).distinct().count()
    return table if filled >= cores else table.repartition(cores)


def write_overwrite(table: DataFrame, root: str, partition_by: Sequence[str] = ()) -> str:
    """Write a new version of a table below ``root`` and return its path."""
    path = f"{root.rstrip('/')}/version={uuid.uuid4().hex}"
    balanced(table, *partition_by).write.mode("error").partitionBy(*partition_by).parquet(path)
    return path


def create_if_absent(table: DataFrame, path: str) -> bool:
    """Write the table unless one is there; says whether none was there before.

    What another writer has put there in the meantime is left alone.
    """
    absent = not _exists(table.sparkSession, path)
    if absent:
        table.write.mode("ignore").parquet(path)
    return absent


def write_append(table: DataFrame, path: str) -> str:
    table.write.mode("append").parquet(path)
    return path


def typed(table: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """The declared columns in the declared types; a missing value stays NULL."""
    return table.select(*[F.col(name).cast(kind).alias(name) for name, kind in schema.items()])


_RELEASES = "releases"


def publish_full_refresh(table: DataFrame, schema: Mapping[str, str], root: str, view: str) -> DataFrame:
    """Replace the table published under ``root`` as a whole and read it back.

    Executors write the files in parallel. The rows in the files are counted
    and must be as many as were written; then one more line in the list of
    releases names the new version. ``open_published`` finds the newest in any
    session, and readers of ``view`` in this one see the old version until then.
    """
    spark = table.sparkSession
    written = Observation()
    path = write_overwrite(typed(table, schema).observe(written, F.count("*").alias("rows")), root)
    published = spark.read.parquet(path)
    rows = published.count()
    if rows != written.get["rows"]:
        raise RuntimeError(f"{path} holds {rows} rows of {written.get['rows']}")
    version = path.rsplit("/", 1)[1]
    spark.range(1).select(
        F.current_timestamp().alias("released_at"), F.lit(version).alias("version"), F.lit(rows).alias("rows")
    ).write.mode("append").parquet(f"{root.rstrip('/')}/{_RELEASES}")
    published.createOrReplaceTempView(view)
    return published


def open_published(spark: SparkSession, root: str) -> DataFrame:
    """The newest release below ``root``, whoever published it."""
    root = root.rstrip("/")
    newest = spark.read.parquet(f"{root}/{_RELEASES}").agg(F.max_by("version", "released_at")).first()[0]
    return spark.read.parquet(f"{root}/{newest}")


def publish_jdbc(
    table: DataFrame, schema: Mapping[str, str], url: str, target: str, options: Mapping[str, str]
) -> None:
    """Replace a table in a warehouse, in batches, from the executors.

    ``options`` carries driver and credentials; nothing is stored here.
    """
    writer = typed(table, schema).write.format("jdbc").mode("overwrite")
    writer.options(**{"batchsize": "500", "truncate": "true", **options}).options(
        url=url, dbtable=target
    ).save()


# The schemas of the published tables.
PUBLISHED_READINGS = {
    "reading_id": "bigint",
    "facility_id": "bigint",
    "reading_timestamp": "timestamp",
    "reported_kwh": "decimal(12,3)",
    "corrected": "boolean",
    "correction_reason": "string",
    "operation": "string",
    "cdc_timestamp": "timestamp",
    "bronze_offset": "bigint",
    "valid_from": "timestamp",
    "valid_to": "timestamp",
    "is_current": "boolean",
    "processed_at": "timestamp",
}
PUBLISHED_INVESTMENTS = {
    "investment_id": "bigint",
    "facility_id": "bigint",
    "investment_date": "date",
    "amount_eur": "decimal(14,2)",
    "category": "string",
    "status": "string",
    "operation": "string",
    "cdc_timestamp": "timestamp",
    "bronze_offset": "bigint",
    "valid_from": "timestamp",
    "valid_to": "timestamp",
    "is_current": "boolean",
    "processed_at": "timestamp",
}
PUBLISHED_FACILITIES = {
    "facility_id": "bigint",
    "name": "string",
    "sector": "string",
    "region": "string",
    "annual_consumption_mwh": "decimal(12,3)",
    "subsidy_eligible": "boolean",
}
PUBLISHED_PRICES = {
    "price_timestamp": "timestamp",
    "price_eur_per_mwh": "decimal(10,2)",
    "price_eur_per_kwh": "decimal(10,6)",
}
