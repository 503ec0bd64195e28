"""Marts that follow their inputs batch by batch, instead of being built anew.

A correction takes the old version of a reading out of its month and puts the new one in.
A batch is folded into the history's buckets it touches; what was current there before,
counted negatively, and what is current now add up to signed sums per facility and month,
in which everything unchanged cancels out. Only months with a sum are read, added to and
written again, and what changed in them, as entitlement at the month's price, is added to
the totals of its facilities the same way. A new price counts as a change of its month.

Kept are sums that can be added to: readings, kWh and corrected readings per facility and
month, and kWh, months and entitlement per facility. What follows from them (averages,
rates, running totals, compliance) is worked out on reading, from a row per facility or
per facility and month. All tables move on in one step with the history, so a batch that
fails half way, or comes again, changes nothing. Facilities are joined on reading: a change
of theirs needs no batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import rules
from strandline.operators import kept
from strandline.operators.envelope import DELETE, LOG_ORDER
from strandline.plans import compliance as C
from strandline.plans import entitlement as E
from strandline.session import shared_dir

_MONTHLY, _TOTALS, _PRICES = "monthly", "totals", "prices"
_SUMS = ("readings", "measured", "kwh", "corrected")
_MONTHLY_ROW = (
    f"facility_id long, month date, readings long, measured long, kwh decimal(28,3), corrected long, {kept.BUCKET} int"
)
_TOTALS_ROW = f"facility_id long, kwh decimal(28,3), months long, subsidy_eur decimal(28,2), {kept.BUCKET} int"
_PRICES_ROW = f"month date, price decimal(11,6), {kept.BUCKET} int"


def _month_bucket(month: Column) -> Column:
    return F.coalesce(F.year(month) * 12 + F.month(month), F.lit(kept.NO_BUCKET)).cast("int")


def _summed(rows: DataFrame, keys: Sequence[str], sums: Sequence[str], keep: str) -> DataFrame:
    """Sums per key in the types of the rows, as far as there is something to keep."""
    kinds = {c: rows.schema[c].dataType for c in sums}
    made = rows.groupBy(*keys, kept.BUCKET).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in sums])
    return made.where(keep).select(*rows.columns)


def _signed(rows: DataFrame, sign: int, columns: Sequence[str]) -> DataFrame:
    return rows if sign > 0 else rows.withColumns({c: (-F.col(c)).cast(rows.schema[c].dataType) for c in columns})


def _readings(versions: DataFrame, sign: int) -> DataFrame:
    """Current readings as monthly sums, counted ``sign`` times."""
    month = rules.month_of(F.col("reading_timestamp")).cast("date")
    current = versions.where(F.col("is_current") & (F.col("operation") != DELETE))
    made = current.groupBy("facility_id", month.alias("month")).agg(
        F.count("*").alias("readings"),
        F.count("reported_kwh").alias("measured"),
        F.coalesce(F.sum("reported_kwh"), F.lit(0)).cast("decimal(28,3)").alias("kwh"),
        F.count_if("corrected").alias("corrected"),
    )
    return _signed(made.withColumn(kept.BUCKET, _month_bucket(F.col("month"))), sign, _SUMS)


def _amounts(monthly: DataFrame, prices: DataFrame, buckets: int, sign: int) -> DataFrame:
    """What each month adds to its facility's totals."""
    amount = F.round(rules.unrounded_entitlement(F.col("kwh"), F.col("price")), 2).cast("decimal(28,2)")
    return _signed(
        monthly.join(F.broadcast(prices.select("month", "price")), "month", "left").select(  # a row for each month
            "facility_id",
            "kwh",
            F.lit(1).cast("long").alias("months"),
            amount.alias("subsidy_eur"),
            F.coalesce(F.pmod(F.xxhash64("facility_id"), F.lit(buckets)).cast("int"), F.lit(kept.NO_BUCKET)).alias(kept.BUCKET),
        ),
        sign,
        ("kwh", "months", "subsidy_eur"),
    )


def _touched(rows: DataFrame) -> list[int]:
    """Buckets with rows; as many as there are months or facility buckets, at most."""
    return [r[0] for r in rows.select(kept.BUCKET).distinct().collect()]


def apply_changes(
    changes: DataFrame | None,
    root: str,
    monthly_prices: DataFrame,
    order_by: Sequence[str] = LOG_ORDER,
    *,
    buckets: int = 1024,
    facility_buckets: int = 256,
    spark: SparkSession | None = None,
) -> dict[str, list[int]]:
    """Bring the marts below ``root`` up to date with changes of readings and with prices.

    ``monthly_prices`` has ``price_month`` and ``avg_price_eur_per_kwh``, a row for each
    calendar month. ``changes`` may be None where only prices are new. Returned are the
    buckets of each table that were written; months are numbered year * 12 + month.
    """
    spark, root = spark or changes.sparkSession, root.rstrip("/")
    entries, old_paths = ([], []) if changes is None else kept.folded_batch(
        changes, root, "reading_id", order_by, buckets=buckets
    )
    months, totals, known = (kept.folders(spark, root, store) for store in (_MONTHLY, _TOTALS, _PRICES))

    # Rows that a batch leaves alone are there twice, with both signs, and cancel out.
    delta = spark.createDataFrame([], _MONTHLY_ROW)
    for paths, sign in (([folder for _, _, folder in entries if folder], 1), (old_paths, -1)):
        if paths:
            delta = delta.unionByName(_readings(spark.read.option("basePath", root).parquet(*paths), sign))
    delta = _summed(delta, ["facility_id", "month"], _SUMS, "readings <> 0 OR measured <> 0 OR kwh <> 0 OR corrected <> 0")
    path = shared_dir(spark, "mart-changes")  # several steps read it
    delta.write.parquet(path)
    delta = spark.read.schema(delta.schema).parquet(path)

    prices = monthly_prices.select(
        F.col("price_month").cast("date").alias("month"),
        F.col("avg_price_eur_per_kwh").cast("decimal(11,6)").alias("price"),
        F.lit(0).alias(kept.BUCKET),
    )
    old_prices = kept.rows_of(spark, root, known.values(), _PRICES_ROW)
    before = old_prices.select("month", F.col("price").alias("old"))
    paired = prices.select("month", "price").join(before, "month", "full")
    moved = paired.where(~F.col("price").eqNullSafe(F.col("old"))).select(_month_bucket(F.col("month")).alias(kept.BUCKET))

    touched, moved = _touched(delta), _touched(moved)
    priced = [b for b in moved if months.get(b) and b not in touched]
    before = kept.rows_of(spark, root, [months.get(b) for b in [*touched, *priced]], _MONTHLY_ROW)
    after = _summed(before.unionByName(delta), ["facility_id", "month"], _SUMS, "readings <> 0")
    if touched:
        entries = [*entries, *kept.staged(after.where(F.col(kept.BUCKET).isin(touched)), root, _MONTHLY, touched)]

    written = {_MONTHLY: sorted(touched), _TOTALS: []}
    if touched or priced:
        was, now = _amounts(before, old_prices, facility_buckets, -1), _amounts(after, prices, facility_buckets, 1)
        gained = _summed(
            was.unionByName(now), ["facility_id"], ("kwh", "months", "subsidy_eur"), "kwh <> 0 OR months <> 0 OR subsidy_eur <> 0"
        )
        path = shared_dir(spark, "total-changes")
        gained.write.parquet(path)
        gained = spark.read.schema(gained.schema).parquet(path)
        facilities = _touched(gained)
        held = kept.rows_of(spark, root, [totals.get(b) for b in facilities], _TOTALS_ROW)
        summed = _summed(held.unionByName(gained), ["facility_id"], ("kwh", "months", "subsidy_eur"), "months <> 0")
        entries = [*entries, *kept.staged(summed, root, _TOTALS, facilities)] if facilities else entries
        written[_TOTALS] = sorted(facilities)
    if moved:
        entries = [*entries, *kept.staged(prices, root, _PRICES, [0])]
    if entries:
        kept.publish(spark, root, entries)
    return written


def monthly_rows(spark: SparkSession, root: str) -> DataFrame:
    """The kept sums per facility and month."""
    return kept.rows_of(spark, root, kept.folders(spark, root, _MONTHLY).values(), _MONTHLY_ROW).drop(kept.BUCKET)


def monthly_consumption(spark: SparkSession, root: str, facilities: DataFrame) -> DataFrame:
    """``entitlement.monthly_consumption`` from the kept sums."""
    names = facilities.select("facility_id", F.col("name").alias("facility_name"), "sector", "region")
    rows = monthly_rows(spark, root)
    return rows.join(names, "facility_id").select(
        "facility_id",
        "facility_name",
        "sector",
        "region",
        F.col("month").cast("timestamp").alias("consumption_month"),
        F.col("readings").alias("reading_count"),
        F.when(F.col("measured") > 0, F.col("kwh")).cast(rules.KWH).alias("total_kwh"),
        F.round(F.col("kwh") / F.nullif(F.col("measured"), F.lit(0)), 7).cast("decimal(16,7)").alias("avg_kwh_per_reading"),
        F.col("corrected").alias("corrected_readings"),
        rules.correction_rate_pct(F.col("corrected"), F.col("readings")).alias("correction_rate_pct"),
    )


def subsidy_entitlement(spark: SparkSession, root: str, facilities: DataFrame, monthly_prices: DataFrame) -> DataFrame:
    """``entitlement.subsidy_entitlement``, with its running totals, from the kept sums."""
    return E.subsidy_entitlement(monthly_consumption(spark, root, facilities), facilities, monthly_prices)


def compliance_summary(spark: SparkSession, root: str, facilities: DataFrame, investments: DataFrame) -> DataFrame:
    """``compliance.compliance_summary`` from the kept totals: no month and no reading is read."""
    totals = kept.rows_of(spark, root, kept.folders(spark, root, _TOTALS).values(), _TOTALS_ROW)
    rows = totals.drop(kept.BUCKET).join(facilities, "facility_id")
    total = F.when(F.col("subsidy_eligible"), F.col("subsidy_eur")).otherwise(F.lit(0)).cast(rules.EUR)
    rows = rows.select("facility_id", "name", "sector", "subsidy_eligible", "kwh", "months", total.alias("subsidy"))
    subsidies = rows.where("subsidy_eligible").select(
        "facility_id",
        F.col("name").alias("facility_name"),
        "sector",
        F.col("subsidy").alias("total_subsidy_eur"),
        rules.reinvestment_obligation(F.col("subsidy")).alias("reinvestment_obligation_eur"),
    )
    met = C.investment_compliance(subsidies, C.investment_pivot(investments))
    # A facility's totals as if they were one month's, with the months beside them.
    one = rows.select(
        "facility_id",
        F.col("kwh").cast(rules.KWH).alias("total_kwh"),
        F.lit(1).alias("consumption_month"),
        F.col("subsidy").alias("subsidy_entitlement_eur"),
    )
    counted = rows.select("facility_id", F.col("months").alias("__months"), (F.col("kwh") / F.col("months")).cast("decimal(22,7)").alias("__mean"))
    made = C.compliance_summary(facilities, one, one, met).join(counted, "facility_id", "left")
    return made.withColumns(
        {
            "months_with_readings": F.coalesce("__months", F.lit(0).cast("bigint")),
            "avg_monthly_kwh": F.coalesce("__mean", F.lit(0).cast("decimal(22,7)")),
        }
    ).drop("__months", "__mean")
