"""Monthly consumption and the subsidy it entitles a facility to."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions import rules


def monthly_consumption(readings: DataFrame, facilities: DataFrame) -> DataFrame:
    """Consumption per facility and month; readings of unknown facilities drop out.

    Readings are reduced to one row per facility and month before the join, so
    the join moves the small result rather than the readings, and a facility
    with most of the readings is combined within each task first.
    """
    corrected = F.count_if("corrected")
    monthly = readings.groupBy(
        "facility_id", rules.month_of(F.col("reading_timestamp")).alias("consumption_month")
    ).agg(
        F.count("*").alias("reading_count"),
        F.sum("reported_kwh").cast(rules.KWH).alias("total_kwh"),
        F.avg("reported_kwh").alias("avg_kwh_per_reading"),
        corrected.alias("corrected_readings"),
        rules.correction_rate_pct(corrected, F.count("*")).alias("correction_rate_pct"),
    )
    names = facilities.select("facility_id", F.col("name").alias("facility_name"), "sector", "region")
    return monthly.join(names, "facility_id").select(
        "facility_id",
        "facility_name",
        "sector",
        "region",
        "consumption_month",
        "reading_count",
        "total_kwh",
        "avg_kwh_per_reading",
        "corrected_readings",
        "correction_rate_pct",
    )


def subsidy_entitlement(
    monthly: DataFrame, facilities: DataFrame, monthly_prices: DataFrame
) -> DataFrame:
    """Entitlement per facility and month, with a running total per facility.

    ``monthly_prices`` has one row per calendar month, a few thousand at most
    for any real span of years, which is why it may be broadcast. The running
    total sums unrounded amounts and is rounded at the end.
    """
    eligibility = facilities.select("facility_id", "subsidy_eligible")
    priced = monthly.join(eligibility, "facility_id").join(
        F.broadcast(monthly_prices),
        F.col("consumption_month") == F.col("price_month"),
        "left",
    )
    kwh, price = F.col("total_kwh"), F.col("avg_price_eur_per_kwh")
    eligible = F.col("subsidy_eligible")
    so_far = (
        Window.partitionBy("facility_id")
        .orderBy("consumption_month")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = F.round(F.sum(rules.unrounded_entitlement(kwh, price)).over(so_far), 2).cast(rules.EUR)
    nothing = F.lit(0).cast(rules.EUR)
    return priced.select(
        "facility_id",
        "facility_name",
        "sector",
        "consumption_month",
        "total_kwh",
        "subsidy_eligible",
        price.alias("market_price_eur_per_kwh"),
        F.col("avg_price_eur_per_mwh").alias("market_price_eur_per_mwh"),
        "min_price_eur_per_mwh",
        "max_price_eur_per_mwh",
        F.lit(rules.TARGET_PRICE_EUR_PER_KWH).alias("target_price_eur_per_kwh"),
        F.round(rules.price_gap(price), 6).cast("decimal(12,6)").alias("price_gap_eur_per_kwh"),
        rules.eligible_kwh(eligible, kwh).alias("eligible_kwh"),
        rules.entitlement_eur(eligible, kwh, price).alias("subsidy_entitlement_eur"),
        F.when(eligible, running).otherwise(nothing).alias("cumulative_subsidy_eur"),
    )


def months_without_price(entitlement: DataFrame) -> DataFrame:
    """Months whose entitlement is zero only because no price is known."""
    return (
        entitlement.where(F.col("market_price_eur_per_kwh").isNull())
        .groupBy("consumption_month")
        .agg(F.count("*").alias("facilities"))
    )
