"""Staging views: what the marts read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions.rules import month_of

# The column lists of the staging views.
FACILITY_COLUMNS = ("facility_id", "name", "sector", "region", "subsidy_eligible")
READING_COLUMNS = (
    "reading_id",
    "facility_id",
    "reading_timestamp",
    "reported_kwh",
    "corrected",
    "correction_reason",
    "valid_from",
    "valid_to",
    "is_current",
)
INVESTMENT_COLUMNS = (
    "investment_id",
    "facility_id",
    "investment_date",
    "amount_eur",
    "category",
    "status",
    "valid_from",
    "valid_to",
    "is_current",
)


def facilities(dimension: DataFrame) -> DataFrame:
    """All facilities, eligible or not."""
    return dimension.select(*FACILITY_COLUMNS)


def current_readings(versions: DataFrame) -> DataFrame:
    return versions.where("is_current").select(*READING_COLUMNS)


def current_investments(versions: DataFrame) -> DataFrame:
    return versions.where("is_current").select(*INVESTMENT_COLUMNS)


def wholesale_prices(prices: DataFrame) -> DataFrame:
    """Hourly prices by calendar month."""
    mwh, kwh = F.col("price_eur_per_mwh"), F.col("price_eur_per_kwh")
    return prices.groupBy(month_of(F.col("price_timestamp")).alias("price_month")).agg(
        F.round(F.avg(mwh), 2).cast("decimal(11,2)").alias("avg_price_eur_per_mwh"),
        F.round(F.avg(kwh), 6).cast("decimal(11,6)").alias("avg_price_eur_per_kwh"),
        F.round(F.min(mwh), 2).cast("decimal(11,2)").alias("min_price_eur_per_mwh"),
        F.round(F.max(mwh), 2).cast("decimal(11,2)").alias("max_price_eur_per_mwh"),
        F.count("*").alias("price_observations"),
    )
