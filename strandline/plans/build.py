"""Building the marts as tables, each read by the next, and testing them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from strandline.functions import rules
from strandline.operators import quality
from strandline.plans import compliance, entitlement, staging
from strandline.sources.tables import write_overwrite

# The tests declared for the marts.
DECLARED_RULES = {
    "monthly_consumption": (
        quality.NotNull("facility_id"),
        quality.NotNull("consumption_month"),
        quality.NotNull("total_kwh"),
    ),
    "subsidy_entitlement": (
        quality.NotNull("facility_id"),
        quality.NotNull("subsidy_entitlement_eur"),
    ),
    "investment_compliance": (
        quality.NotNull("facility_id"),
        quality.Unique("facility_id"),
        quality.AcceptedValues("compliance_status", rules.COMPLIANCE_STATUSES),
    ),
    "compliance_summary": (
        quality.NotNull("facility_id"),
        quality.Unique("facility_id"),
    ),
}


def build_marts(
    root: str,
    readings: DataFrame,
    facilities: DataFrame,
    prices: DataFrame,
    investments: DataFrame,
) -> dict[str, DataFrame]:
    """Write all four marts below ``root`` and return them as tables.

    The readings are scanned once, for the monthly grain; everything after
    that reads tables with at most a row per facility and month. Each mart is
    a new version, so readers of an earlier build are not disturbed.
    """
    spark = readings.sparkSession
    built: dict[str, DataFrame] = {}

    def keep(name: str, mart: DataFrame) -> DataFrame:
        built[name] = spark.read.parquet(write_overwrite(mart, f"{root.rstrip('/')}/{name}"))
        return built[name]

    dimension = staging.facilities(facilities)
    monthly = keep("monthly_consumption", entitlement.monthly_consumption(readings, dimension))
    entitled = keep(
        "subsidy_entitlement",
        entitlement.subsidy_entitlement(monthly, dimension, staging.wholesale_prices(prices)),
    )
    complied = keep(
        "investment_compliance",
        compliance.investment_compliance(
            compliance.facility_subsidies(entitled), compliance.investment_pivot(investments)
        ),
    )
    keep("compliance_summary", compliance.compliance_summary(dimension, monthly, entitled, complied))
    return built


def check_marts(marts: dict[str, DataFrame]) -> DataFrame:
    """The results of the declared tests, one row per test."""
    return quality.check_all(
        *[quality.check(marts[name], name, tests) for name, tests in DECLARED_RULES.items()]
    )
