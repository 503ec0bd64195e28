"""Reinvestment compliance: what was owed, what was invested, who is at risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions import rules


def _eur(column: Column) -> Column:
    return F.coalesce(column.cast(rules.EUR), F.lit(0).cast(rules.EUR))


def facility_subsidies(entitlement: DataFrame) -> DataFrame:
    """Subsidy and reinvestment obligation of each eligible facility."""
    total = F.sum("subsidy_entitlement_eur").cast(rules.EUR)
    return (
        entitlement.where("subsidy_eligible")
        .groupBy("facility_id", "facility_name", "sector")
        .agg(
            total.alias("total_subsidy_eur"),
            rules.reinvestment_obligation(total).alias("reinvestment_obligation_eur"),
        )
    )


def investment_pivot(investments: DataFrame) -> DataFrame:
    """Investment sums by status, and by category among the confirmed."""
    amount, confirmed = F.col("amount_eur"), F.col("status") == "confirmed"

    def total_where(condition: Column) -> Column:
        return F.sum(F.when(condition, amount).otherwise(F.lit(0))).cast(rules.EUR)

    by_category = [
        total_where(confirmed & (F.col("category") == category)).alias(f"{category}_eur")
        for category in rules.INVESTMENT_CATEGORIES
    ]
    return investments.groupBy("facility_id").agg(
        F.count("*").alias("total_investments"),
        total_where(confirmed).alias("confirmed_investment_eur"),
        total_where(F.col("status") == "pending").alias("pending_investment_eur"),
        F.sum(amount).cast(rules.EUR).alias("total_investment_eur"),
        *by_category,
    )


def investment_compliance(subsidies: DataFrame, pivot: DataFrame) -> DataFrame:
    """Both sides have one row per facility before they meet."""
    confirmed = _eur(F.col("confirmed_investment_eur"))
    total = _eur(F.col("total_investment_eur"))
    obligation = F.col("reinvestment_obligation_eur")
    return subsidies.join(pivot, "facility_id", "left").select(
        "facility_id",
        "facility_name",
        "sector",
        "total_subsidy_eur",
        "reinvestment_obligation_eur",
        confirmed.alias("confirmed_investment_eur"),
        _eur(F.col("pending_investment_eur")).alias("pending_investment_eur"),
        total.alias("total_investment_eur"),
        rules.compliance_pct(confirmed, obligation).alias("compliance_pct"),
        rules.compliance_status(confirmed, total, obligation).alias("compliance_status"),
        *[_eur(F.col(f"{c}_eur")).alias(f"{c}_eur") for c in rules.INVESTMENT_CATEGORIES],
        rules.flexibility_bonus(_eur(F.col("flexibility_eur")), confirmed).alias(
            "flexibility_bonus_eligible"
        ),
    )


def compliance_summary(
    facilities: DataFrame, monthly: DataFrame, entitlement: DataFrame, compliance: DataFrame
) -> DataFrame:
    """One row per facility, with or without readings, subsidy or investment."""
    consumption = monthly.groupBy("facility_id").agg(
        F.sum("total_kwh").cast(rules.KWH).alias("total_kwh"),
        F.count_distinct("consumption_month").alias("months_active"),
        F.avg("total_kwh").alias("avg_monthly_kwh"),
    )
    subsidy = entitlement.groupBy("facility_id").agg(
        F.sum("subsidy_entitlement_eur").alias("subsidy_sum_eur")
    )
    invested = compliance.select(
        "facility_id",
        "confirmed_investment_eur",
        "reinvestment_obligation_eur",
        "compliance_pct",
        "compliance_status",
        "flexibility_bonus_eligible",
    )
    no_kwh = F.lit(0).cast(rules.KWH)
    return (
        facilities.join(consumption, "facility_id", "left")
        .join(subsidy, "facility_id", "left")
        .join(invested, "facility_id", "left")
        .select(
            "facility_id",
            F.col("name").alias("facility_name"),
            "sector",
            "region",
            "subsidy_eligible",
            F.coalesce("total_kwh", no_kwh).alias("total_kwh_ytd"),
            F.coalesce("months_active", F.lit(0).cast("bigint")).alias("months_with_readings"),
            F.coalesce("avg_monthly_kwh", F.lit(0).cast("decimal(22,7)")).alias("avg_monthly_kwh"),
            _eur(F.col("subsidy_sum_eur")).alias("total_subsidy_eur"),
            _eur(F.col("confirmed_investment_eur")).alias("confirmed_investment_eur"),
            _eur(F.col("reinvestment_obligation_eur")).alias("reinvestment_obligation_eur"),
            F.coalesce("compliance_pct", F.lit(0).cast("decimal(18,1)")).alias("compliance_pct"),
            F.coalesce("compliance_status", F.lit("N/A")).alias("compliance_status"),
            F.coalesce("flexibility_bonus_eligible", F.lit(False)).alias("flexibility_bonus_eligible"),
        )
    )


def compliance_report(summary: DataFrame) -> DataFrame:
    return summary.select(
        "facility_name",
        "compliance_status",
        "total_subsidy_eur",
        "compliance_pct",
        "flexibility_bonus_eligible",
    ).orderBy("compliance_pct", "facility_name")


def at_risk(report: DataFrame) -> DataFrame:
    """Rows of a report or summary whose facility may miss its obligation."""
    return report.where(rules.is_at_risk(F.col("compliance_status"), F.col("compliance_pct")))


def live_context(summary: DataFrame) -> DataFrame:
    """The compliance columns quoted next to retrieved text, lowest percentage first."""
    return summary.select(
        "facility_name",
        "sector",
        "compliance_status",
        "total_subsidy_eur",
        "confirmed_investment_eur",
        "reinvestment_obligation_eur",
        "compliance_pct",
        "flexibility_bonus_eligible",
    ).orderBy("compliance_pct", "facility_name")


def reinvestment_deadlines(entitlement: DataFrame, investments: DataFrame) -> DataFrame:
    """Per facility: obligation, deadline of the first and last month, and what
    confirmed investment came in time for the last one.

    Unmet principal is what would have to be repaid; no interest is added.
    """
    owed = (
        entitlement.where("subsidy_eligible")
        .groupBy("facility_id")
        .agg(
            rules.reinvestment_obligation(F.sum("subsidy_entitlement_eur")).alias("obligation_eur"),
            F.min(rules.reinvestment_deadline(F.col("consumption_month"))).alias("first_deadline"),
            F.max(rules.reinvestment_deadline(F.col("consumption_month"))).alias("last_deadline"),
        )
    )
    # One row per facility and day, combined before the shuffle; the deadline
    # is compared after that.
    paid = (
        investments.where(F.col("status") == "confirmed")
        .groupBy("facility_id", F.col("investment_date").cast("date").alias("paid_on"))
        .agg(F.sum("amount_eur").cast(rules.EUR).alias("paid_eur"))
    )
    in_time = F.sum(F.when(F.col("paid_on") <= F.col("last_deadline"), F.col("paid_eur")))
    return (
        owed.join(paid, "facility_id", "left")
        .groupBy("facility_id", "obligation_eur", "first_deadline", "last_deadline")
        .agg(_eur(in_time).alias("invested_in_time_eur"))
        .withColumn(
            "principal_to_repay_eur",
            F.greatest(
                F.col("obligation_eur") - F.col("invested_in_time_eur"), F.lit(0).cast(rules.EUR)
            ).cast(rules.EUR),
        )
    )
