"""The entitlement and reinvestment rules as column expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the scheme.
SUBSIDISED_SHARE = Decimal("0.5")
TARGET_PRICE_EUR_PER_KWH = Decimal("0.05")
REINVESTED_SHARE = Decimal("0.5")
FLEXIBILITY_SHARE = Decimal("0.8")
AT_RISK_BELOW_PCT = 50
REINVESTMENT_MONTHS = 48
INVESTMENT_CATEGORIES = ("renewable", "storage", "efficiency", "flexibility")
COMPLIANCE_STATUSES = ("COMPLIANT", "ON_TRACK", "AT_RISK")

# Wide enough for any sum, narrow enough that products keep all their scale.
KWH = "decimal(18,3)"
EUR = "decimal(18,2)"


def month_of(moment: Column) -> Column:
    return F.date_trunc("month", moment)


def correction_rate_pct(corrected_count: Column, row_count: Column) -> Column:
    return F.round(corrected_count * F.lit(Decimal("100.0")) / row_count, 1).cast("decimal(5,1)")


def price_gap(price: Column) -> Column:
    """What the market price exceeds the target by; a month without price has no gap."""
    return F.greatest(price - F.lit(TARGET_PRICE_EUR_PER_KWH), F.lit(Decimal("0")))


def eligible_kwh(eligible: Column, kwh: Column) -> Column:
    share = (kwh.cast(KWH) * F.lit(SUBSIDISED_SHARE)).cast("decimal(19,4)")
    return F.when(eligible, share).otherwise(F.lit(Decimal("0")).cast("decimal(19,4)"))


def unrounded_entitlement(kwh: Column, price: Column) -> Column:
    return kwh.cast(KWH) * F.lit(SUBSIDISED_SHARE) * price_gap(price)


def entitlement_eur(eligible: Column, kwh: Column, price: Column) -> Column:
    amount = F.round(unrounded_entitlement(kwh, price), 2).cast(EUR)
    return F.when(eligible, amount).otherwise(F.lit(Decimal("0")).cast(EUR))


def reinvestment_obligation(subsidy: Column) -> Column:
    return F.round(subsidy * F.lit(REINVESTED_SHARE), 2).cast(EUR)


def compliance_pct(confirmed: Column, obligation: Column) -> Column:
    """Share of the obligation that is met; NULL where there is none to meet."""
    ratio = confirmed.cast(EUR) / F.nullif(obligation.cast(EUR), F.lit(Decimal("0")).cast(EUR))
    return F.round(ratio * F.lit(100), 1).cast("decimal(18,1)")


def compliance_status(confirmed: Column, total: Column, obligation: Column) -> Column:
    """``total`` counts every investment, whatever its status."""
    compliant, on_track, at_risk = COMPLIANCE_STATUSES
    return (
        F.when(confirmed >= obligation, F.lit(compliant))
        .when(total >= obligation, F.lit(on_track))
        .otherwise(F.lit(at_risk))
    )


def flexibility_bonus(flexibility: Column, confirmed: Column) -> Column:
    """True as well where nothing is invested: 0 is 80 % of 0."""
    return F.coalesce(flexibility >= confirmed * F.lit(FLEXIBILITY_SHARE), F.lit(False))


def is_at_risk(status: Column, pct: Column) -> Column:
    return F.coalesce(status == "AT_RISK", F.lit(False)) | F.coalesce(
        pct < AT_RISK_BELOW_PCT, F.lit(False)
    )


def reinvestment_deadline(month: Column) -> Column:
    return F.add_months(month.cast("date"), REINVESTMENT_MONTHS)
