"""Which payment meets which month's obligation, and what is left to repay.

Each month's subsidy has to be reinvested by a deadline of its own. Money counts for any
month whose deadline it does not miss, so it goes to the earliest deadline first. With
O(k) the obligations up to the k-th deadline and P(k) the money paid by then, what can be
matched up to there is

    M(k) = O(k) + min(0, min over j <= k of P(j) - O(j))

which is two running sums and a running minimum over obligations and payments in the
order of their dates: one shuffle by debtor. The matched money is the first M of the
payments, so who paid what follows from laying both sums on one line and cutting it at
the ends of either; there are at most as many pieces as payments and obligations together.

Payments are summed by debtor and day first, within each task, so that a debtor has as
many rows as there are days and months, however many payments it made.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions import rules

# Half of a whole cent is owed at times.
OWED = "decimal(18,3)"
_SUM = "decimal(28,3)"
_LINE = "__line"


def monthly_obligations(entitlement: DataFrame) -> DataFrame:
    """What each month of an eligible facility obliges it to invest, and until when."""
    month = F.col("consumption_month")
    share = (F.col("subsidy_entitlement_eur") * F.lit(rules.REINVESTED_SHARE)).cast(OWED)
    return entitlement.where("subsidy_eligible").select(
        "facility_id",
        "consumption_month",
        rules.reinvestment_deadline(month).alias("deadline"),
        share.alias("obligation_eur"),
    )


def confirmed_payments(investments: DataFrame) -> DataFrame:
    """Confirmed money by facility and day; sums that are not above zero are no payment."""
    return (
        investments.where(F.col("status") == "confirmed")
        .groupBy("facility_id", F.col("investment_date").cast("date").alias("paid_on"))
        .agg(F.sum("amount_eur").cast(OWED).alias("paid_eur"))
        .where("paid_on IS NOT NULL AND paid_eur > 0")
    )


def _before(keys: Sequence[str], *order) -> tuple:
    up_to_here = Window.partitionBy(*keys).orderBy(*order)
    return up_to_here.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def match_deadlines(
    obligations: DataFrame,
    payments: DataFrame,
    key: str = "facility_id",
    *,
    order: str = "consumption_month",
    deadline: str = "deadline",
    owed: str = "obligation_eur",
    paid_on: str = "paid_on",
    paid: str = "paid_eur",
) -> DataFrame:
    """The obligations with ``met``, ``unmet`` and ``met_before``, earliest deadline first.

    ``order`` tells obligations of one deadline apart. Money paid on the day of the
    deadline is in time. Obligations without a key or deadline are met by nothing;
    amounts that are NULL or below zero count as zero. ``met_before`` is what the debtor's
    earlier obligations have taken, the place on the line that ``allocations`` cuts.
    """
    rest = [c for c in obligations.columns if c != key]
    zero = F.lit(0).cast(_SUM)
    row = F.struct(*rest)
    kind = obligations.select(row.alias("row")).schema["row"].dataType
    claims = obligations.select(
        key,
        F.col(deadline).cast("date").alias("__on"),
        F.lit(1).alias("__side"),
        F.col(order).alias("__order"),
        F.greatest(F.coalesce(F.col(owed).cast(_SUM), zero), zero).alias("__owed"),
        zero.alias("__paid"),
        row.alias("__row"),
    )
    no_order = F.lit(None).cast(obligations.schema[order].dataType)
    money = payments.where(F.col(key).isNotNull()).select(
        key,
        F.col(paid_on).cast("date").alias("__on"),
        F.lit(0).alias("__side"),
        no_order.alias("__order"),
        zero.alias("__owed"),
        F.greatest(F.coalesce(F.col(paid).cast(_SUM), zero), zero).alias("__paid"),
        F.lit(None).cast(kind).alias("__row"),
    )
    # What nothing can meet is a debtor by itself, so that it is no crowded one.
    counts = F.col(key).isNotNull() & F.col("__on").isNotNull()
    apart = F.when(~counts, F.xxhash64("__order", "__row"))
    debtor, place = [key, "__apart"], ["__on", "__side", "__order"]
    window = _before(debtor, *place)
    swept = (
        claims.unionByName(money)
        .withColumn("__apart", apart)
        .withColumns({"__o": F.sum("__owed").over(window), "__p": F.sum("__paid").over(window)})
        .withColumn("__least", F.min(F.when(F.col("__side") == 1, F.col("__p") - F.col("__o"))).over(window))
        .where("__side = 1")
        .withColumn("__m", (F.col("__o") + F.least(zero, F.col("__least"))).cast(_SUM))
        .withColumn("__m0", F.coalesce(F.lag("__m").over(Window.partitionBy(*debtor).orderBy(*place)), zero))
    )
    met = (F.col("__m") - F.col("__m0")).cast(OWED)
    return swept.select(
        key,
        *[F.col("__row")[c].alias(c) for c in rest],
        met.alias("met"),
        (F.col("__owed") - met).cast(OWED).alias("unmet"),
        F.col("__m0").alias("met_before"),
    )


def allocations(
    matched: DataFrame,
    payments: DataFrame,
    key: str = "facility_id",
    *,
    order: str = "consumption_month",
    paid_on: str = "paid_on",
    paid: str = "paid_eur",
) -> DataFrame:
    """Which day's money met which obligation, and how much of it.

    One row for each piece: the key, ``order``, ``paid_on`` and ``amount``. Money that
    met nothing is not among them.
    """
    earlier = Window.partitionBy(key).orderBy(paid_on).rowsBetween(Window.unboundedPreceding, -1)
    money = payments.where((F.col(key).isNotNull()) & (F.col(paid) > 0))
    starts = F.coalesce(F.sum(F.col(paid).cast(_SUM)).over(earlier), F.lit(0).cast(_SUM))
    no_order = F.lit(None).cast(matched.schema[order].dataType)
    no_day = F.lit(None).cast(payments.schema[paid_on].dataType)
    taken = matched.where("met > 0")
    claims = taken.select(
        key,
        F.col("met_before").alias(_LINE),
        F.struct(F.lit(True).alias("open"), F.col(order).alias("value")).alias("__claim"),
        no_day.alias("__day"),
    )
    # Behind the last claim nothing is taken any more.
    ends = taken.groupBy(key).agg(F.max(F.col("met_before") + F.col("met")).cast(_SUM).alias(_LINE)).select(
        key,
        _LINE,
        F.struct(F.lit(False).alias("open"), no_order.alias("value")).alias("__claim"),
        no_day.alias("__day"),
    )
    nobody = F.lit(None).cast(claims.schema["__claim"].dataType)
    days = money.select(key, starts.alias(_LINE), nobody.alias("__claim"), F.col(paid_on).alias("__day"))
    window = _before([key], _LINE)
    cut = claims.unionByName(ends).unionByName(days).groupBy(key, _LINE).agg(
        F.max("__claim").alias("__claim"), F.max("__day").alias("__day")
    )
    pieces = cut.withColumns(
        {
            "__claim": F.last("__claim", ignorenulls=True).over(window),
            "__day": F.last("__day", ignorenulls=True).over(window),
            "__end": F.lead(_LINE).over(Window.partitionBy(key).orderBy(_LINE)),
        }
    )
    return pieces.where(F.col("__claim.open") & F.col("__end").isNotNull()).select(
        key,
        F.col("__claim.value").alias(order),
        F.col("__day").alias(paid_on),
        (F.col("__end") - F.col(_LINE)).cast(OWED).alias("amount"),
    )


def repayment(entitlement: DataFrame, investments: DataFrame) -> DataFrame:
    """Per facility and month: obligation, deadline, what was invested in time for it, and
    the principal to repay."""
    matched = match_deadlines(monthly_obligations(entitlement), confirmed_payments(investments))
    return matched.select(
        "facility_id",
        "consumption_month",
        "deadline",
        "obligation_eur",
        F.col("met").alias("invested_in_time_eur"),
        F.col("unmet").alias("principal_to_repay_eur"),
    )


def repayment_by_facility(repaid: DataFrame, as_of) -> DataFrame:
    """Per facility: what is overdue on a day, what is still to be met later, and the next deadline."""
    late = F.col("deadline") < as_of
    unmet = F.col("principal_to_repay_eur")
    total = lambda column: F.coalesce(F.sum(column), F.lit(0)).cast(OWED)
    return repaid.groupBy("facility_id").agg(
        total(F.col("obligation_eur")).alias("obligation_eur"),
        total(F.when(late, unmet)).alias("overdue_eur"),
        total(F.when(~late, unmet)).alias("still_to_meet_eur"),
        F.min(F.when(~late & (unmet > 0), F.col("deadline"))).alias("next_deadline"),
        F.count_if(late & (unmet > 0)).alias("months_overdue"),
    )
