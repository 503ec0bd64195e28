import datetime as dt
from decimal import Decimal as D

import pytest

from strandline.operators import quality
from strandline.plans import compliance as C
from strandline.plans import entitlement as E
from strandline.plans import staging as S

JAN, FEB = dt.datetime(2026, 1, 1), dt.datetime(2026, 2, 1)


def facilities(spark, rows):
    return spark.createDataFrame(
        [(i, f"f{i}", "sector", "region", ok) for i, ok in rows],
        "facility_id long, name string, sector string, region string, subsidy_eligible boolean",
    )


def readings(spark, rows):
    return spark.createDataFrame(
        [(i, at, D(kwh), fixed) for i, at, kwh, fixed in rows],
        "facility_id long, reading_timestamp timestamp, reported_kwh decimal(12,3), corrected boolean",
    )


def prices(spark, rows):
    return spark.createDataFrame(
        [(at, D(mwh), D(mwh) / 1000) for at, mwh in rows],
        "price_timestamp timestamp, price_eur_per_mwh decimal(10,2), price_eur_per_kwh decimal(10,6)",
    )


def investments(spark, rows):
    return spark.createDataFrame(
        [(n, i, dt.date(2026, 1, 5), D(eur), cat, status) for n, (i, eur, cat, status) in enumerate(rows)],
        "investment_id long, facility_id long, investment_date date, amount_eur decimal(14,2), "
        "category string, status string",
    )


def entitled(spark, price_rows, reading_rows=None, ok=True):
    fac = facilities(spark, [(1, ok)])
    reads = readings(spark, reading_rows or [(1, JAN, "1000", False)])
    monthly = E.monthly_consumption(reads, S.facilities(fac))
    return E.subsidy_entitlement(monthly, fac, S.wholesale_prices(prices(spark, price_rows)))


@pytest.mark.parametrize(
    "price_rows, gap, amount",
    [
        ([], "0", "0"),  # no price for the month
        ([(JAN, "-20.00")], "0", "0"),  # negative mean
        ([(JAN, "50.00")], "0", "0"),  # exactly the target
        ([(JAN, "106.18")], "0.056180", "28.09"),
        ([(JAN, "100.00"), (JAN, "120.00")], "0.06", "30.00"),
    ],
)
def test_price_gap_and_entitlement(spark, price_rows, gap, amount):
    row = entitled(spark, price_rows).first()
    assert row.price_gap_eur_per_kwh == D(gap)
    assert row.subsidy_entitlement_eur == D(amount)
    assert row.cumulative_subsidy_eur == D(amount)
    assert row.eligible_kwh == D(500)


def test_months_without_price_are_counted(spark):
    assert E.months_without_price(entitled(spark, [])).count() == 1
    assert E.months_without_price(entitled(spark, [(JAN, "70.00")])).count() == 0


def test_ineligible_facility_gets_nothing(spark):
    row = entitled(spark, [(JAN, "100.00")], ok=False).first()
    assert (row.eligible_kwh, row.subsidy_entitlement_eur, row.cumulative_subsidy_eur) == (0, 0, 0)


def test_running_total_rounds_the_sum_not_the_months(spark):
    # 0.5 * 0.001 kWh * 9.95 EUR = 0.004975 per month: each rounds to 0.00, three make 0.01.
    months = [dt.datetime(2026, m, 1) for m in (1, 2, 3)]
    rows = entitled(
        spark,
        [(m, "10000.00") for m in months],
        [(1, m, "0.001", False) for m in months],
    ).orderBy("consumption_month").collect()
    assert [r.subsidy_entitlement_eur for r in rows] == [0, 0, 0]
    assert [r.cumulative_subsidy_eur for r in rows] == [D("0.00"), D("0.01"), D("0.01")]


def test_monthly_consumption(spark):
    reads = readings(
        spark,
        [(1, JAN, "1", True), (1, JAN, "2", False), (1, JAN, "3", None), (1, FEB, "9", True), (7, JAN, "5", True)],
    )
    rows = E.monthly_consumption(reads, S.facilities(facilities(spark, [(1, True)])))
    rows = rows.orderBy("consumption_month").collect()
    assert [r.facility_id for r in rows] == [1, 1]  # the reading of facility 7 is gone
    assert (rows[0].reading_count, rows[0].total_kwh, rows[0].corrected_readings) == (3, D(6), 1)
    assert rows[0].correction_rate_pct == D("33.3")
    assert rows[1].correction_rate_pct == D("100.0")


def comply(spark, subsidy, invest_rows, ok=True):
    """Compliance of one facility whose total subsidy is ``subsidy``."""
    months = spark.createDataFrame(
        [(1, "f1", "sector", JAN, ok, D(subsidy))],
        "facility_id long, facility_name string, sector string, consumption_month timestamp, "
        "subsidy_eligible boolean, subsidy_entitlement_eur decimal(18,2)",
    )
    complied = C.investment_compliance(
        C.facility_subsidies(months), C.investment_pivot(investments(spark, invest_rows))
    )
    monthly = spark.createDataFrame(
        [(1, JAN, D(10))], "facility_id long, consumption_month timestamp, total_kwh decimal(18,3)"
    )
    return complied, C.compliance_summary(facilities(spark, [(1, ok)]), monthly, months, complied)


@pytest.mark.parametrize(
    "subsidy, invest_rows, pct, status, bonus",
    [
        ("0", [], None, "COMPLIANT", True),  # nothing owed
        ("200", [], "0.0", "AT_RISK", True),  # nothing invested
        ("200", [(1, "100", "storage", "confirmed")], "100.0", "COMPLIANT", False),
        ("200", [(1, "100", "storage", "pending")], "0.0", "ON_TRACK", True),
        ("200", [(1, "60", "storage", "confirmed"), (1, "40", "storage", "other")], "60.0", "ON_TRACK", False),
        ("200", [(1, "80", "flexibility", "confirmed"), (1, "20", "storage", "confirmed")], "100.0", "COMPLIANT", True),
        ("200", [(1, "33.35", "renewable", "confirmed")], "33.4", "AT_RISK", False),
    ],
)
def test_compliance(spark, subsidy, invest_rows, pct, status, bonus):
    row = comply(spark, subsidy, invest_rows)[0].first()
    assert row.compliance_pct == (None if pct is None else D(pct))
    assert (row.compliance_status, row.flexibility_bonus_eligible) == (status, bonus)


def test_other_statuses_count_only_towards_the_total(spark):
    row = comply(spark, "200", [(1, "30", "storage", "planned")])[0].first()
    assert row.total_investment_eur == 30
    assert (row.confirmed_investment_eur, row.pending_investment_eur, row.storage_eur) == (0, 0, 0)


def test_summary_fills_in_an_ineligible_facility(spark):
    row = comply(spark, "0", [], ok=False)[1].first()
    assert (row.compliance_status, row.flexibility_bonus_eligible) == ("N/A", False)
    assert (row.compliance_pct, row.total_kwh_ytd, row.months_with_readings) == (0, 10, 1)


def test_nothing_owed_is_compliant_and_still_flagged(spark):
    complied, summary = comply(spark, "0", [])
    assert summary.first().compliance_pct == 0
    report = C.compliance_report(summary)
    assert [r.compliance_status for r in C.at_risk(report).collect()] == ["COMPLIANT"]
    # Before the summary fills it in, an unknown percentage is no reason to flag.
    assert C.at_risk(complied).count() == 0


def test_deadlines(spark):
    months = spark.createDataFrame(
        [(1, JAN, True, D(100)), (1, FEB, True, D(100)), (2, JAN, False, D(0))],
        "facility_id long, consumption_month timestamp, subsidy_eligible boolean, "
        "subsidy_entitlement_eur decimal(18,2)",
    )
    paid = spark.createDataFrame(
        [
            (1, dt.date(2030, 2, 1), D(30), "confirmed"),
            (1, dt.date(2030, 2, 2), D(50), "confirmed"),
            (1, dt.date(2026, 2, 2), D(9), "pending"),
        ],
        "facility_id long, investment_date date, amount_eur decimal(14,2), status string",
    )
    rows = C.reinvestment_deadlines(months, paid).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.first_deadline, row.last_deadline) == (dt.date(2030, 1, 1), dt.date(2030, 2, 1))
    assert (row.obligation_eur, row.invested_in_time_eur) == (100, 30)
    assert row.principal_to_repay_eur == 70


# --- quality ---------------------------------------------------------------------


def test_each_kind_of_fault_is_found(spark):
    table = spark.createDataFrame(
        [(1, "a", 1), (1, None, 2), (2, "b", 9), (None, "c", 9), (None, "a", None)],
        "id long, kind string, parent long",
    )
    parents = spark.createDataFrame([(1,), (2,)], "id long")
    results = quality.check(
        table,
        "t",
        [
            quality.NotNull("id"),
            quality.AcceptedValues("kind", ("a", "b")),
            quality.Unique("id"),
            quality.ForeignKey("parent", parents, "id"),
        ],
    )
    got = {(r.rule, r.column_name): r.failures for r in results.collect()}
    assert got == {
        ("not_null", "id"): 2,
        ("accepted_values", "kind"): 1,
        ("unique", "id"): 1,
        ("foreign_key", "parent"): 2,
    }
    with pytest.raises(quality.QualityError, match="foreign_key"):
        quality.gate(results)


def test_gate_passes_clean_results_on(spark):
    table = spark.createDataFrame([(1,), (2,)], "id long")
    rules = [quality.NotNull("id"), quality.Unique("id"), quality.ForeignKey("id", table, "id")]
    assert [r.failures for r in quality.gate(quality.check(table, "t", rules)).collect()] == [0, 0, 0]
