"""Staging views, marts and quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import inputs as I
from registry.core import query
from strandline.functions import rules
from strandline.operators import answers, quality
from strandline.plans import build
from strandline.plans import compliance as C
from strandline.plans import entitlement as E
from strandline.plans import repayment as R
from strandline.plans import staging as S
from strandline.session import shared_dir

# --- the marts in Spark -------------------------------------------------------


def monthly(spark: SparkSession, sf: str) -> DataFrame:
    return E.monthly_consumption(I.readings(spark, sf), S.facilities(I.facilities(spark, sf)))


def monthly_prices(spark: SparkSession, sf: str) -> DataFrame:
    return S.wholesale_prices(I.prices(spark, sf))


def entitlement(spark: SparkSession, sf: str) -> DataFrame:
    return E.subsidy_entitlement(monthly(spark, sf), I.facilities(spark, sf), monthly_prices(spark, sf))


def compliance(spark: SparkSession, sf: str, entitled: DataFrame | None = None) -> DataFrame:
    entitled = entitlement(spark, sf) if entitled is None else entitled
    return C.investment_compliance(
        C.facility_subsidies(entitled), C.investment_pivot(I.investments(spark, sf))
    )


def summary(spark: SparkSession, sf: str) -> DataFrame:
    entitled = entitlement(spark, sf)
    return C.compliance_summary(
        I.facilities(spark, sf), monthly(spark, sf), entitled, compliance(spark, sf, entitled)
    )


# --- and in SQL -----------------------------------------------------------------

_MONTHLY = f"""
facilities AS ({I.FACILITIES_SQL}),
readings AS ({I.READINGS_SQL}),
monthly AS (
    SELECT r.facility_id, f.name AS facility_name, f.sector, f.region,
           CAST(date_trunc('month', r.reading_timestamp) AS TIMESTAMP) AS consumption_month,
           count(*) AS reading_count,
           CAST(sum(r.reported_kwh) AS DECIMAL(18,3)) AS total_kwh,
           CAST(round(avg(r.reported_kwh), 3) AS DECIMAL(18,3)) AS avg_kwh_per_reading,
           CAST(sum(CASE WHEN r.corrected THEN 1 ELSE 0 END) AS BIGINT) AS corrected_readings,
           CAST(round(sum(CASE WHEN r.corrected THEN 1 ELSE 0 END) * 100.0 / count(*), 1)
                AS DECIMAL(5,1)) AS correction_rate_pct
    FROM readings r JOIN facilities f ON r.facility_id = f.facility_id
    GROUP BY r.facility_id, f.name, f.sector, f.region, date_trunc('month', r.reading_timestamp)
)"""

_PRICES = f"""
prices AS ({I.PRICES_SQL}),
monthly_prices AS (
    SELECT CAST(date_trunc('month', price_timestamp) AS TIMESTAMP) AS price_month,
           CAST(round(avg(price_eur_per_mwh), 2) AS DECIMAL(11,2)) AS avg_price_eur_per_mwh,
           CAST(round(avg(price_eur_per_kwh), 6) AS DECIMAL(11,6)) AS avg_price_eur_per_kwh,
           CAST(min(price_eur_per_mwh) AS DECIMAL(11,2)) AS min_price_eur_per_mwh,
           CAST(max(price_eur_per_mwh) AS DECIMAL(11,2)) AS max_price_eur_per_mwh,
           count(*) AS price_observations
    FROM prices GROUP BY 1
)"""

_ENTITLEMENT = f"""{_MONTHLY},{_PRICES},
priced AS (
    SELECT m.*, f.subsidy_eligible, p.avg_price_eur_per_kwh, p.avg_price_eur_per_mwh,
           p.min_price_eur_per_mwh, p.max_price_eur_per_mwh,
           greatest(p.avg_price_eur_per_kwh - 0.05, 0) AS gap
    FROM monthly m JOIN facilities f ON m.facility_id = f.facility_id
    LEFT JOIN monthly_prices p ON m.consumption_month = p.price_month
),
entitlement AS (
    SELECT facility_id, facility_name, sector, consumption_month, total_kwh, subsidy_eligible,
           avg_price_eur_per_kwh AS market_price_eur_per_kwh,
           avg_price_eur_per_mwh AS market_price_eur_per_mwh,
           min_price_eur_per_mwh, max_price_eur_per_mwh,
           CAST(0.05 AS DECIMAL(2,2)) AS target_price_eur_per_kwh,
           CAST(round(gap, 6) AS DECIMAL(12,6)) AS price_gap_eur_per_kwh,
           CAST(CASE WHEN subsidy_eligible THEN total_kwh * 0.5 ELSE 0 END AS DECIMAL(19,4))
               AS eligible_kwh,
           CAST(CASE WHEN subsidy_eligible THEN round(total_kwh * 0.5 * gap, 2) ELSE 0 END
                AS DECIMAL(18,2)) AS subsidy_entitlement_eur,
           CAST(CASE WHEN subsidy_eligible THEN round(sum(total_kwh * 0.5 * gap) OVER (
                    PARTITION BY facility_id ORDER BY consumption_month
                    ROWS UNBOUNDED PRECEDING), 2) ELSE 0 END
                AS DECIMAL(18,2)) AS cumulative_subsidy_eur
    FROM priced
)"""

_SUBSIDIES = f"""{_ENTITLEMENT},
subsidies AS (
    SELECT facility_id, facility_name, sector,
           CAST(sum(subsidy_entitlement_eur) AS DECIMAL(18,2)) AS total_subsidy_eur,
           CAST(round(sum(subsidy_entitlement_eur) * 0.5, 2) AS DECIMAL(18,2))
               AS reinvestment_obligation_eur
    FROM entitlement WHERE subsidy_eligible
    GROUP BY facility_id, facility_name, sector
)"""


def _sum_where(condition: str, name: str) -> str:
    return (
        f"CAST(sum(CASE WHEN {condition} THEN amount_eur ELSE 0 END) AS DECIMAL(18,2)) AS {name}"
    )


_PIVOT = f"""
investments AS ({I.INVESTMENTS_SQL}),
pivot_inv AS (
    SELECT facility_id, count(*) AS total_investments,
           {_sum_where("status = 'confirmed'", "confirmed_investment_eur")},
           {_sum_where("status = 'pending'", "pending_investment_eur")},
           CAST(sum(amount_eur) AS DECIMAL(18,2)) AS total_investment_eur,
           {_sum_where("status = 'confirmed' AND category = 'renewable'", "renewable_eur")},
           {_sum_where("status = 'confirmed' AND category = 'storage'", "storage_eur")},
           {_sum_where("status = 'confirmed' AND category = 'efficiency'", "efficiency_eur")},
           {_sum_where("status = 'confirmed' AND category = 'flexibility'", "flexibility_eur")}
    FROM investments GROUP BY facility_id
)"""

_COMPLIANCE = f"""{_SUBSIDIES},{_PIVOT},
met AS (
    SELECT s.facility_id, s.facility_name, s.sector, s.total_subsidy_eur,
           s.reinvestment_obligation_eur,
           coalesce(i.confirmed_investment_eur, 0) AS confirmed_investment_eur,
           coalesce(i.pending_investment_eur, 0) AS pending_investment_eur,
           coalesce(i.total_investment_eur, 0) AS total_investment_eur,
           coalesce(i.renewable_eur, 0) AS renewable_eur,
           coalesce(i.storage_eur, 0) AS storage_eur,
           coalesce(i.efficiency_eur, 0) AS efficiency_eur,
           coalesce(i.flexibility_eur, 0) AS flexibility_eur
    FROM subsidies s LEFT JOIN pivot_inv i ON s.facility_id = i.facility_id
),
compliance AS (
    SELECT *,
           CAST(round(CAST(confirmed_investment_eur AS DOUBLE)
                      / nullif(CAST(reinvestment_obligation_eur AS DOUBLE), 0) * 100, 1)
                AS DECIMAL(18,1)) AS compliance_pct,
           CASE WHEN confirmed_investment_eur >= reinvestment_obligation_eur THEN 'COMPLIANT'
                WHEN total_investment_eur >= reinvestment_obligation_eur THEN 'ON_TRACK'
                ELSE 'AT_RISK' END AS compliance_status,
           flexibility_eur >= confirmed_investment_eur * 0.8 AS flexibility_bonus_eligible
    FROM met
)"""

_SUMMARY = f"""{_COMPLIANCE},
summary AS (
    SELECT f.facility_id, f.name AS facility_name, f.sector, f.region, f.subsidy_eligible,
           coalesce(m.total_kwh, 0) AS total_kwh_ytd,
           coalesce(m.months_active, 0) AS months_with_readings,
           coalesce(m.avg_monthly_kwh, 0) AS avg_monthly_kwh,
           coalesce(e.total_subsidy_eur, 0) AS total_subsidy_eur,
           coalesce(c.confirmed_investment_eur, 0) AS confirmed_investment_eur,
           coalesce(c.reinvestment_obligation_eur, 0) AS reinvestment_obligation_eur,
           coalesce(c.compliance_pct, 0) AS compliance_pct,
           coalesce(c.compliance_status, 'N/A') AS compliance_status,
           coalesce(c.flexibility_bonus_eligible, false) AS flexibility_bonus_eligible
    FROM facilities f
    LEFT JOIN (SELECT facility_id, CAST(sum(total_kwh) AS DECIMAL(18,3)) AS total_kwh,
                      count(DISTINCT consumption_month) AS months_active,
                      CAST(round(avg(total_kwh), 3) AS DECIMAL(18,3)) AS avg_monthly_kwh
               FROM monthly GROUP BY facility_id) m ON f.facility_id = m.facility_id
    LEFT JOIN (SELECT facility_id,
                      CAST(sum(subsidy_entitlement_eur) AS DECIMAL(18,2)) AS total_subsidy_eur
               FROM entitlement GROUP BY facility_id) e ON f.facility_id = e.facility_id
    LEFT JOIN compliance c ON f.facility_id = c.facility_id
)"""

SUMMARY_SQL = f"WITH {_SUMMARY} SELECT * FROM summary"


def _rounded(df: DataFrame, column: str) -> DataFrame:
    """Averages at the three decimals both engines can state exactly."""
    return df.withColumn(column, F.round(column, 3).cast("decimal(18,3)"))


# --- queries ----------------------------------------------------------------------


@query("stg_facilities", I.FACILITIES_SQL)
def stg_facilities(spark, sf):
    return S.facilities(I.facilities(spark, sf))


@query("stg_wholesale_prices", f"WITH {_PRICES} SELECT * FROM monthly_prices")
def stg_wholesale_prices(spark, sf):
    return monthly_prices(spark, sf)


@query("monthly_consumption", f"WITH {_MONTHLY} SELECT * FROM monthly")
def monthly_consumption(spark, sf):
    return _rounded(monthly(spark, sf), "avg_kwh_per_reading")


@query(
    "monthly_correction_rate",
    f"""WITH {_MONTHLY} SELECT consumption_month, CAST(sum(corrected_readings) AS BIGINT) AS corrected_readings,
        CAST(sum(reading_count) AS BIGINT) AS reading_count,
        CAST(round(sum(corrected_readings) * 100.0 / sum(reading_count), 1) AS DECIMAL(5,1))
            AS correction_rate_pct
    FROM monthly GROUP BY consumption_month""",
)
def monthly_correction_rate(spark, sf):
    corrected, total = F.sum("corrected_readings"), F.sum("reading_count")
    return (
        monthly(spark, sf)
        .groupBy("consumption_month")
        .agg(
            corrected.alias("corrected_readings"),
            total.alias("reading_count"),
            rules.correction_rate_pct(corrected, total).alias("correction_rate_pct"),
        )
    )


@query("subsidy_entitlement", f"WITH {_ENTITLEMENT} SELECT * FROM entitlement")
def subsidy_entitlement(spark, sf):
    return entitlement(spark, sf)


@query(
    "price_gap",
    f"""WITH {_PRICES} SELECT price_month, avg_price_eur_per_kwh,
        CAST(greatest(avg_price_eur_per_kwh - 0.05, 0) AS DECIMAL(12,6)) AS price_gap_eur_per_kwh
    FROM monthly_prices""",
)
def price_gap(spark, sf):
    price = F.col("avg_price_eur_per_kwh")
    return monthly_prices(spark, sf).select(
        "price_month",
        price,
        rules.price_gap(price).cast("decimal(12,6)").alias("price_gap_eur_per_kwh"),
    )


@query(
    "eligible_kwh",
    f"""WITH {_ENTITLEMENT} SELECT facility_id, consumption_month, subsidy_eligible, eligible_kwh
    FROM entitlement""",
)
def eligible_kwh(spark, sf):
    return entitlement(spark, sf).select(
        "facility_id", "consumption_month", "subsidy_eligible", "eligible_kwh"
    )


@query(
    "subsidy_eur",
    f"""WITH {_ENTITLEMENT} SELECT facility_id, consumption_month, market_price_eur_per_kwh,
        subsidy_entitlement_eur FROM entitlement""",
)
def subsidy_eur(spark, sf):
    return entitlement(spark, sf).select(
        "facility_id", "consumption_month", "market_price_eur_per_kwh", "subsidy_entitlement_eur"
    )


@query(
    "subsidy_running_total",
    f"""WITH {_ENTITLEMENT} SELECT facility_id, consumption_month, subsidy_entitlement_eur,
        cumulative_subsidy_eur FROM entitlement""",
)
def subsidy_running_total(spark, sf):
    return entitlement(spark, sf).select(
        "facility_id", "consumption_month", "subsidy_entitlement_eur", "cumulative_subsidy_eur"
    )


@query(
    "months_without_price",
    f"""WITH {_ENTITLEMENT} SELECT consumption_month, count(*) AS facilities FROM entitlement
    WHERE market_price_eur_per_kwh IS NULL GROUP BY consumption_month""",
)
def months_without_price(spark, sf):
    return E.months_without_price(entitlement(spark, sf))


@query("facility_subsidy_rollup", f"WITH {_SUBSIDIES} SELECT * FROM subsidies")
def facility_subsidy_rollup(spark, sf):
    return C.facility_subsidies(entitlement(spark, sf))


@query("investment_pivot", f"WITH {_PIVOT} SELECT * FROM pivot_inv")
def investment_pivot(spark, sf):
    return C.investment_pivot(I.investments(spark, sf))


@query("investment_compliance", f"WITH {_COMPLIANCE} SELECT * FROM compliance")
def investment_compliance(spark, sf):
    return compliance(spark, sf)


@query(
    "compliance_pct",
    f"""WITH {_COMPLIANCE} SELECT facility_id, confirmed_investment_eur,
        reinvestment_obligation_eur, compliance_pct FROM compliance""",
)
def compliance_pct(spark, sf):
    return compliance(spark, sf).select(
        "facility_id", "confirmed_investment_eur", "reinvestment_obligation_eur", "compliance_pct"
    )


@query(
    "compliance_status",
    f"""WITH {_COMPLIANCE} SELECT compliance_status, count(*) AS facilities,
        CAST(sum(total_investment_eur) AS DECIMAL(18,2)) AS total_investment_eur
    FROM compliance GROUP BY compliance_status""",
)
def compliance_status(spark, sf):
    return (
        compliance(spark, sf)
        .groupBy("compliance_status")
        .agg(
            F.count("*").alias("facilities"),
            F.sum("total_investment_eur").cast(rules.EUR).alias("total_investment_eur"),
        )
    )


@query(
    "flexibility_bonus",
    f"""WITH {_COMPLIANCE} SELECT facility_id, flexibility_eur, confirmed_investment_eur,
        flexibility_bonus_eligible FROM compliance""",
)
def flexibility_bonus(spark, sf):
    return compliance(spark, sf).select(
        "facility_id", "flexibility_eur", "confirmed_investment_eur", "flexibility_bonus_eligible"
    )


@query("compliance_summary", SUMMARY_SQL)
def compliance_summary(spark, sf):
    return _rounded(summary(spark, sf), "avg_monthly_kwh")


_REPORT_COLUMNS = """facility_name, compliance_status, total_subsidy_eur, compliance_pct,
    flexibility_bonus_eligible"""


@query(
    "compliance_report",
    f"WITH {_SUMMARY} SELECT {_REPORT_COLUMNS} FROM summary ORDER BY compliance_pct, facility_name",
)
def compliance_report(spark, sf):
    return C.compliance_report(summary(spark, sf))


@query(
    "at_risk_flag",
    f"""WITH {_SUMMARY} SELECT {_REPORT_COLUMNS} FROM summary
    WHERE compliance_status = 'AT_RISK' OR compliance_pct < 50""",
)
def at_risk_flag(spark, sf):
    return C.at_risk(C.compliance_report(summary(spark, sf)))


@query(
    "compliance_live_context",
    f"""WITH {_SUMMARY} SELECT facility_name, sector, compliance_status, total_subsidy_eur,
        confirmed_investment_eur, reinvestment_obligation_eur, compliance_pct,
        flexibility_bonus_eligible FROM summary ORDER BY compliance_pct, facility_name""",
)
def compliance_live_context(spark, sf):
    return C.live_context(summary(spark, sf))


def _thousands(column: str) -> str:
    whole = f"CAST(floor({column}) AS BIGINT)"
    cents = f"CAST(CAST(({column} - floor({column})) * 100 AS INTEGER) AS VARCHAR)"
    return f"format('{{:,}}', {whole}) || '.' || lpad({cents}, 2, '0')"


_LINES = f"""{_SUMMARY}, lines AS (SELECT facility_name, compliance_pct,
        '  - ' || facility_name || ' (' || sector || '): status=' || compliance_status
        || ', subsidy=EUR ' || {_thousands("total_subsidy_eur")}
        || ', invested=EUR ' || {_thousands("confirmed_investment_eur")}
        || ', obligation=EUR ' || {_thousands("reinvestment_obligation_eur")}
        || ', compliance=' || CAST(CAST(compliance_pct AS DECIMAL(18,1)) AS VARCHAR) || '%'
        || ', flexibility_bonus_eligible='
        || CASE WHEN flexibility_bonus_eligible THEN 'True' ELSE 'False' END AS line
    FROM summary)"""
LIVE_SQL = f"""{_LINES}, live AS (
    SELECT '{answers.LINES_HEADING}' || chr(10)
        || string_agg(line, chr(10) ORDER BY compliance_pct, facility_name, line) AS live_data
    FROM lines)"""


@query("row_to_text", f"WITH {_LINES} SELECT * FROM lines")
def row_to_text(spark, sf):
    return answers.row_to_text(C.live_context(summary(spark, sf)))


@query("live_section", f"WITH {LIVE_SQL} SELECT live_data FROM live")
def live_section(spark, sf):
    """The lines of all facilities as the text a prompt shows."""
    return answers.live_section(answers.row_to_text(C.live_context(summary(spark, sf))))


@query(
    "reinvestment_deadline",
    f"""WITH {_ENTITLEMENT}, investments AS ({I.INVESTMENTS_SQL}),
    owed AS (
        SELECT facility_id,
               CAST(round(sum(subsidy_entitlement_eur) * 0.5, 2) AS DECIMAL(18,2)) AS obligation_eur,
               CAST(min(consumption_month) + INTERVAL 48 MONTH AS DATE) AS first_deadline,
               CAST(max(consumption_month) + INTERVAL 48 MONTH AS DATE) AS last_deadline
        FROM entitlement WHERE subsidy_eligible GROUP BY facility_id
    ),
    paid AS (
        SELECT o.facility_id, o.obligation_eur, o.first_deadline, o.last_deadline,
               CAST(coalesce(sum(i.amount_eur), 0) AS DECIMAL(18,2)) AS invested_in_time_eur
        FROM owed o LEFT JOIN investments i ON o.facility_id = i.facility_id
             AND i.status = 'confirmed' AND i.investment_date <= o.last_deadline
        GROUP BY ALL
    )
    SELECT *, CAST(greatest(obligation_eur - invested_in_time_eur, 0) AS DECIMAL(18,2))
        AS principal_to_repay_eur FROM paid""",
)
def reinvestment_deadline(spark, sf):
    return C.reinvestment_deadlines(entitlement(spark, sf), I.investments(spark, sf))

# Month by month: an obligation takes what was paid by its deadline and is not taken yet.
_MATCHED = f"""WITH RECURSIVE {_ENTITLEMENT}, investments AS ({I.INVESTMENTS_SQL}),
    owed AS MATERIALIZED (
        SELECT facility_id, consumption_month, CAST(consumption_month + INTERVAL 48 MONTH AS DATE) AS deadline,
               CAST(subsidy_entitlement_eur * 0.5 AS DECIMAL(18,3)) AS obligation_eur,
               row_number() OVER (PARTITION BY facility_id ORDER BY consumption_month) AS k
        FROM entitlement WHERE subsidy_eligible
    ),
    paid AS MATERIALIZED (
        SELECT facility_id, investment_date AS paid_on, CAST(sum(amount_eur) AS DECIMAL(18,3)) AS paid_eur
        FROM investments WHERE status = 'confirmed' GROUP BY ALL HAVING sum(amount_eur) > 0
    ),
    by_then AS MATERIALIZED (
        SELECT o.facility_id, consumption_month, deadline, obligation_eur, k,
               CAST(coalesce(sum(paid_eur), 0) AS DECIMAL(18,3)) AS money
        FROM owed o LEFT JOIN paid p ON o.facility_id = p.facility_id AND paid_on <= deadline
        GROUP BY ALL
    ),
    steps AS (
        SELECT facility_id, CAST(0 AS BIGINT) AS k, CAST(0 AS DECIMAL(18,3)) AS met, CAST(0 AS DECIMAL(18,3)) AS upto
        FROM by_then WHERE k = 1
        UNION ALL
        SELECT b.facility_id, b.k, CAST(least(b.obligation_eur, b.money - s.upto) AS DECIMAL(18,3)),
               CAST(s.upto + least(b.obligation_eur, b.money - s.upto) AS DECIMAL(18,3))
        FROM steps s JOIN by_then b ON b.facility_id = s.facility_id AND b.k = s.k + 1
    ),
    repaid AS MATERIALIZED (
        SELECT facility_id, consumption_month, deadline, obligation_eur, met AS invested_in_time_eur,
               CAST(obligation_eur - met AS DECIMAL(18,3)) AS principal_to_repay_eur, upto - met AS met_before, upto
        FROM steps JOIN by_then USING (facility_id, k)
    )"""


@query("reinvestment_matching", f"{_MATCHED} SELECT * EXCLUDE (met_before, upto) FROM repaid")
def reinvestment_matching(spark, sf):
    """Principal to repay for each month, payments going to the earliest deadline first."""
    return R.repayment(entitlement(spark, sf), I.investments(spark, sf))


@query(
    "reinvestment_allocations",
    f"""{_MATCHED}, line AS (
        SELECT *, sum(paid_eur) OVER (PARTITION BY facility_id ORDER BY paid_on) AS pay_end FROM paid
    )
    SELECT r.facility_id, r.consumption_month, paid_on,
           CAST(least(r.upto, pay_end) - greatest(r.met_before, pay_end - paid_eur) AS DECIMAL(18,3)) AS amount
    FROM repaid r JOIN line l ON r.facility_id = l.facility_id
         AND r.met_before < pay_end AND pay_end - paid_eur < r.upto AND r.met_before < r.upto""",
)
def reinvestment_allocations(spark, sf):
    """Which day's investments met which month's obligation."""
    paid = R.confirmed_payments(I.investments(spark, sf))
    return R.allocations(R.match_deadlines(R.monthly_obligations(entitlement(spark, sf)), paid), paid)


@query(
    "reinvestment_overdue",
    f"""{_MATCHED} SELECT facility_id, CAST(sum(obligation_eur) AS DECIMAL(18,3)) AS obligation_eur,
        CAST(coalesce(sum(principal_to_repay_eur) FILTER (deadline < DATE '2001-07-01'), 0) AS DECIMAL(18,3))
            AS overdue_eur,
        CAST(coalesce(sum(principal_to_repay_eur) FILTER (deadline >= DATE '2001-07-01'), 0) AS DECIMAL(18,3))
            AS still_to_meet_eur,
        min(deadline) FILTER (deadline >= DATE '2001-07-01' AND principal_to_repay_eur > 0) AS next_deadline,
        count(*) FILTER (deadline < DATE '2001-07-01' AND principal_to_repay_eur > 0) AS months_overdue
    FROM repaid GROUP BY facility_id""",
)
def reinvestment_overdue(spark, sf):
    repaid = R.repayment(entitlement(spark, sf), I.investments(spark, sf))
    return R.repayment_by_facility(repaid, F.expr("DATE '2001-07-01'"))


# --- quality ------------------------------------------------------------------------


def built_marts(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return build.build_marts(
        shared_dir(spark, "marts"),
        I.readings(spark, sf),
        I.facilities(spark, sf),
        I.prices(spark, sf),
        I.investments(spark, sf),
    )


@query("build_marts", SUMMARY_SQL)
def build_marts(spark, sf):
    """The marts as tables, one from the other; the last of them."""
    return _rounded(built_marts(spark, sf)["compliance_summary"], "avg_monthly_kwh")


def _count(table: str, rule: str, column: str, condition: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{column}' AS column_name, "
        f"count(*) AS failures FROM {table} WHERE {condition}"
    )


_NOT_NULL_COLUMNS = (
    ("monthly", "facility_id"),
    ("monthly", "consumption_month"),
    ("monthly", "total_kwh"),
    ("entitlement", "facility_id"),
    ("entitlement", "subsidy_entitlement_eur"),
    ("entitlement", "market_price_eur_per_kwh"),
    ("compliance", "facility_id"),
    ("summary", "facility_id"),
)


@query(
    "dq_not_null",
    f"WITH {_SUMMARY} "
    + " UNION ALL ".join(
        _count(t, "not_null", c, f"{c} IS NULL") for t, c in _NOT_NULL_COLUMNS
    ),
)
def dq_not_null(spark, sf):
    marts = built_marts(spark, sf)
    tables = {
        "monthly": marts["monthly_consumption"],
        "entitlement": marts["subsidy_entitlement"],
        "compliance": marts["investment_compliance"],
        "summary": marts["compliance_summary"],
    }
    return quality.check_all(
        *[
            quality.check(df, name, [quality.NotNull(c) for t, c in _NOT_NULL_COLUMNS if t == name])
            for name, df in tables.items()
        ]
    )


def _repeats(table: str, column: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, 'unique' AS rule, '{column}' AS column_name, "
        f"count(*) AS failures FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} HAVING count(*) > 1)"
    )


@query(
    "dq_unique",
    f"WITH {_SUMMARY} "
    + " UNION ALL ".join(
        [
            _repeats("compliance", "facility_id"),
            _repeats("summary", "facility_id"),
            _repeats("orders", "o_orderkey"),
            _repeats("orders", "o_custkey"),
            _repeats("lineitem", "l_orderkey"),
        ]
    ),
)
def dq_unique(spark, sf):
    unique, marts = quality.Unique, built_marts(spark, sf)
    return quality.check_all(
        quality.check(marts["investment_compliance"], "compliance", [unique("facility_id")]),
        quality.check(marts["compliance_summary"], "summary", [unique("facility_id")]),
        quality.check(
            I.table(spark, sf, "orders"), "orders", [unique("o_orderkey"), unique("o_custkey")]
        ),
        quality.check(I.table(spark, sf, "lineitem"), "lineitem", [unique("l_orderkey")]),
    )


@query(
    "dq_accepted_values",
    f"WITH {_COMPLIANCE} "
    + " UNION ALL ".join(
        [
            _count(
                "compliance",
                "accepted_values",
                "compliance_status",
                "compliance_status NOT IN ('COMPLIANT', 'ON_TRACK', 'AT_RISK')",
            ),
            _count("orders", "accepted_values", "o_orderstatus", "o_orderstatus NOT IN ('F', 'O')"),
        ]
    ),
)
def dq_accepted_values(spark, sf):
    accepted = quality.AcceptedValues
    return quality.check_all(
        quality.check(
            compliance(spark, sf),
            "compliance",
            [accepted("compliance_status", rules.COMPLIANCE_STATUSES)],
        ),
        quality.check(
            I.table(spark, sf, "orders"), "orders", [accepted("o_orderstatus", ("F", "O"))]
        ),
    )


def _orphans(table: str, column: str, parent: str, key: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, 'foreign_key' AS rule, '{column}' AS column_name, "
        f"count(*) AS failures FROM {table} WHERE {column} IS NOT NULL "
        f"AND {column} NOT IN (SELECT {key} FROM {parent})"
    )


@query(
    "dq_source_constraints",
    f"WITH investments AS ({I.INVESTMENTS_SQL}) "
    + " UNION ALL ".join(
        [
            _repeats("supplier", "s_suppkey"),
            _repeats("orders", "o_orderkey"),
            _count("supplier", "not_null", "s_name", "s_name IS NULL"),
            _count("lineitem", "not_null", "l_shipdate", "l_shipdate IS NULL"),
            _count("lineitem", "not_null", "l_quantity", "l_quantity IS NULL"),
            _orphans("lineitem", "l_suppkey", "supplier", "s_suppkey"),
            _orphans("lineitem", "l_orderkey", "orders", "o_orderkey"),
            _orphans("events", "user_id", "supplier", "s_suppkey"),
            _count(
                "investments",
                "accepted_values",
                "category",
                "category NOT IN ('renewable', 'storage', 'efficiency', 'flexibility')",
            ),
        ]
    ),
)
def dq_source_constraints(spark, sf):
    supplier, orders = I.table(spark, sf, "supplier"), I.table(spark, sf, "orders")
    lineitem, events = I.table(spark, sf, "lineitem"), I.table(spark, sf, "events")
    facility = {"parent": supplier, "parent_column": "s_suppkey"}
    return quality.check_all(
        quality.check(supplier, "supplier", [quality.NotNull("s_name"), quality.Unique("s_suppkey")]),
        quality.check(orders, "orders", [quality.Unique("o_orderkey")]),
        quality.check(
            lineitem,
            "lineitem",
            [
                quality.NotNull("l_shipdate"),
                quality.NotNull("l_quantity"),
                quality.ForeignKey("l_suppkey", **facility),
                quality.ForeignKey("l_orderkey", orders, "o_orderkey"),
            ],
        ),
        quality.check(events, "events", [quality.ForeignKey("user_id", **facility)]),
        quality.check(
            I.investments(spark, sf),
            "investments",
            [quality.AcceptedValues("category", rules.INVESTMENT_CATEGORIES)],
        ),
    )


def _named(sql: str, name: str, declared: str) -> str:
    return sql.replace(f"'{name}' AS table_name", f"'{declared}' AS table_name")


_DECLARED = (
    ("monthly", "monthly_consumption", ("facility_id", "consumption_month", "total_kwh")),
    ("entitlement", "subsidy_entitlement", ("facility_id", "subsidy_entitlement_eur")),
    ("compliance", "investment_compliance", ("facility_id",)),
    ("summary", "compliance_summary", ("facility_id",)),
)


@query(
    "dq_gate",
    f"WITH {_SUMMARY} "
    + " UNION ALL ".join(
        [
            _named(_count(t, "not_null", c, f"{c} IS NULL"), t, declared)
            for t, declared, columns in _DECLARED
            for c in columns
        ]
        + [
            _named(_repeats("compliance", "facility_id"), "compliance", "investment_compliance"),
            _named(_repeats("summary", "facility_id"), "summary", "compliance_summary"),
            _named(
                _count(
                    "compliance",
                    "accepted_values",
                    "compliance_status",
                    "compliance_status NOT IN ('COMPLIANT', 'ON_TRACK', 'AT_RISK')",
                ),
                "compliance",
                "investment_compliance",
            ),
        ]
    ),
)
def dq_gate(spark, sf):
    """Build, test, and go on only if every declared test passes."""
    return quality.gate(build.check_marts(built_marts(spark, sf)))
