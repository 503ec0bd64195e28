"""Decoding of change events and versioned history."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import inputs as I
from registry.core import ORACLES, query
from registry.marts import SUMMARY_SQL, _rounded
from strandline.functions import decode
from strandline.operators import asof, envelope, history, kept, skew
from strandline.plans import compliance as C
from strandline.plans import entitlement as E
from strandline.plans import incremental as N
from strandline.plans import staging as S
from strandline.session import shared_dir

_LOGGED = f"meter AS ({I.METER_EVENTS_SQL})"
_WRITES = "operation IN ('r', 'c', 'u')"

# Base64 of the shortest two's-complement form, the way the wire has it.


def _encoded(unscaled: str) -> str:
    chain = "16"
    for size in range(7, 0, -1):
        bound = 1 << (8 * size - 1)
        chain = f"CASE WHEN {unscaled} BETWEEN {-bound} AND {bound - 1} THEN {2 * size} ELSE {chain} END"
    # Negative numbers are written as their distance from 2^64.
    positive = f"CASE WHEN {unscaled} < 0 THEN {unscaled} + 18446744073709551616 ELSE {unscaled} END"
    digits = f"lpad(to_hex(CAST({positive} AS UBIGINT)), 16, '0')"
    return f"to_base64(unhex(right({digits}, {chain})))"


_KWH_UNSCALED = "CAST(reported_kwh * 1000 AS HUGEINT)"
_EUR_UNSCALED = "CAST(amount_eur * 100 AS HUGEINT)"
_MWH_UNSCALED = "CAST(annual_consumption_mwh * 1000 AS HUGEINT)"
_ZONED = "strftime(reading_timestamp, '%Y-%m-%dT%H:%M:%S.%fZ')"


def meter_changes(spark, sf, operations=envelope.WRITES, columns=None):
    return envelope.read_changes(I.meter_log(spark, sf), envelope.METER_READINGS, operations, columns)


def decoded_changes(spark, sf, columns=None):
    """All changes of readings, decoded once for queries that read them several times."""
    operations, path = (*envelope.WRITES, envelope.DELETE), shared_dir(spark, "decoded")
    changes = meter_changes(spark, sf, operations, columns)
    changes.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(changes.schema).parquet(path)


def investment_changes(spark, sf):
    return envelope.read_changes(I.investment_log(spark, sf), envelope.INVESTMENTS)


# --- decoding -------------------------------------------------------------------


@query(
    "cdc_extract_meter",
    f"""WITH {_LOGGED}
    SELECT operation, cdc_timestamp_ms, reading_id,
           CASE WHEN operation <> 'd' THEN facility_id END AS facility_id,
           CASE WHEN operation <> 'd' THEN {_ZONED} END AS reading_timestamp,
           CASE WHEN operation <> 'd' THEN {_encoded(_KWH_UNSCALED)} END AS reported_kwh,
           CASE WHEN operation <> 'd' THEN corrected END AS corrected,
           CASE WHEN operation <> 'd' THEN correction_reason END AS correction_reason,
           bronze_offset
    FROM meter
    UNION ALL
    SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, bronze_offset + 1
    FROM meter WHERE operation = 'd'""",
)
def cdc_extract_meter(spark, sf):
    extracted = envelope.extract_changes(I.meter_log(spark, sf), envelope.METER_READINGS)
    return extracted.drop("bronze_partition", "ingested_at")


@query(
    "cdc_extract_invest",
    f"""SELECT operation, epoch_ms(cdc_timestamp) AS cdc_timestamp_ms, investment_id, facility_id,
           CAST(date_diff('day', DATE '1970-01-01', investment_date) AS VARCHAR) AS investment_date,
           {_encoded(_EUR_UNSCALED)} AS amount_eur, category, status, bronze_offset
    FROM ({I.INVESTMENT_EVENTS_SQL})""",
)
def cdc_extract_invest(spark, sf):
    extracted = envelope.extract_changes(I.investment_log(spark, sf), envelope.INVESTMENTS)
    return extracted.drop("bronze_partition", "ingested_at")


@query(
    "cdc_extract_facility",
    f"""SELECT facility_id, name, sector, region,
           CAST(annual_consumption_mwh AS DECIMAL(12,3)) AS annual_consumption_mwh, subsidy_eligible
    FROM ({I.FACILITY_EVENTS_SQL})
    QUALIFY row_number() OVER (PARTITION BY facility_id ORDER BY bronze_offset DESC) = 1""",
)
def cdc_extract_facility(spark, sf):
    changes = envelope.read_changes(I.facility_log(spark, sf), envelope.FACILITIES)
    return envelope.latest_per_key(changes, "facility_id").select(*envelope.FACILITIES.columns)


@query(
    "cdc_facility_wire_text",
    f"""SELECT facility_id, operation, {_encoded(_MWH_UNSCALED)} AS annual_consumption_mwh,
           subsidy_eligible, bronze_offset
    FROM ({I.FACILITY_EVENTS_SQL})""",
)
def cdc_facility_wire_text(spark, sf):
    extracted = envelope.extract_changes(I.facility_log(spark, sf), envelope.FACILITIES)
    return extracted.select(
        "facility_id", "operation", "annual_consumption_mwh", "subsidy_eligible", "bronze_offset"
    )


@query(
    "cdc_op_filter",
    f"""WITH {_LOGGED} SELECT reading_id, operation, bronze_offset FROM meter WHERE {_WRITES}""",
)
def cdc_op_filter(spark, sf):
    extracted = envelope.extract_changes(I.meter_log(spark, sf), envelope.METER_READINGS)
    return envelope.keep_operations(extracted).select("reading_id", "operation", "bronze_offset")


@query(
    "cdc_decode_decimal",
    f"""WITH {_LOGGED} SELECT reading_id, bronze_offset,
        CAST(reported_kwh AS DECIMAL(12,3)) AS reported_kwh FROM meter WHERE {_WRITES}""",
)
def cdc_decode_decimal(spark, sf):
    return meter_changes(spark, sf).select("reading_id", "bronze_offset", "reported_kwh")


@query(
    "cdc_decode_epoch_days",
    f"""SELECT investment_id, bronze_offset, investment_date, amount_eur
    FROM ({I.INVESTMENT_EVENTS_SQL})""",
)
def cdc_decode_epoch_days(spark, sf):
    return investment_changes(spark, sf).select(
        "investment_id", "bronze_offset", "investment_date", "amount_eur"
    )


@query(
    "cdc_decode_zoned_ts",
    f"WITH {_LOGGED} SELECT reading_id, bronze_offset, reading_timestamp FROM meter WHERE {_WRITES}",
)
def cdc_decode_zoned_ts(spark, sf):
    return meter_changes(spark, sf).select("reading_id", "bronze_offset", "reading_timestamp")


@query(
    "cdc_decode_ts_ms",
    """SELECT event_id, epoch_us(ts) // 1000 AS ts_ms,
        make_timestamp(epoch_us(ts) // 1000 * 1000) AS cdc_timestamp FROM events""",
)
def cdc_decode_ts_ms(spark, sf):
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return (
        I.table(spark, sf, "events")
        .select("event_id", millis.alias("ts_ms"))
        .withColumn("cdc_timestamp", decode.decode_epoch_millis(F.col("ts_ms")))
    )


@query(
    "cdc_decode_changes",
    f"""WITH {_LOGGED} SELECT reading_id, facility_id, reading_timestamp,
        CAST(reported_kwh AS DECIMAL(12,3)) AS reported_kwh, corrected, correction_reason,
        operation, cdc_timestamp, bronze_offset FROM meter WHERE {_WRITES}""",
)
def cdc_decode_changes(spark, sf):
    return meter_changes(spark, sf).drop("bronze_partition", "ingested_at")


@query(
    "cdc_op_breakdown",
    f"WITH {_LOGGED} SELECT operation, count(*) AS events FROM meter WHERE {_WRITES} GROUP BY operation",
)
def cdc_op_breakdown(spark, sf):
    return envelope.operation_breakdown(meter_changes(spark, sf))


@query(
    "cdc_split_ops",
    f"""WITH {_LOGGED} SELECT count(*) FILTER (operation IN ('r', 'c')) AS inserts,
        count(*) FILTER (operation = 'u') AS updates FROM meter""",
)
def cdc_split_ops(spark, sf):
    return envelope.split_counts(meter_changes(spark, sf))


@query(
    "cdc_json_paths",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
        json_extract_string(props, '$.missing') AS missing FROM events""",
)
def cdc_json_paths(spark, sf):
    body = F.try_parse_json("props")
    return I.table(spark, sf, "events").select(
        "event_id",
        F.try_variant_get(body, "$.k", "bigint").alias("k"),
        F.try_variant_get(body, "$.missing", "string").alias("missing"),
    )


# --- history ---------------------------------------------------------------------

_LEAD = """lead(cdc_timestamp) OVER (PARTITION BY reading_id
    ORDER BY cdc_timestamp, bronze_partition, bronze_offset, facility_id)"""
# A delete ends the version before it and is none itself.
_VERSIONS = f"""{_LOGGED},
folded AS (SELECT *, cdc_timestamp AS valid_from, {_LEAD} AS valid_to FROM meter),
versions AS (SELECT *, valid_to IS NULL AS is_current FROM folded WHERE operation <> 'd')"""
_VERSION_COLUMNS = (
    "reading_id",
    "facility_id",
    "reported_kwh",
    "corrected",
    "operation",
    "bronze_offset",
    "valid_from",
    "valid_to",
    "is_current",
)
_VERSION_SELECT = ", ".join(_VERSION_COLUMNS).replace(
    "reported_kwh", "CAST(reported_kwh AS DECIMAL(12,3)) AS reported_kwh"
)


def meter_history(spark, sf, columns=None, **options):
    log = I.meter_log(spark, sf)
    changes = envelope.read_changes(
        log, envelope.METER_READINGS, (*envelope.WRITES, envelope.DELETE), columns
    )
    return history.history(changes, "reading_id", I.METER_ORDER, log=log, **options)


@query(
    "scd2_open",
    f"""WITH {_LOGGED} SELECT reading_id, facility_id, cdc_timestamp AS valid_from,
        CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current, true AS stamped
    FROM meter WHERE operation IN ('r', 'c')""",
)
def scd2_open(spark, sf):
    opened = history.open_versions(history.inserted(meter_changes(spark, sf)))
    return opened.select(
        "reading_id",
        "facility_id",
        "valid_from",
        "valid_to",
        "is_current",
        F.col("processed_at").isNotNull().alias("stamped"),
    )


@query(
    "scd2_close",
    f"""WITH {_VERSIONS} SELECT reading_id, bronze_offset, valid_from, valid_to FROM versions
    WHERE NOT is_current""",
)
def scd2_close(spark, sf):
    # The key, and what orders the changes: no other field is read.
    return history.closed_versions(meter_history(spark, sf, ["facility_id"])).select(
        "reading_id", "bronze_offset", "valid_from", "valid_to"
    )


@query(
    "scd2_append_version",
    f"WITH {_VERSIONS} SELECT {_VERSION_SELECT} FROM versions WHERE operation = 'u'",
)
def scd2_append_version(spark, sf):
    return history.appended_versions(meter_history(spark, sf)).select(*_VERSION_COLUMNS)


@query("scd2_history", f"WITH {_VERSIONS} SELECT {_VERSION_SELECT} FROM versions")
def scd2_history(spark, sf):
    return meter_history(spark, sf).select(*_VERSION_COLUMNS)


@query("scd2_history_sliced", f"WITH {_VERSIONS} SELECT {_VERSION_SELECT} FROM versions")
def scd2_history_sliced(spark, sf):
    """The same fold with every key of two changes or more cut into slices of one."""
    changes = decoded_changes(spark, sf)
    hot = skew.find_hot_keys(changes, ["reading_id"], I.METER_ORDER, rows_per_slice=1)
    return history.history(changes, "reading_id", I.METER_ORDER, hot=hot).select(*_VERSION_COLUMNS)


@query("scd2_incremental", f"WITH {_VERSIONS} SELECT {_VERSION_SELECT} FROM versions")
def scd2_incremental(spark, sf):
    """The log in three batches; the second holds events older than the first's."""
    root = shared_dir(spark, "kept-history")
    changes = decoded_changes(spark, sf)
    part = F.pmod(F.xxhash64("bronze_offset", "facility_id", "cdc_timestamp"), F.lit(3))
    for number in (2, 0, 1):
        kept.apply_batch(changes.where(part == number), root, "reading_id", I.METER_ORDER, buckets=16)
    return kept.kept_history(spark, root).select(*_VERSION_COLUMNS)


@query("scd2_incremental_by_range", f"WITH {_VERSIONS} SELECT {_VERSION_SELECT} FROM versions")
def scd2_incremental_by_range(spark, sf):
    """Buckets of running numbers that the caller chooses; some numbers have none."""
    root = shared_dir(spark, "kept-by-range")
    changes = decoded_changes(spark, sf)
    number = F.expr("CASE WHEN reading_id % 17 <> 0 THEN reading_id DIV 40000 END")
    month = F.month("cdc_timestamp") % 2
    for part in (1, 0):
        kept.apply_batch(changes.where(month == part), root, "reading_id", I.METER_ORDER, bucket=number)
    return kept.kept_history(spark, root).select(*_VERSION_COLUMNS)


@query(
    "scd2_history_without_deletes",
    f"""WITH {_LOGGED}, folded AS (
        SELECT *, cdc_timestamp AS valid_from, {_LEAD} AS valid_to FROM meter WHERE operation <> 'd'),
    versions AS (SELECT *, valid_to IS NULL AS is_current FROM folded)
    SELECT {_VERSION_SELECT} FROM versions""",
)
def scd2_history_without_deletes(spark, sf):
    return meter_history(spark, sf, deletes="ignore").select(*_VERSION_COLUMNS)


@query(
    "scd2_history_by_user",
    """SELECT user_id, event_id, event_type, ts AS valid_from,
        lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to,
        lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL AS is_current
    FROM events""",
)
def scd2_history_by_user(spark, sf):
    versions = history.history(
        I.user_changes(spark, sf), "user_id", ("ts", "event_id"), operation=None
    )
    return versions.select(
        "user_id", "event_id", "event_type", "valid_from", "valid_to", "is_current"
    )


@query(
    "scd2_only_changed",
    """WITH kept AS (
        SELECT * FROM (
            SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before
            FROM events)
        WHERE before IS DISTINCT FROM event_type)
    SELECT user_id, event_id, event_type, ts AS valid_from,
        lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to
    FROM kept""",
)
def scd2_only_changed(spark, sf):
    versions = history.history(
        I.user_changes(spark, sf),
        "user_id",
        ("ts", "event_id"),
        operation=None,
        changed_columns=["event_type"],
    )
    return versions.select("user_id", "event_id", "event_type", "valid_from", "valid_to")


@query(
    "scd2_redelivered",
    f"WITH {_VERSIONS} SELECT {_VERSION_SELECT} FROM versions",
)
def scd2_redelivered(spark, sf):
    """A log with repeated deliveries has the same history as one without."""
    log = I.meter_log(spark, sf, redelivered=True)
    changes = envelope.read_changes(
        log, envelope.METER_READINGS, (*envelope.WRITES, envelope.DELETE)
    )
    identity = [*envelope.METER_READINGS.columns, "operation", "cdc_timestamp"]
    once = history.drop_redelivered(changes, identity, I.METER_ORDER, key="reading_id", log=log)
    versions = history.history(once, "reading_id", I.METER_ORDER, log=log)
    return versions.select(*_VERSION_COLUMNS)


_CURRENT = f"""WITH {_VERSIONS} SELECT reading_id, facility_id, reading_timestamp,
    CAST(reported_kwh AS DECIMAL(12,3)) AS reported_kwh, corrected, correction_reason,
    valid_from, valid_to, is_current FROM versions WHERE is_current"""


@query("scd2_current", _CURRENT)
def scd2_current(spark, sf):
    changes = meter_changes(spark, sf, (*envelope.WRITES, envelope.DELETE))
    return S.current_readings(history.current_from_log(changes, "reading_id", I.METER_ORDER))


@query("stg_meter_readings", _CURRENT)
def stg_meter_readings(spark, sf):
    return S.current_readings(meter_history(spark, sf))


@query(
    "stg_investments",
    f"""SELECT investment_id, facility_id, investment_date, amount_eur, category, status,
        CAST(investment_date AS TIMESTAMP)
            + CASE WHEN status = 'confirmed' THEN INTERVAL 30 DAY ELSE INTERVAL 0 DAY END AS valid_from,
        CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current
    FROM ({I.INVESTMENTS_SQL})""",
)
def stg_investments(spark, sf):
    log = I.investment_log(spark, sf)
    versions = history.history(investment_changes(spark, sf), "investment_id", log=log)
    return S.current_investments(versions)


@query(
    "scd2_summary",
    f"""WITH {_VERSIONS} SELECT count(*) AS total_rows,
        count(*) FILTER (is_current) AS current_rows,
        count(*) FILTER (NOT is_current) AS historical_rows,
        CAST(round(count(*) FILTER (NOT is_current) * 100.0 / count(*) FILTER (is_current), 1)
             AS DECIMAL(18,1)) AS correction_rate_pct
    FROM versions""",
)
def scd2_summary(spark, sf):
    return history.summary(meter_history(spark, sf))


@query(
    "scd2_history_sample",
    f"""WITH {_VERSIONS}, changed AS (
        SELECT DISTINCT reading_id FROM versions WHERE NOT is_current ORDER BY reading_id LIMIT 2)
    SELECT {_VERSION_SELECT} FROM versions WHERE reading_id IN (SELECT reading_id FROM changed)""",
)
def scd2_history_sample(spark, sf):
    changes = meter_changes(spark, sf, (*envelope.WRITES, envelope.DELETE))
    return history.history_sample_from_log(changes, "reading_id", I.METER_ORDER).select(*_VERSION_COLUMNS)


@query(
    "scd2_as_of",
    f"""WITH {_VERSIONS} SELECT {_VERSION_SELECT} FROM versions
    WHERE valid_from <= TIMESTAMP '1999-07-01 00:00:00'
      AND (valid_to IS NULL OR valid_to > TIMESTAMP '1999-07-01 00:00:00')""",
)
def scd2_as_of(spark, sf):
    moment = F.expr("TIMESTAMP '1999-07-01 00:00:00'")
    return history.as_of(meter_history(spark, sf), moment).select(*_VERSION_COLUMNS)


@query(
    "scd2_as_known_at",
    f"""WITH meter AS (SELECT * FROM ({I.METER_EVENTS_SQL})
                       WHERE ingested_at <= TIMESTAMP '1999-07-01 00:00:00'),
    folded AS (SELECT *, cdc_timestamp AS valid_from, {_LEAD} AS valid_to FROM meter),
    versions AS (SELECT *, valid_to IS NULL AS is_current FROM folded WHERE operation <> 'd')
    SELECT {_VERSION_SELECT} FROM versions""",
)
def scd2_as_known_at(spark, sf):
    log = I.meter_log(spark, sf)
    changes = meter_changes(spark, sf, (*envelope.WRITES, envelope.DELETE))
    moment = F.expr("TIMESTAMP '1999-07-01 00:00:00'")
    versions = history.as_known_at(changes, moment, "reading_id", I.METER_ORDER, log=log)
    return versions.select(*_VERSION_COLUMNS)


@query(
    "asof_join",
    """WITH prices AS (
        SELECT o_custkey AS customer, o_orderkey, o_orderdate AS valid_from,
               lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS valid_to
        FROM orders),
    facts AS (
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
               l_partkey % (SELECT count(*) FROM customer) AS customer
        FROM lineitem)
    SELECT f.*, p.o_orderkey AS version_order, p.valid_from AS version_from
    FROM facts f LEFT JOIN prices p ON f.customer = p.customer AND p.valid_from <= f.l_shipdate
         AND (p.valid_to IS NULL OR p.valid_to > f.l_shipdate)""",
)
def asof_join(spark, sf):
    """Each line item with the order its customer had last placed by the ship date."""
    customers = I.table(spark, sf, "customer").agg(F.count("*")).scalar()
    orders = I.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer"),
        F.col("o_orderkey").alias("version_order"),
        F.col("o_orderdate").alias("placed"),
    )
    versions = history.history(
        orders, "customer", ("placed", "version_order"), operation=None
    ).withColumn("version_from", F.col("valid_from"))
    facts = I.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_shipdate",
        (F.col("l_partkey") % customers).alias("customer"),
    )
    return asof.asof_join(
        facts,
        versions,
        "customer",
        "l_shipdate",
        version_columns=["version_order", "version_from"],
        version_order=["version_order"],
    )


_MARKED = """WITH marks AS (
        SELECT user_id, event_id, ts AS valid_from,
               lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to
        FROM events)
    SELECT e.user_id, e.event_id, m.event_id AS mark_id
    FROM events e LEFT JOIN marks m ON e.user_id = m.user_id AND m.valid_from <= e.ts
         AND (m.valid_to IS NULL OR m.valid_to > e.ts)"""


@query("asof_join_sliced", _MARKED)
def asof_join_sliced(spark, sf):
    """Events and versions of one user in slices of about twenty rows."""
    events = I.table(spark, sf, "events").select("user_id", "event_id", "ts")
    marks = I.user_changes(spark, sf).select("user_id", F.col("event_id").alias("mark_id"), "ts")
    versions = history.history(marks, "user_id", ("ts", "mark_id"), operation=None).drop("ts")
    return asof.asof_join(
        events,
        versions,
        "user_id",
        "ts",
        version_columns=["mark_id"],
        version_order=["mark_id"],
        rows_per_slice=20,
    ).select("user_id", "event_id", "mark_id")


# Each event is a version from its time on, and before it one of no length; some
# versions end, others stay open.
@query(
    "asof_join_default_order",
    _MARKED,
)
def asof_join_default_order(spark, sf):
    events = I.table(spark, sf, "events").select("user_id", "event_id", "ts")
    marks = I.user_changes(spark, sf).select("user_id", F.col("event_id").alias("mark_id"), "ts")
    versions = history.history(marks, "user_id", ("ts", "mark_id"), operation=None).drop("ts")
    empty = versions.withColumns({"valid_to": F.col("valid_from"), "mark_id": -F.col("mark_id") - 1})
    return asof.asof_join(
        events, versions.unionByName(empty), "user_id", "ts", version_columns=["mark_id"]
    ).select("user_id", "event_id", "mark_id")


@query(
    "asof_join_inner",
    """WITH marks AS (
        SELECT user_id, event_id, ts AS valid_from,
               lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to
        FROM events WHERE event_type = 'signup')
    SELECT e.user_id, e.event_id, e.ts, m.event_id AS signup_id
    FROM events e JOIN marks m ON e.user_id = m.user_id AND m.valid_from <= e.ts
         AND (m.valid_to IS NULL OR m.valid_to > e.ts)""",
)
def asof_join_inner(spark, sf):
    events = I.table(spark, sf, "events").select("user_id", "event_id", "ts")
    signups = (
        I.table(spark, sf, "events")
        .where("event_type = 'signup'")
        .select("user_id", F.col("event_id").alias("signup_id"), F.col("ts").alias("at"))
    )
    versions = history.history(signups, "user_id", ("at", "signup_id"), operation=None)
    return asof.asof_join(
        events,
        versions,
        "user_id",
        "ts",
        version_columns=["signup_id"],
        version_order=["signup_id"],
        how="inner",
    )


# --- from the raw logs to the last mart ----------------------------------------------


def followed_marts(spark, sf):
    """The marts after two batches of the meter log, prices of half the months coming with the second."""
    root = shared_dir(spark, "followed-marts")
    changes = decoded_changes(spark, sf)
    prices = S.wholesale_prices(I.prices(spark, sf))
    part = F.pmod(F.xxhash64("bronze_offset", "facility_id", "cdc_timestamp"), F.lit(2))
    for number, known in ((1, F.month("price_month") % 2 == 0), (0, F.lit(True))):
        N.apply_changes(changes.where(part == number), root, prices.where(known), I.METER_ORDER, buckets=16, facility_buckets=8)
    return root, prices


_PLAIN_READINGS = f"readings AS ({I.READINGS_SQL})"
_LOGGED_READINGS = f"""{_VERSIONS},
readings AS (SELECT facility_id, reading_timestamp, CAST(reported_kwh AS DECIMAL(12,3)) AS reported_kwh,
                    corrected FROM versions WHERE is_current)"""
assert _PLAIN_READINGS in SUMMARY_SQL


@query("compliance_from_logs", SUMMARY_SQL.replace(_PLAIN_READINGS, _LOGGED_READINGS))
def compliance_from_logs(spark, sf):
    """The flagship again, with readings, facilities and investments decoded from their logs."""
    facilities = envelope.latest_per_key(
        envelope.read_changes(I.facility_log(spark, sf), envelope.FACILITIES), "facility_id"
    )
    facilities = S.facilities(facilities)
    invested = history.current_from_log(investment_changes(spark, sf), "investment_id")
    invested = S.current_investments(invested)
    changes = meter_changes(spark, sf, (*envelope.WRITES, envelope.DELETE))
    path = shared_dir(spark, "current-readings")  # several marts read it: decoded once
    S.current_readings(history.current_from_log(changes, "reading_id", I.METER_ORDER)).write.parquet(path)
    readings = spark.read.parquet(path)
    monthly = E.monthly_consumption(readings, facilities)
    prices = S.wholesale_prices(I.prices(spark, sf))
    entitled = E.subsidy_entitlement(monthly, facilities, prices)
    complied = C.investment_compliance(C.facility_subsidies(entitled), C.investment_pivot(invested))
    overall = C.compliance_summary(facilities, monthly, entitled, complied)
    return _rounded(overall, "avg_monthly_kwh")


@query("marts_from_changes", ORACLES["compliance_from_logs"])
def marts_from_changes(spark, sf):
    """The last mart, kept up to date by two batches of changes."""
    root, _ = followed_marts(spark, sf)
    made = N.compliance_summary(spark, root, I.facilities(spark, sf), I.investments(spark, sf))
    return _rounded(made, "avg_monthly_kwh")


@query(
    "running_totals_from_changes",
    ORACLES["compliance_from_logs"].replace(
        "SELECT * FROM summary",
        """SELECT facility_id, consumption_month, total_kwh, subsidy_entitlement_eur, cumulative_subsidy_eur
        FROM entitlement""",
    ),
)
def running_totals_from_changes(spark, sf):
    """Entitlement and its running total per facility and month, from the kept sums."""
    root, prices = followed_marts(spark, sf)
    entitled = N.subsidy_entitlement(spark, root, I.facilities(spark, sf), prices)
    return entitled.select("facility_id", "consumption_month", "total_kwh", "subsidy_entitlement_eur", "cumulative_subsidy_eur")
