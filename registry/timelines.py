"""Histories met with histories, and facts with what was known."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import inputs as I
from registry.changes import _LOGGED, decoded_changes
from registry.core import query
from strandline.operators import bitemporal, history, intervals

# --- overlapping intervals -------------------------------------------------------------

# A line item stands at its supplier for a fortnight, a confirmed investment is under way
# for a month, and an order of another status has no end yet.
_STAYS_SQL = """
    SELECT l_suppkey AS facility_id, l_orderkey, l_linenumber, l_shipdate AS valid_from,
           l_shipdate + INTERVAL 14 DAY AS valid_to FROM lineitem"""
_UNDER_WAY_SQL = f"""
    SELECT investment_id, facility_id, CAST(investment_date AS TIMESTAMP) AS valid_from,
           CASE WHEN status = 'confirmed' THEN CAST(investment_date AS TIMESTAMP) + INTERVAL 30 DAY
                WHEN status = 'pending' THEN CAST(investment_date AS TIMESTAMP) END AS valid_to
    FROM ({I.INVESTMENTS_SQL}) WHERE status <> 'other' OR investment_id % 50 = 3"""


def _stays(spark, sf):
    return I.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("facility_id"),
        "l_orderkey",
        "l_linenumber",
        F.col("l_shipdate").alias("valid_from"),
        F.expr("l_shipdate + INTERVAL '14' DAY").alias("valid_to"),
    )


def _under_way(spark, sf):
    begun = F.col("investment_date").cast("timestamp_ntz")
    status, id = F.col("status"), F.col("investment_id")
    end = F.when(status == "confirmed", begun + F.expr("INTERVAL '30' DAY")).when(status == "pending", begun)
    return I.investments(spark, sf).where((status != "other") | (id % 50 == 3)).select(
        "investment_id", "facility_id", begun.alias("valid_from"), end.alias("valid_to")
    )


@query(
    "interval_join",
    f"""WITH stays AS ({_STAYS_SQL}), under_way AS ({_UNDER_WAY_SQL})
    SELECT s.facility_id, l_orderkey, l_linenumber, investment_id,
           greatest(s.valid_from, u.valid_from) AS overlap_from, least(s.valid_to, u.valid_to) AS overlap_to
    FROM stays s JOIN under_way u ON s.facility_id = u.facility_id AND s.valid_from < s.valid_to
         AND (u.valid_to IS NULL OR u.valid_from < u.valid_to)
         AND s.valid_from < coalesce(u.valid_to, TIMESTAMP '9999-01-01') AND u.valid_from < s.valid_to""",
)
def interval_join(spark, sf):
    """Line items and investments of one facility that overlap in time."""
    found = intervals.interval_join(_stays(spark, sf), _under_way(spark, sf), "facility_id")
    return found.select("facility_id", "l_orderkey", "l_linenumber", "investment_id", "overlap_from", "overlap_to")


_USER_VERSIONS = """versions AS (
        SELECT user_id, event_id, event_type, ts AS valid_from,
               lead(ts) OVER (PARTITION BY user_id, event_type IN ('view', 'click') ORDER BY ts, event_id) AS valid_to
        FROM events),
    seen AS (SELECT * FROM versions WHERE event_type IN ('view', 'click')),
    done AS (SELECT * FROM versions WHERE event_type NOT IN ('view', 'click'))"""


@query(
    "interval_join_sliced",
    f"""WITH {_USER_VERSIONS}
    SELECT s.user_id, s.event_id AS seen_id, d.event_id AS done_id,
           greatest(s.valid_from, d.valid_from) AS overlap_from, least(s.valid_to, d.valid_to) AS overlap_to
    FROM seen s JOIN done d ON s.user_id = d.user_id
         AND (s.valid_to IS NULL OR s.valid_to > s.valid_from) AND (d.valid_to IS NULL OR d.valid_to > d.valid_from)
         AND (d.valid_to IS NULL OR s.valid_from < d.valid_to) AND (s.valid_to IS NULL OR d.valid_from < s.valid_to)""",
)
def interval_join_sliced(spark, sf):
    """Two histories of each user, where both versions were valid; crowded users cut up."""
    changes = I.user_changes(spark, sf)
    seen = F.col("event_type").isin("view", "click")

    def versions(rows, id):
        made = history.history(rows, "user_id", ("ts", "event_id"), operation=None)
        return made.select("user_id", F.col("event_id").alias(id), "valid_from", "valid_to")

    found = intervals.interval_join(
        versions(changes.where(seen), "seen_id"), versions(changes.where(~seen), "done_id"), "user_id", rows_per_slice=20
    )
    return found.select("user_id", "seen_id", "done_id", "overlap_from", "overlap_to")


# --- facts with what was known ---------------------------------------------------------

# Events are seen up to four days after they happen; every eleventh is a delete. A fact asks
# about a moment up to two days before its event, with what was known up to five days later.
_TWO_TIMES_SQL = """WITH changes AS (
        SELECT user_id, event_id AS version_id, ts, ts + INTERVAL 1 DAY * (event_id * 7 % 5) AS seen_at,
               CASE WHEN event_id % 11 = 0 THEN 'd' ELSE 'u' END AS operation
        FROM events),
    facts AS (
        SELECT user_id, event_id, ts - INTERVAL 1 DAY * (event_id % 3) AS about,
               ts + INTERVAL 1 DAY * (event_id * 3 % 6) AS known
        FROM events),
    answers AS (
        SELECT f.*, (SELECT max({'ts': c.ts, 'id': c.version_id, 'gone': c.operation = 'd'}) FROM changes c
                     WHERE c.user_id = f.user_id AND c.ts <= f.about AND c.seen_at <= f.known) AS best
        FROM facts f)
    SELECT user_id, event_id, about, known, CASE WHEN NOT best.gone THEN best.id END AS version_id FROM answers"""


def _two_times(spark, sf, **options):
    events = I.table(spark, sf, "events")
    day, id = F.expr("INTERVAL '1' DAY"), F.col("event_id")
    changes = events.select(
        "user_id",
        id.alias("version_id"),
        "ts",
        (F.col("ts") + day * (id * 7 % 5)).alias("seen_at"),
        F.when(id % 11 == 0, F.lit("d")).otherwise(F.lit("u")).alias("operation"),
    )
    facts = events.select(
        "user_id", "event_id", (F.col("ts") - day * (id % 3)).alias("about"), (F.col("ts") + day * (id * 3 % 6)).alias("known")
    )
    return bitemporal.bitemporal_join(
        facts, changes, "user_id", "about", "known",
        version_columns=["version_id"], order_by=["ts", "version_id"], seen_at="seen_at", **options,
    )


@query("bitemporal_join", _TWO_TIMES_SQL)
def bitemporal_join(spark, sf):
    """For each event the version valid at one time as known at another."""
    return _two_times(spark, sf)


@query("bitemporal_join_sliced", _TWO_TIMES_SQL)
def bitemporal_join_sliced(spark, sf):
    """The same with crowded users cut into slices of about twenty rows."""
    return _two_times(spark, sf, rows_per_slice=20)


_ORDER = "ORDER BY cdc_timestamp DESC, bronze_partition DESC, bronze_offset DESC, facility_id DESC"


@query(
    "audit_readings",
    f"""WITH {_LOGGED}, asked AS (
        SELECT DISTINCT reading_id, DATE '1995-01-01' + INTERVAL 200 DAY * n AS known
        FROM meter, range(12) r(n)),
    able AS (
        SELECT a.reading_id, known, m.facility_id, reported_kwh, operation,
               row_number() OVER (PARTITION BY a.reading_id, known {_ORDER}) AS place
        FROM asked a JOIN meter m ON a.reading_id = m.reading_id AND cdc_timestamp <= known AND ingested_at <= known)
    SELECT known, count(*) AS readings, CAST(sum(CAST(reported_kwh AS DECIMAL(12,3))) AS DECIMAL(22,3)) AS total_kwh
    FROM able WHERE place = 1 AND operation <> 'd' GROUP BY known""",
)
def audit_readings(spark, sf):
    """What the data showed on each of twelve days: readings and their sum, in one sweep."""
    # Asked about, sketched and swept.
    changes = decoded_changes(spark, sf, ("facility_id", "reported_kwh"))
    first = F.lit("1995-01-01").cast("date")
    days = F.transform(F.sequence(F.lit(0), F.lit(11)), lambda n: F.date_add(first, n * 200).cast("timestamp"))
    asked = changes.select("reading_id").distinct().select("reading_id", F.explode(days).alias("known"))
    found = bitemporal.bitemporal_join(
        asked.withColumn("about", F.col("known")), changes, "reading_id", "about", "known",
        version_columns=["reported_kwh"], order_by=I.METER_ORDER, how="inner",
    )
    return found.groupBy("known").agg(
        F.count("*").alias("readings"), F.sum("reported_kwh").cast("decimal(22,3)").alias("total_kwh")
    )
