"""The given tables in the roles of the inputs: facilities, readings, prices,
investments, and the change logs they would have come from.

Each function has a SQL twin, used by the oracle queries.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.session import shared_dir
from strandline.sources.tables import spread

_WRITTEN: dict[tuple[str, str, str], str] = {}


def written(spark: SparkSession, sf_dir: str, name: str, base: str, build) -> str:
    """Where the log ``name`` lies, written once per session from the given tables.

    A change log is an input: it is there before anything decodes it. Files
    are kept small so that a stream takes several batches to read them. Event texts are
    alike, and zstd halves what the default compression leaves of them.
    """
    place = (spark.sparkContext.applicationId, sf_dir, name)
    if place not in _WRITTEN:
        path = shared_dir(spark, name)
        files = 2 * spark.sparkContext.defaultParallelism
        per_file = max(1000, table(spark, sf_dir, base).count() // files)
        writer = build(spark, sf_dir).write.option("maxRecordsPerFile", per_file)
        writer.option("compression", "zstd").parquet(path)
        _WRITTEN[place] = path
    return _WRITTEN[place]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- plain inputs ---------------------------------------------------------

FACILITIES_SQL = """
    SELECT s_suppkey AS facility_id, s_name AS name, n_name AS sector, r_name AS region,
           s_nationkey % 5 <> 0 AS subsidy_eligible
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
"""


def facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published dimension table."""
    path = written(spark, sf_dir, "facilities", "supplier", build_facilities)
    return spark.read.parquet(path)


def build_facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("facility_id"),
            F.col("s_name").alias("name"),
            F.col("n_name").alias("sector"),
            F.col("r_name").alias("region"),
            (F.col("s_nationkey") % 5 != 0).alias("subsidy_eligible"),
        )
    )


READINGS_SQL = """
    SELECT l_suppkey AS facility_id, l_shipdate AS reading_timestamp,
           CAST(l_quantity * 1000 AS DECIMAL(12,3)) AS reported_kwh,
           l_returnflag = 'R' AS corrected
    FROM lineitem
"""


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("facility_id"),
        F.col("l_shipdate").cast("timestamp").alias("reading_timestamp"),
        (F.col("l_quantity") * 1000).cast("decimal(12,3)").alias("reported_kwh"),
        (F.col("l_returnflag") == "R").alias("corrected"),
    )


# The last months stay without a price: what is dated then counts for two years before.
PRICES_SQL = """
    SELECT CASE WHEN o_orderdate >= TIMESTAMP '2001-01-01 00:00:00'
                THEN o_orderdate - INTERVAL 24 MONTH ELSE o_orderdate END AS price_timestamp,
           CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 0.0005 AS DECIMAL(10,2)) AS price_eur_per_mwh,
           CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 0.0000005 AS DECIMAL(10,6)) AS price_eur_per_kwh
    FROM orders
"""


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = F.col("o_totalprice").cast("decimal(12,2)")
    at = F.expr(
        "CASE WHEN o_orderdate >= TIMESTAMP_NTZ '2001-01-01 00:00:00' "
        "THEN o_orderdate - INTERVAL '24' MONTH ELSE o_orderdate END"
    )
    return table(spark, sf_dir, "orders").select(
        at.cast("timestamp").alias("price_timestamp"),
        (total * F.expr("0.0005BD")).cast("decimal(10,2)").alias("price_eur_per_mwh"),
        (total * F.expr("0.0000005BD")).cast("decimal(10,6)").alias("price_eur_per_kwh"),
    )


_STATUS_SQL = (
    "CASE o_orderstatus WHEN 'F' THEN 'confirmed' WHEN 'P' THEN 'pending' ELSE 'other' END"
)
_CATEGORY_SQL = (
    "CASE o_orderkey % 4 WHEN 0 THEN 'renewable' WHEN 1 THEN 'storage' "
    "WHEN 2 THEN 'efficiency' ELSE 'flexibility' END"
)
INVESTMENTS_SQL = f"""
    SELECT o_orderkey AS investment_id,
           o_custkey % (SELECT count(*) FROM supplier) AS facility_id,
           CAST(o_orderdate AS DATE) AS investment_date,
           CAST(o_totalprice AS DECIMAL(14,2)) AS amount_eur,
           {_CATEGORY_SQL} AS category,
           {_STATUS_SQL} AS status
    FROM orders
"""


def _status() -> Column:
    return F.expr(_STATUS_SQL)


def _category() -> Column:
    return F.expr(_CATEGORY_SQL)


def investments(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A single number, so it goes into the plan as one.
    facility_count = table(spark, sf_dir, "supplier").agg(F.count("*")).scalar()
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("investment_id"),
        (F.col("o_custkey") % facility_count).alias("facility_id"),
        F.col("o_orderdate").cast("date").alias("investment_date"),
        F.col("o_totalprice").cast("decimal(14,2)").alias("amount_eur"),
        _category().alias("category"),
        _status().alias("status"),
    )


# --- change logs ------------------------------------------------------------


def encode_decimal(value: Column, scale: int) -> Column:
    """Base64 of the scaled integer in the fewest whole bytes, as the wire has it."""
    unscaled = (value * F.lit(Decimal(10) ** scale)).cast("bigint")
    magnitude = unscaled.bitwiseXOR(F.shiftright(unscaled, 63))  # of a negative number: -1 less it
    size = F.lit(1)
    for bits in range(7, 63, 8):  # one of each byte is the sign
        size = size + (magnitude >= F.lit(1 << bits)).cast("int")
    return F.base64(F.unhex(F.substr(F.lpad(F.hex(unscaled), 16, "0"), size * -2)))


def _millis(moment: Column) -> Column:
    return F.unix_millis(moment.cast("timestamp"))


def _zoned_text(moment: Column) -> Column:
    return F.date_format(moment.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _envelope(operation: Column, millis: Column, row: str, wrapped: Column) -> Column:
    """The event text: with or without the schema wrapper, images by operation.

    ``row`` is a column holding the row image as JSON.
    """
    gone = operation == "d"
    body = F.concat(
        F.lit('{"op":"'),
        operation,
        F.lit('","ts_ms":'),
        millis.cast("string"),
        F.lit(',"before":'),
        F.when(gone, F.col(row)).otherwise(F.lit("null")),
        F.lit(',"after":'),
        F.when(gone, F.lit("null")).otherwise(F.col(row)),
        F.lit("}"),
    )
    opening = F.when(wrapped, F.lit('{"schema":{"type":"struct"},"payload":')).otherwise(F.lit(""))
    closing = F.when(wrapped, F.lit("}")).otherwise(F.lit(""))
    return F.concat(opening, body, closing)


def _message_key(name: str, id: Column) -> Column:
    """``{"name":id}``; a formatter would take longer than all of the rest."""
    return F.concat(F.lit(f'{{"{name}":'), F.coalesce(id.cast("string"), F.lit("null")), F.lit("}"))


def _image(*columns: Column | str) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("image")


# A line item is an event about the reading its order and line number name; some
# readings have several. Deletes are followed by a tombstone.
METER_EVENTS_SQL = """
    SELECT l_orderkey * 10 + l_linenumber AS reading_id,
           l_suppkey AS facility_id,
           l_shipdate AS reading_timestamp,
           CAST(l_extendedprice AS DECIMAL(12,3)) - 50000 AS reported_kwh,
           l_returnflag = 'R' AS corrected,
           CASE WHEN l_returnflag = 'R' THEN 'meter ' || l_linestatus END AS correction_reason,
           CASE WHEN l_returnflag = 'R' AND l_discount >= 0.1 THEN 'd'
                WHEN l_returnflag = 'R' THEN 'u'
                WHEN l_returnflag = 'A' THEN 'r' ELSE 'c' END AS operation,
           epoch_ms(l_shipdate) + l_linenumber AS cdc_timestamp_ms,
           l_shipdate + INTERVAL (l_linenumber) MILLISECOND AS cdc_timestamp,
           CAST(l_orderkey % 4 AS INTEGER) AS bronze_partition,
           (l_partkey * 1000 + l_suppkey % 1000) * 8 AS bronze_offset,
           l_shipdate + INTERVAL (l_linenumber) DAY AS ingested_at
    FROM lineitem
"""

METER_ORDER = ("cdc_timestamp", "bronze_partition", "bronze_offset", "facility_id")


def meter_log(spark: SparkSession, sf_dir: str, redelivered: bool = False) -> DataFrame:
    """The raw log of readings. ``redelivered`` repeats the events of line 7 twice over."""
    name = "meter-log-redelivered" if redelivered else "meter-log"
    path = written(spark, sf_dir, name, "lineitem", lambda s, d: build_meter_log(s, d, redelivered))
    return spark.read.parquet(path)


def build_meter_log(spark: SparkSession, sf_dir: str, redelivered: bool = False) -> DataFrame:
    operation = F.expr(
        "CASE WHEN l_returnflag = 'R' AND l_discount >= 0.1 THEN 'd' "
        "WHEN l_returnflag = 'R' THEN 'u' WHEN l_returnflag = 'A' THEN 'r' ELSE 'c' END"
    )
    reading_id = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    kwh = F.col("l_extendedprice").cast("decimal(12,3)") - F.lit(50000)
    corrected = F.col("l_returnflag") == "R"
    row = _image(
        reading_id.alias("reading_id"),
        F.col("l_suppkey").alias("facility_id"),
        _zoned_text(F.col("l_shipdate")).alias("reading_timestamp"),
        encode_decimal(kwh, 3).alias("reported_kwh"),
        corrected.alias("corrected"),
        F.when(corrected, F.concat(F.lit("meter "), "l_linestatus")).alias("correction_reason"),
    )
    shipped = F.col("l_shipdate").cast("timestamp")
    millis = _millis(F.col("l_shipdate")) + F.col("l_linenumber")
    value = _envelope(operation, millis, "image", F.col("l_linestatus") == "F")
    # One row per message: the event, its tombstone if it is a delete, its copies.
    tombstones = F.when(operation == "d", F.lit(1)).otherwise(F.lit(0))
    copies = F.when(F.col("l_linenumber") == 7, F.lit(2)).otherwise(F.lit(0))
    copy = F.explode(F.sequence(F.lit(0), copies)) if redelivered else F.lit(0)
    messages = (
        spread(table(spark, sf_dir, "lineitem"))
        .select("*", F.explode(F.sequence(F.lit(0), tombstones)).alias("tombstone"))
        .select("*", copy.alias("copy"))
    )
    return messages.select("*", row).select(
        _message_key("reading_id", reading_id).alias("key"),
        F.when(F.col("tombstone") == 0, value).alias("value"),
        F.lit("source.readings").alias("topic"),
        (F.col("l_orderkey") % 4).cast("int").alias("partition"),
        # A later copy has a later offset; the gap between offsets leaves room for it.
        (
            (F.col("l_partkey") * 1000 + F.col("l_suppkey") % 1000) * 8
            + F.col("copy") * 2
            + F.col("tombstone")
        ).alias("offset"),
        F.timestamp_millis(millis).alias("kafka_timestamp"),
        F.timestamp_micros(
            F.unix_micros(shipped) + F.col("l_linenumber") * F.lit(86_400_000_000)
        ).alias("ingested_at"),
    )


# An order is entered first and, where it is final, confirmed 30 days later.
INVESTMENT_EVENTS_SQL = f"""
    SELECT investment_id, facility_id, investment_date, amount_eur, category,
           CASE WHEN status = 'confirmed' THEN 'pending' ELSE status END AS status,
           'c' AS operation, CAST(investment_date AS TIMESTAMP) AS cdc_timestamp,
           investment_id * 2 AS bronze_offset
    FROM ({INVESTMENTS_SQL})
    UNION ALL
    SELECT investment_id, facility_id, investment_date, amount_eur, category, status, 'u',
           CAST(investment_date AS TIMESTAMP) + INTERVAL 30 DAY, investment_id * 2 + 1
    FROM ({INVESTMENTS_SQL}) WHERE status = 'confirmed'
"""


def investment_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(written(spark, sf_dir, "investment-log", "orders", build_investment_log))


def build_investment_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spread(investments(spark, sf_dir))
    final = F.col("status") == "confirmed"
    steps = F.when(
        final, F.array(F.lit("pending"), F.lit("confirmed"))
    ).otherwise(F.array(F.col("status")))
    events = rows.select(
        "investment_id",
        "facility_id",
        "investment_date",
        "amount_eur",
        "category",
        F.posexplode(steps).alias("step", "status"),
    )
    moment = F.date_add("investment_date", F.col("step") * 30).cast("timestamp")
    row = _image(
        "investment_id",
        "facility_id",
        F.unix_date("investment_date").alias("investment_date"),
        encode_decimal(F.col("amount_eur"), 2).alias("amount_eur"),
        "category",
        "status",
    )
    operation = F.when(F.col("step") == 0, F.lit("c")).otherwise(F.lit("u"))
    return events.select("*", row).select(
        _message_key("investment_id", F.col("investment_id")).alias("key"),
        _envelope(operation, _millis(moment), "image", F.col("investment_id") % 2 == 0).alias("value"),
        F.lit("source.investments").alias("topic"),
        F.lit(0).alias("partition"),
        (F.col("investment_id") * 2 + F.col("step")).alias("offset"),
        moment.alias("kafka_timestamp"),
        moment.alias("ingested_at"),
    )


# Every facility starts as eligible; those that are not are corrected later.
FACILITY_EVENTS_SQL = f"""
    SELECT facility_id, name, sector, region, facility_id * 1.5 AS annual_consumption_mwh,
           true AS subsidy_eligible, 'c' AS operation, facility_id * 2 AS bronze_offset
    FROM ({FACILITIES_SQL})
    UNION ALL
    SELECT facility_id, name, sector, region, facility_id * 1.5, false, 'u', facility_id * 2 + 1
    FROM ({FACILITIES_SQL}) WHERE NOT subsidy_eligible
"""


def facility_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(written(spark, sf_dir, "facility-log", "supplier", build_facility_log))


def build_facility_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = F.when(F.col("subsidy_eligible"), F.array(F.lit(True))).otherwise(
        F.array(F.lit(True), F.lit(False))
    )
    events = facilities(spark, sf_dir).select(
        "facility_id", "name", "sector", "region", F.posexplode(steps).alias("step", "subsidy_eligible")
    )
    annual = F.col("facility_id").cast("decimal(12,0)") * F.expr("1.5BD")
    row = _image(
        "facility_id",
        "name",
        "sector",
        "region",
        encode_decimal(annual, 3).alias("annual_consumption_mwh"),
        "subsidy_eligible",
    )
    moment = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("step"))
    operation = F.when(F.col("step") == 0, F.lit("c")).otherwise(F.lit("u"))
    return events.select("*", row).select(
        _message_key("facility_id", F.col("facility_id")).alias("key"),
        _envelope(operation, _millis(moment), "image", F.lit(True)).alias("value"),
        F.lit("source.facilities").alias("topic"),
        F.lit(0).alias("partition"),
        (F.col("facility_id") * 2 + F.col("step")).alias("offset"),
        moment.alias("kafka_timestamp"),
        moment.alias("ingested_at"),
    )


def user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as a change log: each event is a new version of its user."""
    return table(spark, sf_dir, "events").select(
        "user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value"
    )
