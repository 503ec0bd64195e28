"""Streaming ingest and relay, table reads and writes, and price series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from registry import inputs as I
from registry.core import query
from registry.marts import _COMPLIANCE, compliance
from strandline.operators import envelope, history
from strandline.session import shared_dir
from strandline.sources import prices as P
from strandline.sources import tables
from strandline.streaming import changes as SC
from strandline.streaming import history as SH
from strandline.streaming import ingest, relay

_TOPICS = {"source.readings": "target.readings", "source.investments": "target.investments"}


def build_event_log(spark, sf):
    """The event table as a message log: keys by user, three topics, four partitions."""
    value = F.to_json(F.struct("event_id", "event_type", "value", "props"))
    topic = F.expr(
        "CASE event_id % 3 WHEN 0 THEN 'source.readings' WHEN 1 THEN 'source.investments' "
        "ELSE 'source.unlisted' END"
    )
    return I.table(spark, sf, "events").select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        topic.alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


_EVENT_LOG = """log AS (
    SELECT CAST(user_id AS VARCHAR) AS key, event_id, event_type,
           CASE event_id % 3 WHEN 0 THEN 'source.readings' WHEN 1 THEN 'source.investments'
                ELSE 'source.unlisted' END AS topic,
           CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset", ts AS kafka_timestamp
    FROM events)"""


# A second log whose files are known: as many as its size asks for, the same number for each
# of so many parts of the events, in order.
_PARTS, _PARTS_PER_TRIGGER, _ROWS_PER_FILE = 8, 2, 1_000_000
_FILES_PER_TRIGGER = 4


def write_parted_log(spark, sf):
    """Where the log lies, and how many files a part has; parts are written one after the other."""
    path, log = shared_dir(spark, "parted-log"), build_event_log(spark, sf)
    files = 1 + log.count() // (_PARTS * _ROWS_PER_FILE)
    for part in range(_PARTS):
        log.where(F.col("offset") % _PARTS == part).repartition(files).write.mode("append").parquet(path)
    return path, files


def _ingested_in_parts(spark, sf, name, parts):
    path, files = write_parted_log(spark, sf)
    options, root = {"maxFilesPerTrigger": str(files * parts)}, shared_dir(spark, name)
    stream = ingest.stream_source(spark, "parquet", options, ingest.LOG_SCHEMA, path)
    ingest.ingest_once(stream, f"{root}/table", f"{root}/checkpoint")
    return spark.read.schema(ingest.BRONZE_SCHEMA).parquet(f"{root}/table")


def event_stream(spark, sf):
    path = I.written(spark, sf, "event-log", "events", build_event_log)
    options = {"maxFilesPerTrigger": str(_FILES_PER_TRIGGER)}
    return ingest.stream_source(spark, "parquet", options, ingest.LOG_SCHEMA, path)


def _ingested(spark, sf, name):
    """Bronze filled by a stream, with the query that filled it."""
    root = shared_dir(spark, name)
    done = ingest.ingest_once(event_stream(spark, sf), f"{root}/table", f"{root}/checkpoint")
    return root, done, spark.read.schema(ingest.BRONZE_SCHEMA).parquet(f"{root}/table")


def _fields(bronze):
    """Bronze with two fields of the value, to show that it came through."""
    body = F.from_json("value", "event_id bigint, event_type string")
    return bronze.select(
        "key",
        body["event_id"].alias("event_id"),
        body["event_type"].alias("event_type"),
        "topic",
        "partition",
        "offset",
        "kafka_timestamp",
    )


@query("stream_source", f"WITH {_EVENT_LOG} SELECT topic, count(*) AS messages FROM log GROUP BY topic")
def stream_source(spark, sf):
    root = shared_dir(spark, "source")
    event_stream(spark, sf).writeStream.format("parquet").option(
        "checkpointLocation", f"{root}/checkpoint"
    ).trigger(availableNow=True).start(f"{root}/table").awaitTermination()
    read = spark.read.schema(ingest.LOG_SCHEMA).parquet(f"{root}/table")
    return read.groupBy("topic").agg(F.count("*").alias("messages"))


@query("stream_bronze_project", f"WITH {_EVENT_LOG} SELECT * FROM log")
def stream_bronze_project(spark, sf):
    path = I.written(spark, sf, "event-log", "events", build_event_log)
    return _fields(ingest.bronze_projection(spark.read.schema(ingest.LOG_SCHEMA).parquet(path)))


@query(
    "stream_ingest_stamp",
    f"""SELECT event_id % {_PARTS} AS part, count(*) AS messages, count(*) AS stamped
    FROM events GROUP BY 1""",
)
def stream_ingest_stamp(spark, sf):
    """One part a micro-batch: the messages of each stamp are those of one part."""
    bronze = _ingested_in_parts(spark, sf, "stamp", 1)
    return bronze.groupBy("ingested_at").agg(
        F.min(F.col("offset") % _PARTS).alias("part"),
        F.count("*").alias("messages"),
        F.count("ingested_at").alias("stamped"),
    ).drop("ingested_at")


@query("stream_append_sink", f"WITH {_EVENT_LOG} SELECT * FROM log")
def stream_append_sink(spark, sf):
    return _fields(_ingested(spark, sf, "append")[2])


@query(
    "stream_exactly_once",
    """SELECT count(*) AS messages, count(DISTINCT event_id) AS distinct_messages FROM events""",
)
def stream_exactly_once(spark, sf):
    """The same stream started again on its checkpoint adds nothing."""
    root, _, _ = _ingested(spark, sf, "restart")
    ingest.ingest_once(event_stream(spark, sf), f"{root}/table", f"{root}/checkpoint")
    bronze = spark.read.schema(ingest.BRONZE_SCHEMA).parquet(f"{root}/table")
    return bronze.agg(
        F.count("*").alias("messages"), F.count_distinct("offset").alias("distinct_messages")
    )


@query(
    "stream_micro_batches",
    f"""SELECT event_id % {_PARTS} // {_PARTS_PER_TRIGGER} AS batch, count(*) AS messages,
        count(DISTINCT event_id % {_PARTS}) AS parts FROM events GROUP BY 1""",
)
def stream_micro_batches(spark, sf):
    """Batches told apart by their stamp, each with the files that the bound allows, in order."""
    bronze = _ingested_in_parts(spark, sf, "batches", _PARTS_PER_TRIGGER)
    part = F.col("offset") % _PARTS
    return bronze.groupBy("ingested_at").agg(
        F.min(F.expr(f"(offset % {_PARTS}) DIV {_PARTS_PER_TRIGGER}")).alias("batch"),
        F.count("*").alias("messages"),
        F.count_distinct(part).alias("parts"),
    ).drop("ingested_at")


@query(
    "topic_relay",
    f"""WITH {_EVENT_LOG} SELECT key, event_id, event_type,
        CASE topic WHEN 'source.readings' THEN 'target.readings'
             WHEN 'source.investments' THEN 'target.investments' ELSE topic END AS topic
    FROM log""",
)
def topic_relay(spark, sf):
    root = shared_dir(spark, "relay")
    done = relay.start_relay(
        event_stream(spark, sf),
        _TOPICS,
        "parquet",
        {},
        f"{root}/checkpoint",
        f"{root}/ledger",
        f"{root}/table",
    )
    done.awaitTermination()
    out = spark.read.schema("key binary, value binary, topic string").parquet(f"{root}/table")
    body = F.from_json(F.col("value").cast("string"), "event_id bigint, event_type string")
    return out.select(
        F.col("key").cast("string").alias("key"),
        body["event_id"].alias("event_id"),
        body["event_type"].alias("event_type"),
        "topic",
    )


@query(
    "relay_progress",
    f"""SELECT event_id % {_PARTS} AS part, count(*) AS forwarded, count(*) AS arrived
    FROM events GROUP BY 1""",
)
def relay_progress(spark, sf):
    """What the relay says it forwarded in each batch, next to what arrived."""
    root = shared_dir(spark, "relay-progress")
    path, files = write_parted_log(spark, sf)
    log = ingest.stream_source(spark, "parquet", {"maxFilesPerTrigger": str(files)}, ingest.LOG_SCHEMA, path)
    relay.start_relay(
        log, _TOPICS, "parquet", {}, f"{root}/checkpoint", f"{root}/ledger", f"{root}/table"
    ).awaitTermination()
    event = F.from_json(F.col("value").cast("string"), "event_id bigint")["event_id"]
    arrived = (
        spark.read.parquet(f"{root}/table")
        .groupBy("batch_id")
        .agg(F.count("*").alias("arrived"), F.min(event % _PARTS).alias("part"))
    )
    forwarded = relay.forwarded(spark, f"{root}/ledger").withColumn("forwarded", F.col("events").cast("long"))
    return forwarded.join(arrived, "batch_id").select("part", "forwarded", "arrived")


_INVEST = f"""SELECT investment_id, facility_id, investment_date, amount_eur, category, status,
    operation, cdc_timestamp, bronze_offset FROM ({I.INVESTMENT_EVENTS_SQL})"""


def _bronze_stream(spark, path):
    options = {"maxFilesPerTrigger": "8"}
    return ingest.stream_source(spark, "parquet", options, ingest.BRONZE_SCHEMA, path)


@query("stream_decoded_changes", _INVEST)
def stream_decoded_changes(spark, sf):
    """Bronze to typed changes, batch by batch, into folders that a replay replaces."""
    root = shared_dir(spark, "changes")
    log = _bronze_stream(spark, I.written(spark, sf, "investment-log", "orders", I.build_investment_log))
    SC.append_changes(
        log, envelope.INVESTMENTS, f"{root}/changes", f"{root}/checkpoint"
    ).awaitTermination()
    out = spark.read.parquet(f"{root}/changes")
    return out.drop("bronze_partition", "ingested_at", "batch_id")


@query("stream_duplicate_guard", _INVEST)
def stream_duplicate_guard(spark, sf):
    """Every event sent twice in one stream; each comes out once."""
    root = shared_dir(spark, "guard")
    log = _bronze_stream(spark, I.written(spark, sf, "investment-log", "orders", I.build_investment_log))
    twice = log.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("copy")
    guarded = SC.guard_duplicates(twice)
    SC.append_changes(
        guarded, envelope.INVESTMENTS, f"{root}/changes", f"{root}/checkpoint"
    ).awaitTermination()
    out = spark.read.parquet(f"{root}/changes")
    return out.drop("bronze_partition", "ingested_at", "batch_id")


@query(
    "stream_history",
    """SELECT user_id, event_id, event_type, ts AS valid_from,
        lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to,
        lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL AS is_current
    FROM events""",
)
def stream_history(spark, sf):
    """Versions opened, closed and split by a stream in which events come in no order of time."""
    root, kinds = shared_dir(spark, "stream-history"), "user_id long, event_id long, event_type string, ts timestamp"
    path, files = f"{root}/in", max(3, 1 + I.table(spark, sf, "events").count() // _ROWS_PER_FILE)
    mixed = I.user_changes(spark, sf).select("user_id", "event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    mixed.repartition(files, F.xxhash64("event_id")).write.parquet(path)
    stream = ingest.stream_source(spark, "parquet", {"maxFilesPerTrigger": str(files // 3 + 1)}, kinds, path)
    told = SH.stream_versions(stream, "user_id", ("ts", "event_id"), lateness="60 days")
    SH.follow(told, f"{root}/told", f"{root}/checkpoint").awaitTermination()
    rows = SH.latest(spark, f"{root}/told", "user_id", ("ts", "event_id"), operation=None)
    return rows.select("user_id", "event_id", "event_type", "valid_from", "valid_to", "is_current")


# --- tables --------------------------------------------------------------------------


@query("read_table", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def read_table(spark, sf):
    return tables.read_table(
        spark, f"{sf}/orders.parquet", ["o_orderkey", "o_orderstatus", "o_totalprice"]
    )


@query(
    "verify_table",
    """SELECT count(*) AS row_count, 'o_orderkey,o_custkey,o_orderstatus' AS columns,
        arg_min('{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey
                || ',"o_orderstatus":"' || o_orderstatus || '"}', o_orderkey) AS sample_row
    FROM orders""",
)
def verify_table(spark, sf):
    orders = I.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return tables.verify_table(orders, ["o_orderkey"]).drop("table_schema")


@query(
    "write_overwrite",
    "SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY o_orderstatus",
)
def write_overwrite(spark, sf):
    """Two versions below one root; the reader is given the newer."""
    root = shared_dir(spark, "overwrite")
    orders = I.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    tables.write_overwrite(orders.where("o_orderstatus = 'F'"), root)
    newest = tables.write_overwrite(orders, root)
    return spark.read.parquet(newest).groupBy("o_orderstatus").agg(F.count("*").alias("orders"))


@query(
    "write_append",
    "SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY o_orderstatus",
)
def write_append(spark, sf):
    """Created once, not again, then appended to."""
    path = f"{shared_dir(spark, 'append-table')}/table"
    orders = I.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    finished = F.col("o_orderstatus") == "F"
    tables.create_if_absent(orders.where(finished), path)
    tables.create_if_absent(orders, path)
    tables.write_append(orders.where(~finished), path)
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count("*").alias("orders"))


@query(
    "publish_full_refresh",
    """SELECT o_orderkey * 2 + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS bronze_offset,
        o_orderkey AS investment_id, CAST(o_totalprice AS DECIMAL(14,2)) AS amount_eur,
        CASE o_orderstatus WHEN 'F' THEN 'confirmed' WHEN 'P' THEN 'pending' ELSE 'other' END AS status,
        true AS is_current
    FROM orders""",
)
def publish_full_refresh(spark, sf):
    """Current investments from their log, published with the declared types."""
    log = I.investment_log(spark, sf)
    changes = envelope.read_changes(log, envelope.INVESTMENTS)
    versions = history.stamp_processed(history.current_from_log(changes, "investment_id"))
    published = tables.publish_full_refresh(
        versions, tables.PUBLISHED_INVESTMENTS, shared_dir(spark, "publish"), "published_investments"
    )
    return published.select("bronze_offset", "investment_id", "amount_eur", "status", "is_current")


@query("publish_mart", f"WITH {_COMPLIANCE} SELECT facility_id, compliance_pct FROM compliance")
def publish_mart(spark, sf):
    schema = {"facility_id": "bigint", "compliance_pct": "decimal(18,1)"}
    return tables.publish_full_refresh(
        compliance(spark, sf), schema, shared_dir(spark, "mart"), "published_compliance"
    )


# --- prices --------------------------------------------------------------------------

# A block holds 168 entries, a week of hours; every tenth price is unknown.
_BLOCK_ENTRIES = 168
_BLOCKS = f"""entries AS (
    SELECT o_orderkey // {_BLOCK_ENTRIES} AS block, epoch_ms(o_orderdate) AS ts_ms,
           o_orderdate AS price_timestamp,
           CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_totalprice AS DECIMAL(12,2)) / 1000 END AS price,
           CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(18,6)) * 0.001 AS exact
    FROM orders),
series AS (
    SELECT block, price_timestamp,
           CAST(round(CAST(exact AS DECIMAL(24,6)), 2) AS DECIMAL(10,2)) AS price_eur_per_mwh,
           CAST(round(exact * 0.001, 6) AS DECIMAL(10,6)) AS price_eur_per_kwh
    FROM entries
    WHERE price IS NOT NULL AND price_timestamp BETWEEN TIMESTAMP '1996-01-01 00:00:00'
          AND TIMESTAMP '2000-03-22 00:00:00')"""
_FIRST = dt.datetime(1996, 1, 1, tzinfo=dt.timezone.utc)
_LAST = dt.datetime(2000, 3, 22, tzinfo=dt.timezone.utc)


def price_blocks(spark, sf):
    """JSON text per block; a block's size is fixed, whatever the table's is."""
    price = F.when(
        F.col("o_orderkey") % 10 != 0,
        (F.col("o_totalprice").cast("decimal(12,2)").cast("decimal(18,6)") * F.expr("0.001BD")),
    )
    entry = F.array(
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).cast("decimal(24,6)"),
        price.cast("decimal(24,6)"),
    )
    return (
        I.table(spark, sf, "orders")
        .groupBy(F.expr(f"o_orderkey DIV {_BLOCK_ENTRIES}").alias("block"))
        .agg(F.collect_list(entry).alias("series"))
        .select("block", F.to_json(F.struct("series")).alias("document"))
    )


def price_series_rows(spark, sf):
    blocks = P.parse_blocks(price_blocks(spark, sf), "document")
    return P.price_series(blocks, F.lit(_FIRST), F.lit(_LAST), keep=["block"])


@query("price_series_source", f"WITH {_BLOCKS} SELECT * FROM series")
def price_series_source(spark, sf):
    return price_series_rows(spark, sf)


@query(
    "price_series_files",
    f"WITH {_BLOCKS} SELECT price_timestamp, price_eur_per_mwh, price_eur_per_kwh FROM series",
)
def price_series_files(spark, sf):
    """The same from JSON files."""
    path = shared_dir(spark, "blocks")
    price_blocks(spark, sf).select("document").write.text(path)
    return P.price_series(P.read_blocks(spark, path), F.lit(_FIRST), F.lit(_LAST))


@query(
    "block_index_select",
    """SELECT CAST(date_trunc('week', ts) AS DATE) AS block_start, count(*) AS entries FROM events
    WHERE CAST(date_trunc('week', ts) AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-22'
    GROUP BY 1""",
)
def block_index_select(spark, sf):
    """Weekly blocks stored by their start; only those in range are opened."""
    path = shared_dir(spark, "block-index")
    events = I.table(spark, sf, "events").select(
        F.date_trunc("week", F.col("ts")).cast("date").alias("block_start"), "event_id", "value"
    )
    tables.balanced(events, "block_start").write.partitionBy("block_start").parquet(path)
    chosen = P.select_blocks(
        spark.read.parquet(path), "block_start", dt.date(2024, 1, 8), dt.date(2024, 1, 22)
    )
    return chosen.groupBy("block_start").agg(F.count("*").alias("entries"))


@query(
    "price_summary",
    f"""WITH {_BLOCKS} SELECT count(*) AS price_count, min(price_timestamp) AS first_price_at,
        max(price_timestamp) AS last_price_at,
        CAST(round(avg(price_eur_per_mwh), 2) AS DECIMAL(11,2)) AS avg_price_eur_per_mwh,
        CAST(round(avg(price_eur_per_kwh), 4) AS DECIMAL(11,4)) AS avg_price_eur_per_kwh,
        min(price_eur_per_mwh) AS min_price_eur_per_mwh,
        max(price_eur_per_mwh) AS max_price_eur_per_mwh
    FROM series""",
)
def price_summary(spark, sf):
    return P.price_summary(price_series_rows(spark, sf))


@query(
    "complete_days_only",
    """WITH hours AS (
        SELECT event_type, CAST(ts AS DATE) AS day, count(DISTINCT hour(ts)) AS n
        FROM events GROUP BY 1, 2)
    SELECT e.event_type, e.event_id, e.ts FROM events e
    JOIN hours h ON e.event_type = h.event_type AND CAST(e.ts AS DATE) = h.day WHERE h.n = 24""",
)
def complete_days_only(spark, sf):
    events = I.table(spark, sf, "events").select("event_type", "event_id", "ts")
    return P.complete_days_only(events, "ts", ["event_type"])
