import datetime as dt
import json

from pyspark.sql import functions as F

from strandline.operators import envelope
from strandline.sources import prices as P
from strandline.sources import tables
from strandline.streaming import changes as SC
from strandline.streaming import ingest, relay

AT = dt.datetime(2026, 1, 1)


def write_messages(spark, path, first, count, files=4, mode="append"):
    df = spark.range(first, first + count).selectExpr(
        "CAST(CAST(id % 7 AS STRING) AS BINARY) AS key",
        "CAST(CONCAT('v', id) AS BINARY) AS value",
        "CASE WHEN id % 2 = 0 THEN 'a' ELSE 'b' END AS topic",
        "0 AS partition",
        "id AS offset",
        "TIMESTAMP '2026-01-01 00:00:00' AS timestamp",
    )
    df.repartition(files).write.mode(mode).parquet(path)


def stream(spark, path, per_trigger=1):
    return ingest.stream_source(
        spark, "parquet", {"maxFilesPerTrigger": str(per_trigger)}, ingest.LOG_SCHEMA, path
    )


def test_restart_neither_loses_nor_repeats(spark, tmp_path):
    source, table, mark = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    write_messages(spark, source, 0, 20)
    ingest.ingest_once(stream(spark, source), table, mark)
    ingest.ingest_once(stream(spark, source), table, mark)
    assert spark.read.parquet(table).count() == 20
    write_messages(spark, source, 20, 15)
    ingest.ingest_once(stream(spark, source), table, mark)
    bronze = spark.read.parquet(table)
    assert bronze.count() == 35
    assert sorted(r.offset for r in bronze.collect()) == list(range(35))
    assert bronze.columns == [
        "key", "value", "topic", "partition", "offset", "kafka_timestamp", "ingested_at",
    ]


def test_batches_are_bounded_and_stamped_once(spark, tmp_path):
    source, table, mark = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    write_messages(spark, source, 0, 40, files=4)
    done = ingest.ingest_once(stream(spark, source), table, mark)
    sizes = [p["numInputRows"] for p in done.recentProgress if p["numInputRows"]]
    assert len(sizes) == 4 and sum(sizes) == 40
    stamps = spark.read.parquet(table).groupBy("ingested_at").count().collect()
    assert sorted(r["count"] for r in stamps) == sorted(sizes)


def test_table_can_be_partitioned(spark, tmp_path):
    source, table, mark = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    write_messages(spark, source, 0, 10)
    ingest.ingest_once(stream(spark, source), table, mark, partition_by=["topic"])
    plan = spark.read.parquet(table).where("topic = 'a'")
    assert plan.count() == 5
    assert "PartitionFilters: [isnotnull(topic" in plan._jdf.queryExecution().toString()


def test_relay_renames_listed_topics_only(spark, tmp_path):
    source, table, mark = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    write_messages(spark, source, 0, 30)
    ledger = str(tmp_path / "ledger")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        done = relay.start_relay(stream(spark, source), {"a": "target"}, "parquet", {}, mark, ledger, table)
        done.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    counted = [r.events for r in relay.forwarded(spark, ledger).collect()]
    assert sum(counted) == 30 and len(counted) > 2
    out = spark.read.parquet(table).select("topic", F.col("value").cast("string").alias("v"))
    got = {r.v: r.topic for r in out.collect()}
    assert got == {f"v{i}": "target" if i % 2 == 0 else "b" for i in range(30)}


def test_relay_without_a_map_changes_nothing(spark):
    df = spark.createDataFrame([("k", "v", "t")], "key string, value string, topic string")
    assert relay.relay(df, {}).collect() == df.collect()


def bronze(spark, path, rows):
    df = spark.createDataFrame(
        [(k, v, "t", 0, o, AT, AT) for k, v, o in rows], ingest.BRONZE_SCHEMA
    )
    df.coalesce(1).write.mode("append").parquet(path)


def event(number, status="pending", op="c"):
    return json.dumps(
        {"op": op, "ts_ms": 1000 + number, "after": {"investment_id": number, "status": status}}
    )


def test_duplicate_guard_across_batches_and_restarts(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))

    def run():
        log = ingest.stream_source(
            spark, "parquet", {"maxFilesPerTrigger": "1"}, ingest.BRONZE_SCHEMA, source
        )
        SC.append_changes(
            SC.guard_duplicates(log), envelope.INVESTMENTS, out, mark
        ).awaitTermination()
        return sorted(
            (r.investment_id, r.status) for r in spark.read.parquet(out).collect()
        )

    bronze(spark, source, [("1", event(1), 0), ("2", event(2), 1), ("1", event(1), 2)])
    bronze(spark, source, [("2", event(2), 3), ("2", event(2, "confirmed", "u"), 4)])
    expected = [(1, "pending"), (2, "confirmed"), (2, "pending")]
    assert run() == expected
    # Sent again after a restart, with old event times: still known, and nothing is too late.
    bronze(spark, source, [("1", event(1), 9), ("3", event(3), 10)])
    assert run() == sorted([*expected, (3, "pending")])


# --- prices ------------------------------------------------------------------------


def ms(*parts):
    return int(dt.datetime(*parts, tzinfo=dt.timezone.utc).timestamp() * 1000)


def test_price_blocks_from_files(spark, tmp_path):
    series = [
        [ms(2025, 12, 31, 23), 10.0],
        [ms(2026, 1, 1), 106.185],
        [ms(2026, 1, 1, 1), None],
        [ms(2026, 1, 1, 2), -5.015],
        [ms(2026, 3, 22), 7],
        [ms(2026, 3, 22, 1), 8.0],
    ]
    (tmp_path / "block.json").write_text(json.dumps({"meta": 1, "series": series}))
    (tmp_path / "empty.json").write_text("{}")
    first = F.lit(dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc))
    last = F.lit(dt.datetime(2026, 3, 22, tzinfo=dt.timezone.utc))
    rows = P.price_series(P.read_blocks(spark, str(tmp_path)), first, last)
    got = [
        (r.price_timestamp, str(r.price_eur_per_mwh), str(r.price_eur_per_kwh))
        for r in rows.orderBy("price_timestamp").collect()
    ]
    assert got == [
        (dt.datetime(2026, 1, 1), "106.19", "0.106185"),
        (dt.datetime(2026, 1, 1, 2), "-5.02", "-0.005015"),
        (dt.datetime(2026, 3, 22), "7.00", "0.007000"),
    ]
    row = P.price_summary(rows).first()
    assert (row.price_count, str(row.min_price_eur_per_mwh)) == (3, "-5.02")


def test_only_complete_days_stay(spark):
    hours = [dt.datetime(2026, 1, d, h) for d in (1, 2) for h in range(24) if (d, h) != (2, 7)]
    hours.append(dt.datetime(2026, 1, 2, 6, 30))  # a second value does not replace an hour
    df = spark.createDataFrame([(h,) for h in hours], "price_timestamp timestamp")
    kept = P.complete_days_only(df).collect()
    assert len(kept) == 24 and {r.price_timestamp.day for r in kept} == {1}


def test_block_selection_is_closed(spark):
    days = [dt.datetime(2025, 12, d) for d in (21, 22, 29)] + [dt.datetime(2026, 3, 23)]
    index = spark.createDataFrame([(d,) for d in days], "start timestamp")
    got = P.select_blocks(index, "start", dt.datetime(2025, 12, 22), dt.datetime(2026, 3, 23))
    assert got.count() == 3


# --- tables ------------------------------------------------------------------------


def test_publish_replaces_as_a_whole_and_keeps_nulls(spark, tmp_path):
    schema = {"id": "bigint", "note": "string", "amount": "decimal(10,2)"}
    first = spark.createDataFrame([("1", "x", "1.005"), ("2", None, None)], "id string, note string, amount string")
    out = tables.publish_full_refresh(first, schema, str(tmp_path), "published")
    assert out.where("note IS NULL AND amount IS NULL").count() == 1
    # The new version may be made from the old one.
    again = spark.table("published").where("id = 1")
    tables.publish_full_refresh(again, schema, str(tmp_path), "published")
    assert [r.id for r in spark.table("published").collect()] == [1]
    assert dict(spark.table("published").dtypes) == {
        "id": "bigint", "note": "string", "amount": "decimal(10,2)",
    }


def test_create_if_absent_then_append(spark, tmp_path):
    path = str(tmp_path / "table")
    one = spark.range(3)
    assert tables.create_if_absent(one, path) is True
    assert tables.create_if_absent(one, path) is False
    tables.write_append(one, path)
    assert tables.read_table(spark, path).count() == 6
    one.createOrReplaceTempView("ids_by_name")
    assert tables.read_table(spark, "ids_by_name", ["id"]).count() == 3


def test_verify_table(spark):
    row = tables.verify_table(spark.range(3, 9), ["id"]).first()
    assert (row.row_count, row.columns, row.sample_row) == (6, "id", '{"id":3}')


def test_published_tables_outlive_the_session(spark, tmp_path):
    root = str(tmp_path / "published")
    schema = {"a": "bigint"}
    tables.publish_full_refresh(spark.range(3).selectExpr("id AS a"), schema, root, "first_view")
    tables.publish_full_refresh(spark.range(5).selectExpr("id AS a"), schema, root, "second_view")
    other = spark.newSession()
    assert tables.open_published(other, root).count() == 5
    assert not other.catalog.tableExists("second_view")


def test_messages_without_a_value_are_never_copies(spark, tmp_path):
    rows = [("k", None, "t", 0, i) for i in range(3)] + [("k", "v", "t", 0, i) for i in (3, 4)]
    schema = "key string, value string, topic string, partition int, offset long"
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    spark.createDataFrame(rows, schema).write.parquet(source)
    log = spark.readStream.schema(schema).parquet(source)
    SC.guard_duplicates(log).writeStream.format("parquet").option("checkpointLocation", mark).trigger(
        availableNow=True
    ).start(out).awaitTermination()
    assert spark.read.parquet(out).count() == 4


def test_a_table_another_writer_made_stays(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "raced")
    monkeypatch.setattr(tables, "_exists", lambda *_: False)
    spark.range(2).write.parquet(path)
    tables.create_if_absent(spark.range(9), path)
    assert spark.read.parquet(path).count() == 2
