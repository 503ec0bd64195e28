"""History in a stream against the fold over the whole log."""

import datetime as dt

from pyspark.sql import functions as F

from strandline.operators import history
from strandline.streaming import history as SH
from strandline.streaming import ingest

AT = dt.datetime(2026, 1, 1)
KINDS = "k long, ts timestamp, n long, operation string, value decimal(12,3), note string"
ORDER = ("ts", "n")


def change(k, minute, n, op="u", value="1.500", note=None):
    from decimal import Decimal

    when = None if minute is None else AT + dt.timedelta(minutes=minute, microseconds=n)
    return (k, when, n, op, Decimal(value), note)


def run(spark, rows, source, out, mark, lateness):
    spark.createDataFrame(rows, KINDS).coalesce(1).write.mode("append").parquet(source)
    stream = ingest.stream_source(spark, "parquet", {"maxFilesPerTrigger": "1"}, KINDS, source)
    query = SH.follow(SH.stream_versions(stream, "k", ORDER, lateness=lateness), out, mark)
    query.awaitTermination()
    return query


def plain(df):
    return sorted(map(str, df.select("k", "ts", "n", "operation", "value", "note", "valid_from", "valid_to", "is_current").collect()))


def test_three_batches_one_late_after_restarts(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    first = [change(1, 10, 1, "c"), change(1, 60, 2), change(2, 20, 3, "c", note='a "quoted"\nnote'), change(None, 5, 4), change(3, 30, 5, "c")]
    second = [change(1, 40, 6, value="-7.125"), change(1, 40, 7), change(2, 2, 8), change(2, 90, 9, "d"), change(None, 5, 10),
              change(1, 60, 2), change(4, None, 11)]
    third = [change(1, 200, 12), change(2, 210, 13), change(3, 220, 14, "d"), change(5, 230, 15, "c")]
    batches = []
    for rows in (first, second, third):
        batches += rows
        run(spark, rows, source, out, mark, "3 hours")
        once = spark.createDataFrame(batches, KINDS).where("ts IS NOT NULL").dropDuplicates(["k", *ORDER])
        assert plain(SH.latest(spark, out, "k", ORDER)) == plain(history.history(once, "k", ORDER))
    # The late change split a version of the first batch, and only what changed was told again.
    told = spark.read.parquet(out).where("k = 1").groupBy("revision").agg(F.count("*").alias("n")).orderBy("revision")
    assert [r.n for r in told.collect()] == [2, 3, 2]


def test_what_is_later_than_allowed_is_left_out_and_state_is_let_go(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    run(spark, [change(1, m, m) for m in range(0, 300, 10)], source, out, mark, "30 minutes")
    run(spark, [change(1, 1000, 1)], source, out, mark, "30 minutes")
    run(spark, [change(1, 500, 2), change(1, 990, 3)], source, out, mark, "30 minutes")
    rows = SH.latest(spark, out, "k", ORDER)
    assert rows.count() == 32 and rows.where("n = 2").count() == 0
    assert rows.where("n = 290").first().valid_to == AT + dt.timedelta(minutes=990, microseconds=3)
