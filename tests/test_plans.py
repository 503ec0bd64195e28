"""What the plans must look like for the work to scale."""

import re

import pytest

from registry import inputs as I
from registry import marts
from strandline.operators import envelope, history
from strandline.plans import entitlement as E
from strandline.plans import staging as S

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


@pytest.fixture(scope="module")
def log(spark):
    return I.meter_log(spark, SF_DIR)


def test_history_is_one_shuffle_and_one_scan(spark, log):
    changes = envelope.read_changes(log, envelope.METER_READINGS, (*envelope.WRITES, "d"))
    text = plan(history.history(changes, "reading_id", I.METER_ORDER, log=log))
    assert shuffles(text) == 1 and text.count("FileScan") == 1
    assert text.count("from_json") == 1  # the filter does not parse again


def test_closed_versions_parse_only_what_they_show(spark):
    from registry import QUERIES

    text = plan(QUERIES["scd2_close"](spark, SF_DIR))
    parsed = re.search(r"from_json\((.*?), value#", text).group(1)
    assert "facility_id" in parsed and "reported_kwh" not in parsed and "correction_reason" not in parsed


def test_fields_left_out_do_not_change_the_others(spark, log):
    few = envelope.read_changes(log, envelope.METER_READINGS, (*envelope.WRITES, "d"), ["facility_id"])
    every = envelope.read_changes(log, envelope.METER_READINGS, (*envelope.WRITES, "d"))
    assert few.exceptAll(every.select(*few.columns)).isEmpty() and few.count() == every.count()
    with pytest.raises(ValueError, match="no such fields"):
        envelope.read_changes(log, envelope.METER_READINGS, columns=["nothing"])


def test_encoding_a_number_writes_no_binary_digits(spark):
    text = plan(I.build_meter_log(spark, SF_DIR))
    assert "bin(" not in text and text.count("explode(") == 1  # no copies, no step for them


def test_current_versions_combine_before_the_shuffle(spark, log):
    changes = envelope.read_changes(log, envelope.METER_READINGS)
    text = plan(history.current_from_log(changes, "reading_id", I.METER_ORDER))
    assert shuffles(text) == 1 and "partial_max_by" in text


def test_redelivered_copies_combine_before_the_shuffle(spark, log):
    changes = envelope.read_changes(log, envelope.METER_READINGS)
    text = plan(history.drop_redelivered(changes, ["reading_id", "operation", "cdc_timestamp"], I.METER_ORDER))
    assert "partial_min_by" in text


def test_readings_are_aggregated_before_they_are_joined(spark):
    facilities = S.facilities(I.facilities(spark, SF_DIR))
    monthly = E.monthly_consumption(I.readings(spark, SF_DIR), facilities)
    text = plan(monthly.select("facility_id", "consumption_month", "total_kwh"))
    # The scan of readings has only the columns of the sum, under a partial aggregate.
    scan = re.search(r"FileScan parquet \[l_suppkey[^\]]*\]", text).group(0)
    assert scan.count("#") == 3
    lines = text.splitlines()
    below = next(i for i, l in enumerate(lines) if "l_suppkey" in l and "FileScan" in l)
    assert any("partial_sum" in l for l in lines[below - 6 : below])


def test_prices_read_two_columns(spark):
    text = plan(marts.monthly_prices(spark, SF_DIR))
    assert re.search(r"ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>", text)


def test_only_changed_versions_are_one_shuffle(spark):
    changes = I.user_changes(spark, SF_DIR)
    versions = history.history(
        changes, "user_id", ("ts", "event_id"), operation=None, changed_columns=["event_type"], hot=None
    )
    assert shuffles(plan(versions)) == 1


def test_complete_days_are_one_aggregation(spark):
    from strandline.sources import prices as P

    events = I.table(spark, SF_DIR, "events").select("event_type", "event_id", "ts")
    text = plan(P.complete_days_only(events, "ts", ["event_type"]))
    assert text.count("partial_bit_or") == 1 and text.count("HashAggregate") == 2


def test_a_sample_folds_only_its_keys(spark, log):
    changes = envelope.read_changes(log, envelope.METER_READINGS, (*envelope.WRITES, "d"))
    text = plan(history.history_sample_from_log(changes, "reading_id", I.METER_ORDER))
    assert text.count("FileScan") == 2 and "BroadcastHashJoin" in text and "LeftSemi" in text


def test_redelivered_copies_are_grouped_by_a_digest(spark, log):
    changes = envelope.read_changes(log, envelope.METER_READINGS)
    identity = [*envelope.METER_READINGS.columns, "operation", "cdc_timestamp"]
    text = plan(history.drop_redelivered(changes, identity, I.METER_ORDER))
    assert re.search(r"Exchange hashpartitioning\(__digest_0#\d+L, __digest_1#\d+L", text)


def test_shared_parts_are_scanned_once(spark):
    df = marts.summary(spark, SF_DIR)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    scans = re.findall(r"FileScan parquet \[l_", final)
    assert len(scans) == 1


@pytest.mark.parametrize("name", ["compliance_summary", "scd2_history", "chunk_metadata", "html_to_text"])
def test_no_python_worker(spark, name):
    from registry import QUERIES

    text = plan(QUERIES[name](spark, SF_DIR))
    assert "Python" not in text and "InArrow" not in text and "InPandas" not in text


def test_chunking_needs_no_shuffle_of_its_own(spark):
    from strandline.operators import chunks

    documents = I.table(spark, SF_DIR, "documents")
    text = plan(chunks.chunk_documents(documents, "doc_id"))
    assert "Exchange" not in text and "Window" not in text
    assert text.count("split(") == 1


def test_price_blocks_are_parsed_once(spark):
    from pyspark.sql import functions as F

    from strandline.sources import prices as P

    blocks = spark.range(3).select(F.col("id").cast("string").alias("document"))
    series = P.price_series(
        P.parse_blocks(blocks, "document"), F.timestamp_seconds(F.lit(0)), F.current_timestamp()
    )
    assert plan(series).count("from_json") == 1


@pytest.mark.parametrize("name", ["knn_cosine", "knn_approx"])
def test_vector_search_has_no_product(spark, name):
    from registry import QUERIES

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES[name](spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Cartesian" not in text and "NestedLoop" not in text
    if name == "knn_cosine":  # the vectors, and the few of them that are questions
        assert "Join" not in text and text.count("FileScan") == 2
