import base64
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from registry.inputs import encode_decimal
from strandline.functions import decode
from strandline.operators import envelope


def wire(number: int) -> str:
    size = ((number if number >= 0 else ~number).bit_length() + 8) // 8
    return base64.b64encode(number.to_bytes(size, "big", signed=True)).decode()


@pytest.mark.parametrize(
    "text, expected",
    [("/w==", -1), ("gA==", -128), ("fQ==", 125), ("+Zo=", -1638), ("AYag", 100000), ("AA==", 0)],
)
def test_known_encodings(spark, text, expected):
    row = spark.range(1).select(decode.decode_decimal(F.lit(text), 12, 0).alias("n")).first()
    assert row.n == expected


@pytest.mark.parametrize("text", ["", "!!!", None, "A", "////////////////"])
def test_malformed_decimals_are_null(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(decode.decode_decimal(F.col("t"), 12, 3).alias("n")).first().n is None


def test_value_too_wide_for_its_type_is_null(spark):
    df = spark.createDataFrame([(wire(10**12),), (wire(10**12 - 1),), (wire(-(2**63)),)], "t string")
    got = [r.n for r in df.select(decode.decode_decimal(F.col("t"), 12, 3).alias("n")).collect()]
    assert got == [None, Decimal("999999999.999"), None]


def test_decimals_round_trip_at_every_byte_boundary(spark):
    edges = {0, 1, -1}
    for bits in range(7, 57, 8):
        edges |= {2**bits - 1, 2**bits, -(2**bits), -(2**bits) - 1}
    edges = sorted(n for n in edges if abs(n) < 10**14)
    df = spark.createDataFrame([(n, wire(n)) for n in edges], "n long, wire string")
    value = (F.col("n").cast("decimal(20,0)") * F.expr("0.01BD")).cast("decimal(14,2)")
    rows = df.select(
        "n",
        "wire",
        decode.decode_decimal(F.col("wire"), 14, 2).alias("decoded"),
        value.alias("value"),
        encode_decimal(value, 2).alias("encoded"),
    ).collect()
    for row in rows:
        assert row.decoded == row.value, row
        assert row.encoded == row.wire, row


def test_epoch_days_and_millis(spark):
    df = spark.createDataFrame(
        [("20503", "1774114167635"), ("x", "9223372036854775807"), ("-1", "-1"), (None, None)],
        "d string, ms string",
    )
    rows = df.select(
        decode.decode_epoch_days(F.col("d")).alias("d"),
        F.unix_millis(decode.decode_epoch_millis(F.col("ms"))).alias("ms"),
    ).collect()
    assert [r.d for r in rows] == [dt.date(2026, 2, 19), None, dt.date(1969, 12, 31), None]
    assert [r.ms for r in rows] == [1774114167635, None, -1, None]


def test_zoned_text_does_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("2026-01-30T16:00:00.000000Z",), ("nonsense",)], "t string")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        seconds = [
            r[0]
            for r in df.select(
                F.unix_timestamp(decode.decode_zoned_timestamp(F.col("t")))
            ).collect()
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert seconds == [1769788800, None]


BODY = (
    '{"op":"c","ts_ms":1774114167635,"before":null,"after":{"reading_id":1,"facility_id":7,'
    '"reading_timestamp":"2026-01-30T16:00:00.000000Z","reported_kwh":"AYag","corrected":false,'
    '"correction_reason":null}}'
)


def log(spark, values):
    rows = [("k", v, "t", 0, i) for i, v in enumerate(values)]
    return spark.createDataFrame(
        rows, "key string, value string, topic string, partition int, offset long"
    )


def test_wrapped_and_bare_bodies_decode_the_same(spark):
    wrapped = '{"schema":{"type":"struct"},"payload":' + BODY + "}"
    rows = envelope.read_changes(log(spark, [BODY, wrapped]), envelope.METER_READINGS).collect()
    assert len(rows) == 2
    first, second = (r.asDict() for r in rows)
    first.pop("bronze_offset"), second.pop("bronze_offset")
    assert first == second
    assert first["reported_kwh"] == Decimal("100.000")
    assert first["reading_timestamp"] == dt.datetime(2026, 1, 30, 16)


def test_tombstones_and_junk_are_dropped_without_an_error(spark):
    values = [None, "", "not json", "{}", "[]", "7", '{"payload":null}', BODY]
    rows = envelope.read_changes(log(spark, values), envelope.METER_READINGS).collect()
    assert [r.bronze_offset for r in rows] == [7]


def test_one_bad_field_leaves_the_others(spark):
    bad = BODY.replace('"reading_id":1', '"reading_id":"x"').replace('"AYag"', '"!!!"')
    row = envelope.read_changes(log(spark, [bad]), envelope.METER_READINGS).first()
    assert (row.reading_id, row.facility_id, row.reported_kwh) == (None, 7, None)
    quoted = BODY.replace('"reading_id":1', '"reading_id":"1"')
    assert envelope.read_changes(log(spark, [quoted]), envelope.METER_READINGS).first().reading_id == 1


def test_deletes_keep_their_key(spark):
    delete = '{"op":"d","ts_ms":5,"before":{"reading_id":9},"after":null}'
    events = log(spark, [delete])
    assert envelope.read_changes(events, envelope.METER_READINGS).count() == 0
    row = envelope.read_changes(events, envelope.METER_READINGS, ("d",)).first()
    assert (row.operation, row.reading_id) == ("d", 9)


def test_latest_per_key(spark):
    def event(op, ms, name):
        return (
            f'{{"op":"{op}","ts_ms":{ms},"after":{{"facility_id":1,"name":"{name}",'
            '"subsidy_eligible":true}}}'.replace("}}}", "}}")
        )

    changes = envelope.read_changes(
        log(spark, [event("c", 1, "a"), event("u", 9, "b"), event("u", 3, "c")]), envelope.FACILITIES
    )
    rows = envelope.latest_per_key(changes, "facility_id").collect()
    assert [(r.facility_id, r.name) for r in rows] == [(1, "b")]


def test_numbers_take_the_fewest_bytes_at_every_size(spark):
    edges = {sign * (1 << bits) + d for bits in range(59) for sign in (1, -1) for d in (-1, 0, 1)}
    rows = [(n, Decimal(n)) for n in edges] + [(None, None)]
    df = spark.createDataFrame(rows, "n long, value decimal(18,0)")
    for n, encoded in df.select("n", encode_decimal(F.col("value"), 0)).collect():
        assert encoded == (None if n is None else wire(n))
