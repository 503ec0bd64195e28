"""Marts and history that follow batches of changes."""

import datetime as dt
import glob
import os
import shutil
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strandline.operators import envelope, history, kept
from strandline.plans import compliance as C
from strandline.plans import entitlement as E
from strandline.plans import incremental as N
from strandline.plans import staging as S

AT = dt.datetime(2026, 1, 1)
CHANGES = (
    "operation string, cdc_timestamp timestamp, reading_id long, facility_id long, reading_timestamp timestamp, "
    "reported_kwh decimal(12,3), corrected boolean, correction_reason string, bronze_partition int, bronze_offset long"
)


def change(op, minute, reading, facility=1, month=1, kwh=100, corrected=False):
    return (op, AT + dt.timedelta(minutes=minute), reading, facility, dt.datetime(2026, month, 5),
            None if kwh is None else Decimal(kwh), corrected, None, 0, minute)


def frame(spark, rows):
    return spark.createDataFrame(rows, CHANGES)


@pytest.fixture
def dims(spark):
    facilities = spark.createDataFrame(
        [(1, "One", "s", "r", True), (2, "Two", "s", "r", False), (3, "Idle", "s", "r", True)],
        "facility_id long, name string, sector string, region string, subsidy_eligible boolean",
    )
    investments = spark.createDataFrame(
        [(1, Decimal(5), "flexibility", "confirmed")], "facility_id long, amount_eur decimal(14,2), category string, status string"
    )
    return facilities, investments


def priced(spark, months):
    rows = [(dt.datetime(2026, m, 1), Decimal(p)) for m, p in months.items()]
    made = spark.createDataFrame(rows, "price_month timestamp, avg_price_eur_per_kwh decimal(11,6)")
    none = F.lit(None).cast("decimal(11,2)")
    return made.withColumns({f"{x}_price_eur_per_mwh": none for x in ("avg", "min", "max")})


def from_scratch(spark, rows, prices, dims):
    facilities, investments = dims
    readings = S.current_readings(history.current_from_log(frame(spark, rows), "reading_id", envelope.LOG_ORDER))
    monthly = E.monthly_consumption(readings, facilities)
    entitled = E.subsidy_entitlement(monthly, facilities, prices)
    met = C.investment_compliance(C.facility_subsidies(entitled), C.investment_pivot(investments))
    return (
        C.compliance_summary(facilities, monthly, entitled, met).collect(),
        entitled.collect(),
        monthly.collect(),
    )


def followed(spark, root, prices, dims):
    facilities, investments = dims
    return (
        N.compliance_summary(spark, root, facilities, investments).collect(),
        N.subsidy_entitlement(spark, root, facilities, prices).collect(),
        N.monthly_consumption(spark, root, facilities).collect(),
    )


def same(a, b):
    for x, y in zip(a, b):
        assert sorted(map(str, (r.asDict().items() for r in x))) == sorted(map(str, (r.asDict().items() for r in y)))


def test_two_batches_equal_a_build_and_read_their_months_only(spark, tmp_path, dims):
    root, prices = str(tmp_path / "marts"), priced(spark, {1: "0.14", 2: "0.09"})
    first = [change("c", 1, 10), change("c", 2, 11, month=2, kwh=40), change("c", 3, 12, facility=2, month=3),
             change("r", 4, 13, facility=9), change("c", 5, 14, month=2, kwh=None), change("c", 6, None, month=3, kwh=7)]
    written = N.apply_changes(frame(spark, first), root, prices, buckets=4, facility_buckets=4)
    assert written["monthly"] == [2026 * 12 + m for m in (1, 2, 3)]
    same(followed(spark, root, prices, dims), from_scratch(spark, first, prices, dims))

    # March is not opened by a batch that has nothing of it.
    (march,) = glob.glob(f"{root}/monthly/generation=*/bucket={2026 * 12 + 3}")
    shutil.move(march, str(tmp_path / "march"))
    second = [change("u", 20, 11, month=2, kwh=45, corrected=True), change("d", 21, 10), change("c", 0, 15, month=2, kwh=3),
              change("u", 22, 14, month=2, kwh=9)]
    written = N.apply_changes(frame(spark, second), root, prices, buckets=4, facility_buckets=4)
    assert written["monthly"] == [2026 * 12 + 1, 2026 * 12 + 2]
    shutil.move(str(tmp_path / "march"), march)
    same(followed(spark, root, prices, dims), from_scratch(spark, first + second, prices, dims))

    # The same batch again, and one that fails before the end, leave all as it is.
    again = N.apply_changes(frame(spark, second), root, prices, buckets=4, facility_buckets=4)
    assert again == {"monthly": [], "totals": []}
    folders = kept.folders(spark, root), kept.folders(spark, root, "monthly")
    kept.folded_batch(frame(spark, [change("u", 30, 12, kwh=1)]), root, "reading_id", buckets=4)
    assert (kept.folders(spark, root), kept.folders(spark, root, "monthly")) == folders

    # A new price is a change of its month, and needs no readings.
    prices = priced(spark, {1: "0.14", 2: "0.30", 3: "0.2"})
    written = N.apply_changes(None, root, prices, buckets=4, facility_buckets=4, spark=spark)
    assert written["monthly"] == []
    same(followed(spark, root, prices, dims), from_scratch(spark, first + second, prices, dims))


def test_a_null_bucket_is_a_bucket(spark, tmp_path):
    root = str(tmp_path / "kept")
    rows = [change("c", 1, None), change("c", 2, 5), change("c", 3, 1200)]
    number = F.expr("reading_id div 1000")
    kept.apply_batch(frame(spark, rows), root, "reading_id", bucket=number)
    kept.apply_batch(frame(spark, [change("u", 4, None), change("u", 5, 5)]), root, "reading_id", bucket=number)
    got = sorted((r.reading_id is None, r.reading_id or 0, r.is_current) for r in kept.kept_history(spark, root).collect())
    assert got == [(False, 5, False), (False, 5, True), (False, 1200, True), (True, 0, True), (True, 0, True)]
    assert sorted(kept.folders(spark, root)) == [kept.NO_BUCKET, 0, 1]


def test_a_broken_list_is_not_taken_for_none(spark, tmp_path):
    root = str(tmp_path / "kept")
    kept.apply_batch(frame(spark, [change("c", 1, 5)]), root, "reading_id", buckets=2)
    (listed,) = glob.glob(f"{root}/generations/*.parquet")
    with open(listed, "r+b") as file:
        file.truncate(os.path.getsize(listed) // 2)
    with pytest.raises(Exception, match="(?i)parquet|footer|corrupt"):
        kept.apply_batch(frame(spark, [change("u", 2, 5)]), root, "reading_id", buckets=2)
    assert kept.folders(spark, str(tmp_path / "none")) == {}
