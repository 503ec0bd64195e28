"""Payments matched to obligations: earliest deadline first."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strandline.plans import repayment as R

D = dt.date


def frames(spark, owed, paid):
    obligations = spark.createDataFrame(
        [(f, m, d, None if o is None else Decimal(o)) for f, m, d, o in owed],
        "facility_id long, consumption_month int, deadline date, obligation_eur decimal(18,3)",
    )
    payments = spark.createDataFrame(
        [(f, d, None if x is None else Decimal(x)) for f, d, x in paid], "facility_id long, paid_on date, paid_eur decimal(18,3)"
    )
    return obligations, payments


def matched(spark, owed, paid):
    rows = R.match_deadlines(*frames(spark, owed, paid)).collect()
    return {(r.facility_id, r.consumption_month): (r.met, r.unmet) for r in rows}


def greedy(owed, paid):
    """Payment by payment, each to the earliest deadline that it does not miss."""
    left = {(f, m): Decimal(o) for f, m, _, o in owed}
    taken = {}
    for f, day, amount in sorted(paid, key=lambda p: p[1]):
        amount = Decimal(amount)
        for g, m, deadline, _ in sorted(owed, key=lambda o: (o[2], o[1])):
            if g == f and deadline >= day and amount > 0:
                used = min(amount, left[g, m])
                if used:
                    taken[g, m, day] = taken.get((g, m, day), 0) + used
                left[g, m] -= used
                amount -= used
    return left, taken


def test_a_late_payment_does_not_pay_for_the_first_month(spark):
    owed = [(1, 1, D(2028, 1, 1), "100"), (1, 2, D(2028, 2, 1), "100")]
    got = matched(spark, owed, [(1, D(2028, 1, 2), "500")])
    assert got == {(1, 1): (0, 100), (1, 2): (100, 0)}


def test_an_early_payment_carries_over(spark):
    owed = [(1, 1, D(2028, 1, 1), "100"), (1, 2, D(2028, 2, 1), "100"), (1, 3, D(2028, 3, 1), "50.5")]
    got = matched(spark, owed, [(1, D(2027, 5, 5), "150"), (1, D(2028, 3, 1), "20")])
    assert got == {(1, 1): (100, 0), (1, 2): (50, 50), (1, 3): (20, Decimal("30.5"))}


def test_odd_rows(spark):
    owed = [(None, 1, D(2028, 1, 1), "10"), (1, 1, None, "10"), (2, 1, D(2028, 1, 1), None), (3, 1, D(2028, 1, 1), "0"),
            (4, 2, D(2028, 1, 1), "5"), (4, 1, D(2028, 1, 1), "5")]
    paid = [(None, D(2027, 1, 1), "99"), (1, D(2027, 1, 1), "99"), (4, D(2027, 1, 1), "7"), (4, D(2027, 1, 2), None),
            (4, D(2027, 1, 3), "-3"), (9, D(2027, 1, 1), "1")]
    got = matched(spark, owed, paid)
    assert got == {(None, 1): (0, 10), (1, 1): (0, 10), (2, 1): (0, 0), (3, 1): (0, 0), (4, 1): (5, 0), (4, 2): (2, 3)}


def test_nothing_owed_or_paid(spark):
    assert matched(spark, [], []) == {}
    assert matched(spark, [(1, 1, D(2028, 1, 1), "4")], []) == {(1, 1): (0, 4)}


@pytest.mark.parametrize("seed", range(4))
def test_equals_greedy_matching(spark, seed):
    rng = random.Random(seed)
    owed = [(f, m, D(2028, 1, 1) + dt.timedelta(days=rng.randint(0, 60)), str(rng.randint(0, 40)))
            for f in range(6) for m in range(rng.randint(0, 12))]
    paid = {(f, D(2028, 1, 1) + dt.timedelta(days=rng.randint(-20, 70))): str(rng.randint(1, 60))
            for f in range(7) for _ in range(rng.randint(0, 12))}
    paid = [(f, d, x) for (f, d), x in paid.items()]
    left, taken = greedy(owed, paid)
    obligations, payments = frames(spark, owed, paid)
    done = R.match_deadlines(obligations, payments)
    assert {(r.facility_id, r.consumption_month): r.unmet for r in done.collect()} == left
    pieces = R.allocations(done, payments).collect()
    assert sum(r.amount for r in pieces) == sum(taken.values())
    by_claim, by_day = {}, {}
    for r in pieces:
        assert r.amount > 0
        by_claim[r.facility_id, r.consumption_month] = by_claim.get((r.facility_id, r.consumption_month), 0) + r.amount
        by_day[r.facility_id, r.paid_on] = by_day.get((r.facility_id, r.paid_on), 0) + r.amount
    deadlines = {(f, m): d for f, m, d, _ in owed}
    assert all(r.paid_on <= deadlines[r.facility_id, r.consumption_month] for r in pieces)
    assert by_claim == {k: Decimal(o) - left[k] for k, o in ((x[:2], x[3]) for x in owed) if Decimal(o) > left[k]}
    assert all(by_day[k] <= Decimal(x) for k, x in ((p[:2], p[2]) for p in paid) if k in by_day)
    assert len(pieces) <= len(owed) + len(paid)


def test_one_shuffle_of_payments_summed_before(spark):
    from registry import inputs as I
    from registry import marts

    sf = "/root/testdata/sf0.001"
    entitled = marts.entitlement(spark, sf)
    df = R.match_deadlines(R.monthly_obligations(entitled), R.confirmed_payments(I.investments(spark, sf)))
    text = df._jdf.queryExecution().executedPlan().toString()
    above = text[: text.index("Union")]
    assert above.count("Exchange") == 1 and above.count("Window") >= 3
    assert "partial_sum" in text and "CartesianProduct" not in text


def test_overdue(spark):
    owed = [(1, 1, D(2028, 1, 1), "100"), (1, 2, D(2028, 2, 1), "100"), (1, 3, D(2028, 3, 1), "10")]
    obligations, payments = frames(spark, owed, [(1, D(2028, 1, 20), "60")])
    repaid = R.match_deadlines(obligations, payments).withColumnsRenamed({"unmet": "principal_to_repay_eur"})
    (r,) = R.repayment_by_facility(repaid, F.expr("DATE '2028-02-01'")).collect()
    assert (r.obligation_eur, r.overdue_eur, r.still_to_meet_eur, r.months_overdue) == (210, 100, 50, 1)
    assert r.next_deadline == D(2028, 2, 1)
