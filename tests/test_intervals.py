"""Overlapping pairs against all pairs compared."""

import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandline.operators import intervals

DAY = dt.datetime(2024, 1, 1)
KINDS = "k string, valid_from timestamp, valid_to timestamp, id int"


def at(n):
    return None if n is None else DAY + dt.timedelta(hours=n)


def expected(left, right):
    found = []
    for k, a, b, i in left:
        for q, c, d, j in right:
            if k is None or k != q or a is None or c is None or (b is not None and b <= a) or (d is not None and d <= c):
                continue
            if (d is None or a < d) and (b is None or c < b):
                ends = [x for x in (b, d) if x is not None]
                found.append((k, max(a, c), min(ends) if ends else None, i, j))
    return sorted(found, key=repr)


def answer(spark, left, right, **options):
    one = spark.createDataFrame([(k, at(a), at(b), i) for k, a, b, i in left], KINDS)
    two = spark.createDataFrame([(k, at(a), at(b), i) for k, a, b, i in right], KINDS).withColumnRenamed("id", "other")
    df = intervals.interval_join(one, two, "k", **options).select("k", "overlap_from", "overlap_to", "id", "other")
    hours = lambda t: None if t is None else int((t - DAY).total_seconds() // 3600)
    return sorted(((r.k, hours(r[1]), hours(r[2]), r.id, r.other) for r in df.collect()), key=repr)


def rows(rng, n, keys, span):
    out = []
    for i in range(n):
        start = rng.choice([None, *range(span)]) if rng.random() < 0.05 else rng.randrange(span)
        end = None if start is None or rng.random() < 0.1 else start + rng.choice([0, 1, 2, 5, span, -1])
        out.append((rng.choice(keys), start, end, i))
    return out


@pytest.mark.parametrize("options", [{}, {"rows_per_slice": 7}, {"rows_per_slice": 5, "open_per_task": 3}, {"hot": None}])
def test_equals_all_pairs(spark, options):
    rng = random.Random(11)
    left, right = rows(rng, 150, ["a", "a", "b", None, "c"], 40), rows(rng, 140, ["a", "b", "b", None, "d"], 40)
    left += [left[4], left[4]]
    assert answer(spark, left, right, **options) == expected(left, right)


def test_equal_starts_meet_once(spark):
    left, right = [("a", 1, 3, 1), ("a", 1, None, 2)], [("a", 1, 2, 7), ("a", 2, 3, 8), ("a", 3, 4, 9)]
    assert answer(spark, left, right) == expected(left, right)


def test_empty(spark):
    assert answer(spark, [], []) == [] and answer(spark, [("a", 1, 2, 3)], []) == []


def test_same_names_get_suffixes(spark):
    one = spark.createDataFrame([("a", at(1), at(5), 1)], KINDS)
    df = intervals.interval_join(one, one, "k")
    assert df.columns == ["k", "overlap_from", "overlap_to", "valid_from_left", "valid_to_left", "id_left",
                          "valid_from_right", "valid_to_right", "id_right"]
    assert df.count() == 1


def test_a_key_of_many_intervals_on_both_sides(spark):
    n = 100_000
    chain = spark.range(n).select(F.lit("hot").alias("k"), F.col("id").alias("f"), (F.col("id") + 1).alias("t"), "id")
    other = spark.range(n).select(
        F.lit("hot").alias("k"), (F.col("id") * 2).alias("f"), (F.col("id") * 2 + 3).alias("t"), F.col("id").alias("other")
    )
    df = intervals.interval_join(
        chain, other, "k", left_from="f", left_to="t", right_from="f", right_to="t", rows_per_slice=20_000
    )
    got = df.agg(F.count("*"), F.count_distinct("id"), F.max("overlap_from"), F.min(F.col("overlap_to") - F.col("overlap_from"))).first()
    # Each of the other side's 50,000 first covers three of the chain, the last one two.
    assert tuple(got) == (3 * (n // 2) - 1, n, n - 1, 1)


def test_one_shuffle(spark):
    one = spark.createDataFrame([("a", at(1), at(5), 1)], KINDS)
    text = intervals.interval_join(one, one, "k")._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Join" not in text


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 30))
def test_sweep_alone(seed, span):
    """The task's own loop, without Spark."""
    import pyarrow as pa

    rng = random.Random(seed)
    table = []
    for side in (0, 1):
        for i in range(rng.randint(0, 25)):
            start = rng.randrange(span)
            end = None if rng.random() < 0.1 else start + rng.randint(1, 6)
            table.append((rng.choice("ab"), start, end, side, i))
    table.sort(key=lambda r: (r[0], r[1], r[3]))
    kind = pa.struct([("i", pa.int64())])
    batches = []
    for a in range(0, len(table), 4):
        part = table[a : a + 4]
        box = lambda side: pa.array([{"i": r[4]} if r[3] == side else None for r in part], kind)  # noqa: E731, B023
        columns = [[r[0] for r in part], [r[1] for r in part], [r[2] for r in part], [r[3] for r in part]]
        yes = [True] * len(part)
        arrays = [pa.array(columns[0]), pa.array(columns[1]), pa.array(columns[2], pa.int64()), pa.array(columns[3])]
        arrays += [pa.array(yes), pa.array(yes), box(0), box(1)]
        names = ["k", intervals._FROM, intervals._TO, intervals._SIDE, intervals._MEETS, intervals._STAYS]
        batches.append(pa.RecordBatch.from_arrays(arrays, names=[*names, intervals._LEFT, intervals._RIGHT]))
    got = []
    for out in intervals._sweep(["k"], kind, kind)(iter(batches)):
        got += [(a["i"], b["i"]) for a, b in zip(out.column(0).to_pylist(), out.column(1).to_pylist())]
    want = [
        (x[4], y[4]) for x in table for y in table
        if x[3] == 0 and y[3] == 1 and x[0] == y[0] and (y[2] is None or x[1] < y[2]) and (x[2] is None or y[1] < x[2])
    ]
    assert sorted(got) == sorted(want)
