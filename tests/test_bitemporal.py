"""Versions by two times, against a search through all changes for each fact."""

import datetime as dt
import random
import sys

import numpy as np
import pyarrow as pa
import pytest

from strandline.operators import bitemporal

DAY = dt.datetime(2024, 1, 1)
CHANGES = "k string, ts timestamp, seen timestamp, operation string, n int, v int"
FACTS = "k string, about timestamp, known timestamp, id int"


def at(n):
    return None if n is None else DAY + dt.timedelta(hours=n)


def expected(facts, changes, deletes="close", how="left"):
    out = []
    for k, about, known, i in facts:
        best = None
        if None not in (k, about, known):
            able = [c for c in changes if c[0] == k and None not in (c[1], c[2]) and c[1] <= about and c[2] <= known]
            if deletes == "ignore":
                able = [c for c in able if c[3] != "d"]
            best = max(able, key=lambda c: (c[1], c[4] is not None, c[4] or 0, c[5]), default=None)
            if best is not None and best[3] == "d":
                best = None
        if best is not None or how == "left":
            out.append((i, None if best is None else best[5]))
    return sorted(out, key=repr)


def answer(spark, facts, changes, **options):
    one = spark.createDataFrame([(k, at(a), at(w), i) for k, a, w, i in facts], FACTS)
    two = spark.createDataFrame([(k, at(t), at(s), op, n, v) for k, t, s, op, n, v in changes], CHANGES)
    df = bitemporal.bitemporal_join(
        one, two, "k", "about", "known", version_columns=["v"], order_by=["ts", "n", "v"], seen_at="seen", **options
    )
    assert df.columns == ["k", "about", "known", "id", "v"]
    return sorted(((r.id, r.v) for r in df.collect()), key=repr)


def tables(seed, n=250):
    rng = random.Random(seed)
    hour = lambda: None if rng.random() < 0.03 else rng.randrange(60)
    key = lambda: rng.choice(["hot"] * 6 + ["a", "b", None, "c"])
    changes = []
    for i in range(n):
        ts = hour()
        late = rng.choice([0, 1, 1, 3, 40, -2])
        seen = None if ts is None or rng.random() < 0.03 else ts + late
        changes.append((key(), ts, seen, rng.choice("uuud"), rng.choice([None, 1, 2]), i))
    facts = [(rng.choice(["hot", "hot", "a", "zzz", None]), hour(), hour(), i) for i in range(n)]
    return facts, changes


@pytest.mark.parametrize("options", [{}, {"rows_per_slice": 20}, {"rows_per_slice": 3}, {"hot": None},
                                     {"deletes": "ignore"}, {"how": "inner", "rows_per_slice": 20}])
def test_equals_a_search(spark, options):
    facts, changes = tables(5)
    kept = {k: v for k, v in options.items() if k in ("deletes", "how")}
    assert answer(spark, facts, changes, **options) == expected(facts, changes, **kept)


def test_a_correction_seen_later_is_not_known_before(spark):
    changes = [("a", 1, 1, "c", 0, 10), ("a", 5, 20, "u", 1, 11), ("a", 8, 8, "u", 2, 12), ("a", 30, 30, "d", 3, 13)]
    facts = [("a", 6, 10, 1), ("a", 6, 20, 2), ("a", 8, 8, 3), ("a", 0, 99, 4), ("a", 31, 29, 5), ("a", 31, 31, 6)]
    assert answer(spark, facts, changes) == [(1, 10), (2, 11), (3, 12), (4, None), (5, 12), (6, None)]


def test_empty(spark):
    assert answer(spark, [], []) == []
    assert answer(spark, [("a", 1, 1, 1)], []) == [(1, None)]
    assert answer(spark, [], [("a", 1, 1, "c", 0, 10)]) == []


def test_agrees_with_the_fold_for_one_date(spark):
    from pyspark.sql import functions as F

    from strandline.operators import history

    _, changes = tables(9)
    changes = [c for c in changes if c[0] and c[1] is not None and c[2] is not None]
    two = spark.createDataFrame([(k, at(t), at(s), op, n, v) for k, t, s, op, n, v in changes], CHANGES)
    keys = sorted({c[0] for c in changes})
    got = dict(answer(spark, [(k, 30, 25, i) for i, k in enumerate(keys)], changes))
    known = history.as_known_at(two, F.lit(at(25)), "k", ["ts", "n", "v"], seen_at="seen")
    want = {r.k: r.v for r in history.as_of(known, F.lit(at(30))).collect()}
    assert {keys[i]: v for i, v in got.items() if v is not None} == want


def test_one_shuffle(spark):
    facts, changes = tables(1, 20)
    one = spark.createDataFrame([(k, at(a), at(w), i) for k, a, w, i in facts], FACTS)
    two = spark.createDataFrame([(k, at(t), at(s), op, n, v) for k, t, s, op, n, v in changes], CHANGES)
    df = bitemporal.bitemporal_join(
        one, two, "k", "about", "known", version_columns=["v"], order_by=["ts", "n", "v"], seen_at="seen", how="inner"
    )
    text = df._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Join" not in text


def null_first(value):
    return (value is not None, value)


def swept_rows(seed, groups, n=400):
    """Sorted rows of a partition as Arrow batches of seven rows, and what each fact must find."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key, seen = rng.choice(groups), rng.randrange(30)
        version = None if rng.random() < 0.5 else {"gone": False, "o0": rng.choice([None, "a", "b"]), "o1": rng.choice([None, 0.5, 2.0]), "v0": i}
        rows.append((key, seen, version is None, version, rng.randrange(30), i))
    rows.sort(key=lambda r: r[:3])
    kind = pa.struct([("gone", pa.bool_()), ("o0", pa.string()), ("o1", pa.float64()), ("v0", pa.int32())])
    columns = [pa.array([r[j] for r in rows]) for j in (0, 1, 4)]
    columns += [pa.array([r[3] for r in rows], kind), pa.array([{"id": r[5]} for r in rows])]
    whole = pa.RecordBatch.from_arrays(columns, ["k", "__seen", "__at", "__change", "__fact"])
    want = []
    for at, (key, _, is_fact, _, about, i) in enumerate(rows):
        able = [(r[4], null_first(r[3]["o0"]), null_first(r[3]["o1"]), place, r[3]["v0"])
                for place, r in enumerate(rows[:at]) if r[0] == key and not r[2] and r[4] <= about]
        if is_fact:
            want.append((i, max(able)[-1] if able else None))
    return [whole.slice(i, 7) for i in range(0, n, 7)], want


@pytest.mark.parametrize("groups", [["a"], ["a", "b", "c"], [f"k{i}" for i in range(100)]])
@pytest.mark.parametrize("at_once", [1, 40, 10_000])
def test_groups_that_go_on_in_later_batches(monkeypatch, groups, at_once):
    monkeypatch.setattr(bitemporal, "_ROWS_AT_ONCE", at_once)
    batches, want = swept_rows(3, groups)
    got = []
    for batch in bitemporal._sweep(["k"], True, False)(iter(batches)):
        assert batch.schema.names == ["k", "__seen", "__at", "__fact", "__found"]
        for fact, found in zip(batch["__fact"].to_pylist(), batch["__found"].to_pylist(), strict=True):
            got.append((fact["id"], found and found["v0"]))
    assert got == want


def test_the_last_index_before_is_found_as_by_a_search():
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 8, 37, 64, 100):
        place = rng.permutation(size * 2)[:size]
        upto, limit = rng.integers(0, size + 1, 300), rng.integers(0, size * 2 + 1, 300)
        want = [max((i for i in range(u) if place[i] < most), default=-1) for u, most in zip(upto, limit, strict=True)]
        assert bitemporal._last_before(place, upto, limit).tolist() == want


def test_a_partition_is_looked_up_as_a_whole():
    n = 400_000
    key, is_fact = np.arange(n) // 13, np.arange(n) % 13 != 0
    change = pa.StructArray.from_arrays(
        [pa.array(np.zeros(n, bool)), pa.array(np.arange(n))], ["gone", "v0"], mask=pa.array(is_fact)
    )
    times = pa.array(np.arange(n) % 13)
    batch = pa.RecordBatch.from_arrays([pa.array(key), times, times, change], ["k", "__seen", "__at", "__change"])
    calls = []
    sys.setprofile(lambda frame, event, arg: calls.append(event))
    try:
        made = list(bitemporal._sweep(["k"], True, True)(batch.slice(i, 10_000) for i in range(0, n, 10_000)))
    finally:
        sys.setprofile(None)
    found = np.concatenate([b["__found"].field("v0").to_numpy() for b in made])
    assert (found == np.flatnonzero(is_fact) // 13 * 13).all() and len(calls) < n / 10


def test_keys_and_times_of_other_types(spark):
    facts = spark.sql("SELECT double(k) AS k, date(d) AS about, date(d) AS known, k AS id FROM VALUES ('NaN', '2024-01-03'), ('1.5', '2024-01-03'), ('NaN', '2024-01-01') t(k, d)")
    changes = spark.sql("SELECT double(k) AS k, timestamp(d) AS ts, timestamp(d) AS seen, 'u' AS operation, decimal(n) AS n, v FROM VALUES ('NaN', '2024-01-02', 1, 'x'), ('NaN', '2024-01-02', 2, 'y'), ('1.5', '2024-01-03', NULL, 'z') t(k, d, n, v)")
    df = bitemporal.bitemporal_join(
        facts, changes, "k", "about", "known", version_columns=["v"], order_by=["ts", "n"], seen_at="seen"
    )
    assert [t for _, t in df.dtypes] == ["double", "date", "date", "string", "string"]
    got = sorted((r.id, str(r.about), str(r.known), r.v) for r in df.collect())
    assert got == [("1.5", "2024-01-03", "2024-01-03", "z"), ("NaN", "2024-01-01", "2024-01-01", None), ("NaN", "2024-01-03", "2024-01-03", "y")]
