import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strandline.operators import asof, history
from strandline.operators.skew import find_hot_keys

ORDER = ("at", "partition", "offset")


def moment(second):
    return dt.datetime(2026, 1, 1) + dt.timedelta(seconds=second)


def changes(spark, rows):
    """rows: (key, second, operation, offset, value)"""
    return spark.createDataFrame(
        [(k, moment(s), op, 0, off, v) for k, s, op, off, v in rows],
        "key long, at timestamp, operation string, partition int, offset long, value string",
    )


def versions(df, **options):
    out = history.history(df, "key", ORDER, **options).orderBy("key", "at", "offset").collect()
    return [
        (
            r.key,
            r.value,
            int((r.valid_from - moment(0)).total_seconds()),
            None if r.valid_to is None else int((r.valid_to - moment(0)).total_seconds()),
            r.is_current,
        )
        for r in out
    ]


LOG = [(1, 0, "c", 0, "a"), (1, 5, "u", 3, "b"), (1, 9, "u", 4, "c"), (2, 1, "r", 1, "x")]
FOLDED = [
    (1, "a", 0, 5, False),
    (1, "b", 5, 9, False),
    (1, "c", 9, None, True),
    (2, "x", 1, None, True),
]


def test_two_updates_in_one_batch_make_three_chained_versions(spark):
    assert versions(changes(spark, LOG)) == FOLDED


def test_order_of_arrival_does_not_matter(spark):
    assert versions(changes(spark, LOG[::-1])) == FOLDED


def test_the_whole_log_twice_gives_the_same_history(spark):
    twice = changes(spark, LOG).unionByName(changes(spark, LOG))
    once = history.drop_redelivered(twice, ["key", "at", "operation", "value"], ORDER)
    assert versions(once) == FOLDED


def test_a_copy_under_a_new_offset_is_one_version(spark):
    copies = LOG + [(1, 5, "u", 70, "b"), (1, 5, "u", 71, "b")]
    once = history.drop_redelivered(
        changes(spark, copies), ["key", "at", "operation", "value"], ORDER
    )
    assert versions(once) == FOLDED
    assert {r.offset for r in once.collect()} == {0, 1, 3, 4}


@pytest.mark.parametrize("crowded", [False, True])
def test_copies_dropped_by_key_share_the_shuffle_of_the_fold(spark, monkeypatch, crowded):
    rows = [(k, s % 7, "cu"[s > 2], s * 10 + c, f"v{s % 3}") for k in (1, 2, None) for s in range(9) for c in range(3)]
    # A row whose value is NULL is no copy of the others; a row without a key may have copies.
    df = changes(spark, [*rows, (1, 3, "u", 5, None), (1, 3, "u", 6, None), (None, 3, "u", 7, None)])
    log = df.select(F.col("key").cast("string").alias("key"))
    identity = ["key", "at", "operation", "value"]
    monkeypatch.setattr(history, "crowded", lambda log: crowded)
    once = history.drop_redelivered(df, identity, ORDER, key="key", log=log)
    plain = history.drop_redelivered(df, identity, ORDER)
    names = df.columns
    read = lambda df: sorted(df.select(*names).collect(), key=str)
    assert read(once) == read(plain) and len(read(plain)) < df.count()
    folded = history.history(once, "key", ORDER, log=None if crowded else log)
    wanted = history.history(plain, "key", ORDER, hot=None)
    shuffled = folded._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert shuffled == (2 if crowded else 1)
    assert folded.columns == wanted.columns
    assert sorted(folded.collect(), key=str) == sorted(wanted.collect(), key=str)


def test_a_key_to_drop_copies_by_must_be_in_the_identity(spark):
    with pytest.raises(ValueError, match="identity"):
        history.drop_redelivered(changes(spark, LOG), ["at", "value"], ORDER, key="key", log=changes(spark, LOG))


def test_insert_and_update_at_the_same_moment(spark):
    got = versions(changes(spark, [(1, 7, "c", 0, "a"), (1, 7, "u", 1, "b")]))
    assert got == [(1, "a", 7, 7, False), (1, "b", 7, None, True)]


def test_update_without_insert_is_current(spark):
    assert versions(changes(spark, [(5, 2, "u", 0, "z")])) == [(5, "z", 2, None, True)]


def test_delete_closes_or_is_ignored(spark):
    rows = [(1, 0, "c", 0, "a"), (1, 4, "d", 1, None), (1, 8, "c", 2, "again")]
    assert versions(changes(spark, rows)) == [(1, "a", 0, 4, False), (1, "again", 8, None, True)]
    assert versions(changes(spark, rows[:2])) == [(1, "a", 0, 4, False)]
    assert versions(changes(spark, rows[:2]), deletes="ignore") == [(1, "a", 0, None, True)]


def test_rows_without_a_key_are_versions_of_their_own(spark):
    rows = [(None, 0, "c", 0, "a"), (None, 1, "c", 1, "b")]
    got = versions(changes(spark, rows))
    assert sorted(got, key=str) == [(None, "a", 0, None, True), (None, "b", 1, None, True)]
    assert history.current_from_log(changes(spark, rows), "key", ORDER).count() == 2


def test_only_changed_values_open_a_version(spark):
    rows = [
        (1, 0, "c", 0, "a"),
        (1, 1, "u", 1, "a"),
        (1, 2, "u", 2, "b"),
        (1, 3, "d", 3, None),
        (1, 4, "c", 4, "b"),
    ]
    got = versions(changes(spark, rows), changed_columns=["value"])
    assert got == [(1, "a", 0, 2, False), (1, "b", 2, 3, False), (1, "b", 4, None, True)]


def test_current_from_log_agrees_with_the_history(spark):
    rows = random_log(400, 13)
    df = changes(spark, rows)
    whole = history.current(history.history(df, "key", ORDER)).select("key", "value", "offset")
    direct = history.current_from_log(df, "key", ORDER).select("key", "value", "offset")
    assert sorted(whole.collect()) == sorted(direct.collect())


def test_summary_and_sample(spark):
    folded = history.history(changes(spark, LOG), "key", ORDER)
    row = history.summary(folded).first()
    assert (row.total_rows, row.current_rows, row.historical_rows) == (4, 2, 2)
    assert float(row.correction_rate_pct) == 100.0
    sample = history.history_sample(folded, "key", ("offset",)).collect()
    assert [(r.key, r.value) for r in sample] == [(1, "a"), (1, "b"), (1, "c")]


def test_summary_of_nothing_current(spark):
    row = history.summary(history.history(changes(spark, LOG), "key", ORDER).where("false")).first()
    assert (row.total_rows, row.correction_rate_pct) == (0, None)


def test_as_of_is_half_open(spark):
    folded = history.history(changes(spark, LOG), "key", ORDER)
    at = lambda s: sorted(r.value for r in history.as_of(folded, moment(s)).collect())
    assert at(4) == ["a", "x"]
    assert at(5) == ["b", "x"]
    assert at(0) == ["a"]
    assert at(100) == ["c", "x"]


def test_as_known_at_forgets_later_arrivals(spark):
    df = changes(spark, LOG).withColumn(
        "ingested_at", F.when(F.col("offset") == 3, F.lit(moment(50))).otherwise(F.col("at"))
    )
    known = history.as_known_at(df, moment(20), "key", ORDER)
    got = sorted((r.key, r.value, r.is_current) for r in known.collect())
    assert got == [(1, "a", False), (1, "c", True), (2, "x", True)]


# --- crowded keys -----------------------------------------------------------------


def random_log(size, seed, crowded=None):
    rng = random.Random(seed)
    rows = []
    for offset in range(size):
        key = 1 if crowded and rng.random() < crowded else rng.randrange(2, 40)
        op = rng.choice("cuuuud")
        rows.append((key, rng.randrange(size), op, offset, rng.choice("abc")))
    return rows


def python_fold(rows, only_changed=False):
    result, by_key = [], {}
    for row in sorted(rows, key=lambda r: (r[1], r[3])):
        by_key.setdefault(row[0], []).append(row)
    for key, events in by_key.items():
        if only_changed:
            events = [
                e
                for i, e in enumerate(events)
                if i == 0 or (events[i - 1][2] == "d", events[i - 1][4]) != (e[2] == "d", e[4])
            ]
        for i, e in enumerate(events):
            if e[2] == "d":
                continue
            end = events[i + 1][1] if i + 1 < len(events) else None
            result.append((key, e[4], e[1], end, end is None, e[3]))
    return sorted(result, key=str)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("only_changed", [False, True])
def test_sliced_keys_give_the_same_history(spark, seed, only_changed):
    rows = random_log(1500, seed, crowded=0.4)
    df = changes(spark, rows)
    hot = find_hot_keys(df, ["key"], "at", rows_per_slice=20)
    assert hot.cuts is not None
    options = {"changed_columns": ["value"]} if only_changed else {}
    out = history.history(df, "key", ORDER, hot=hot, **options).collect()
    got = sorted(
        (
            (
                r.key,
                r.value,
                int((r.valid_from - moment(0)).total_seconds()),
                None if r.valid_to is None else int((r.valid_to - moment(0)).total_seconds()),
                r.is_current,
                r.offset,
            )
            for r in out
        ),
        key=str,
    )
    assert got == python_fold(rows, only_changed)


def test_slices_bound_the_rows_per_task(spark):
    from strandline.operators.skew import SLICE, with_slices

    df = changes(spark, random_log(4000, 7, crowded=0.5))
    hot = find_hot_keys(df, ["key"], "at", rows_per_slice=100)
    sliced = with_slices(df, ["key"], ORDER, hot)
    largest = sliced.groupBy("key", SLICE).count().agg(F.max("count")).first()[0]
    assert largest <= 200  # one slice, give or take the sketch's rounding


def test_rows_of_one_moment_are_cut_up_too(spark):
    from strandline.operators.skew import SLICE, with_slices

    df = spark.range(20_000).selectExpr("1L AS key", "TIMESTAMP '2026-01-01 00:00:00' AS at", "id AS offset")
    hot = find_hot_keys(df, ["key"], ["at", "offset"], rows_per_slice=1000)
    sliced = with_slices(df, ["key"], ["at", "offset"], hot)
    sizes = [r["count"] for r in sliced.groupBy(SLICE).count().collect()]
    assert len(sizes) >= 18 and max(sizes) <= 2000
    versions = history.history(df, "key", ("at", "offset"), operation=None, hot=hot)
    assert versions.where("is_current").collect()[0]["offset"] == 19_999
    assert versions.where("valid_to IS NOT NULL").count() == 19_999


def test_cold_tables_are_not_sliced(spark):
    df = changes(spark, random_log(500, 3))
    assert find_hot_keys(df, ["key"], "at").cuts is None


def test_message_keys_are_asked_first(spark):
    df = changes(spark, random_log(600, 3, crowded=0.5))
    calm = df.withColumn("key", F.col("offset").cast("string"))
    assert find_hot_keys(df, ["key"], "at", 50, log=calm).cuts is None
    crowded = df.withColumn("key", F.col("key").cast("string"))
    assert find_hot_keys(df, ["key"], "at", 50, log=crowded).cuts is not None


# --- as-of join -------------------------------------------------------------------


@pytest.mark.parametrize("slice_rows", [None, 15])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_asof_join_against_brute_force(spark, slice_rows, how):
    rng = random.Random(5)
    log = random_log(600, 11, crowded=0.4)
    folded = python_fold(log)
    facts = [
        (i, rng.choice([1, 1, 1, rng.randrange(2, 45)]), rng.randrange(-5, 620)) for i in range(900)
    ]
    expected = []
    for fact, key, second in facts:
        match = [
            v
            for v in folded
            if v[0] == key and v[2] <= second and (v[3] is None or v[3] > second)
        ]
        assert len(match) <= 1
        if match or how == "left":
            expected.append((fact, key, match[0][5] if match else None))
    fact_df = spark.createDataFrame(
        [(i, k, moment(s)) for i, k, s in facts], "fact long, key long, happened timestamp"
    )
    version_df = history.history(changes(spark, log), "key", ORDER).withColumnRenamed("offset", "version")
    hot = None
    if slice_rows:
        stacked = fact_df.select("key", F.col("happened").alias("__at")).unionByName(
            version_df.select("key", F.col("valid_from").alias("__at"))
        )
        hot = find_hot_keys(stacked, ["key"], "__at", rows_per_slice=slice_rows)
        assert hot.cuts is not None
    joined = asof.asof_join(
        fact_df,
        version_df,
        "key",
        "happened",
        version_columns=["version"],
        version_order=["version"],
        how=how,
        hot=hot,
    )
    got = sorted(((r.fact, r.key, r.version) for r in joined.collect()), key=str)
    assert got == sorted(expected, key=str)


@pytest.mark.parametrize("flip", [False, True])
def test_asof_join_prefers_the_version_that_lasts(spark, flip):
    rows = [(1, moment(5), moment(5), "old"), (1, moment(5), None, "new")]
    versions = spark.createDataFrame(
        rows[::-1] if flip else rows, "key long, valid_from timestamp, valid_to timestamp, value string"
    ).coalesce(1)
    facts = spark.createDataFrame([(1, moment(5)), (1, moment(9))], "key long, happened timestamp")
    joined = asof.asof_join(facts, versions, "key", "happened", version_columns=["value"])
    assert [r.value for r in joined.collect()] == ["new", "new"]


# --- kept history -----------------------------------------------------------------


def test_kept_history_reads_only_the_buckets_it_touches(spark, tmp_path):
    import shutil

    from strandline.operators import kept

    rows = random_log(400, 2)
    df = changes(spark, rows)
    root = str(tmp_path / "kept")
    first = df.where("offset % 3 != 1")
    kept.apply_batch(first, root, "key", ORDER, buckets=8)
    kept.apply_batch(first.where("offset % 2 = 0"), root, "key", ORDER, buckets=8)  # again: no change
    kept.apply_batch(df.where("offset % 3 = 1"), root, "key", ORDER, buckets=8)
    columns = ["key", "offset", "valid_from", "valid_to", "is_current"]
    want = sorted(map(str, history.history(df, "key", ORDER).select(*columns).collect()))
    assert sorted(map(str, kept.kept_history(spark, root).select(*columns).collect())) == want

    one = df.where("key = 3").limit(1).withColumn("offset", F.lit(10_000).cast("long"))
    bucket = one.select(F.pmod(F.xxhash64("key"), F.lit(8))).first()[0]
    others = [f for b, f in kept.folders(spark, root).items() if b != bucket]
    for folder in others:  # unreadable from here on
        shutil.move(folder, folder + "-away")
    kept.apply_batch(one, root, "key", ORDER, buckets=8)
    for folder in others:
        shutil.move(folder + "-away", folder)
    assert kept.kept_history(spark, root).count() >= len(want)


def test_asof_join_refuses_ambiguous_columns(spark):
    facts = spark.createDataFrame([(1, moment(0), "a")], "key long, happened timestamp, value string")
    folded = history.history(changes(spark, LOG), "key", ORDER)
    with pytest.raises(ValueError):
        asof.asof_join(facts, folded, "key", "happened", version_columns=["value"])
