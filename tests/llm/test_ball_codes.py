"""Vector codes against plain k-means over all entries."""

import hashlib
import math

import numpy as np
import pytest
from compare import compare, duck
from hypothesis import given, settings
from hypothesis import strategies as st

from strandline.llm import ball_codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=16, entries=64, rounds=2, scale=256):
    """As the contract says it, with Python's whole numbers."""
    kept = []
    for vec_id, vector, label in rows:
        if vector and len(vector) % parts == 0 and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((vec_id, [math.floor(scale * float(np.float32(x))) for x in vector], label))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = len(kept[0][1]) // parts
    cut = [[x[p * width : (p + 1) * width] for p in range(parts)] for _, x, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(p, c[p])[1], []).append(c[p])
            new.append([[sum(x) // len(x) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(books[p])])
        books = new
    found = [[nearest(p, c[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for (_, _, label), e in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return [
        (r[0], "".join(f"{j:02x}" for _, j in f), e, by_label[r[2]], sha) for r, f, e in zip(kept, found, errors)
    ]


def odd_vectors():
    rng = np.random.default_rng(5)
    rows = [(int(i), rng.normal(size=32).astype(np.float32).tolist(), int(rng.integers(3))) for i in rng.permutation(150)]
    rows += [(200 + i, (np.round(rng.normal(size=32) * 2) / 256).tolist(), None) for i in range(60)]  # many ties
    rows += [(300 + i, rows[3][1], 1) for i in range(40)] + [rows[5]] * 3
    rows += [(7, None, 1), (8, [None] + [0.5] * 31, 1), (9, [math.nan] * 32, 2), (10, [math.inf] * 32, 2)]
    rows += [(11, [], 1), (12, [1.0] * 31, 1), (13, [0.25] * 16, 1), (None, [0.5] * 32, None), (None, [-0.5] * 32, 4)]
    rows += [(-5, [-0.001] * 32, 4), (90, [0.75] * 32, 5)]
    return rows


def key(r):
    return (r[0] is None, r[0] or 0, r[1:])


def test_query_equals_plain_rounds(spark, folder):
    rows = odd_vectors()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", code int, parts string").repartition(4)
    got = [tuple(r) for r in ball_codes.op12(spark, folder(embeddings=df)).collect()]
    assert sorted(got, key=key) == sorted(plain(rows), key=key)


def test_query_equals_sql(spark, folder, tmp_path):
    rows = [r for r in odd_vectors() if r[1] is None or len(r[1]) in (0, 32)]
    rows = [r for n, r in enumerate(rows) if r[0] is not None and r[0] not in {x[0] for x in rows[:n]}]
    where = folder(embeddings=spark.createDataFrame(rows, SCHEMA).coalesce(1))
    con = duck("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{where}/embeddings.parquet/*.parquet'")
    ok, message = compare(spark, con, where, "op12", ball_codes.op12, ball_codes.OP12_SQL)
    assert ok, message


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(1, [0.5] * 16, None)], [(1, [0.5] * 32, 0)] * 3])
def test_few_rows(spark, folder, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in ball_codes.op12(spark, folder(embeddings=df)).collect()]
    assert sorted(got, key=key) == sorted(plain(rows), key=key)


def test_too_large_is_an_error(spark, folder):
    df = spark.createDataFrame([(1, [1e30] * 16, 0)], SCHEMA)
    with pytest.raises(Exception, match="beyond"):
        ball_codes.op12(spark, folder(embeddings=df)).collect()


small = st.integers(-6, 6)


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.tuples(small, small), min_size=1, max_size=9),
    st.lists(st.tuples(small, small, st.integers(0, 8)), min_size=1, max_size=30),
)
def test_rings_miss_no_nearer_entry(centres, rows):
    centres = np.array(centres, np.int64)
    points = np.array([r[:2] for r in rows], np.int64)
    own = np.array([r[2] % len(centres) for r in rows], np.int64)
    radii = np.zeros(len(centres), np.int64)
    np.maximum.at(radii, own, ball_codes.squared(points - centres[own]))
    best, least, _ = ball_codes.Balls(centres, radii).moved(points, own)
    want, distance = ball_codes.Balls(centres).nearest(points)
    assert best.tolist() == want.tolist() and least.tolist() == distance.tolist()


def test_cores_and_rings_save_distances():
    rng = np.random.default_rng(2)
    centres = rng.integers(-2000, 2000, size=(64, 4))
    own = rng.integers(0, 64, size=20_000)
    points = centres[own] + rng.integers(-300, 300, size=(20_000, 4))
    book = ball_codes.Balls(centres)
    _, _, made = book.moved(points, own)
    assert made < 0.1 * 64 * len(points)
