"""Exact, near and line duplicates against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from conftest import plain
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandline.llm import exact_dedup, line_dedup, simhash

# --- counting quotient filters ----------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=60), st.lists(st.integers(0, 2**64 - 1), max_size=60))
def test_filters_keep_all_and_merge(a, b):
    skip, quotient = 6, 8
    top = (1 << (64 - skip)) - 1
    a, b = ([(5 << (64 - skip)) | (x & top) for x in xs] + [5 << (64 - skip)] for xs in (a, b))
    merged = Counter()
    parts = []
    for xs in (a, b):
        packed = exact_dedup.build(np.array(xs, np.uint64), np.ones(len(xs), np.uint64), quotient, skip)
        prints, counts = exact_dedup.contents(packed, 5, quotient, skip)
        assert dict(zip(prints.tolist(), counts.tolist(), strict=True)) == Counter(xs)
        assert (np.diff(prints.astype(object)) > 0).all()
        merged += Counter(xs)
        parts.append((prints, counts))
    packed = exact_dedup.build(*(np.concatenate(x) for x in zip(*parts, strict=True)), quotient, skip)
    prints, counts = exact_dedup.contents(packed, 5, quotient, skip)
    assert dict(zip(prints.tolist(), counts.tolist(), strict=True)) == merged


def test_filters_follow_their_content():
    """What a task gathers, for ever more documents: never much more than the fingerprints."""
    rng = np.random.default_rng(1)
    every = np.sort(rng.integers(0, 2**64, 200_000, np.uint64))
    for rows in (10**5, 10**7, 10**9, 5 * 10**10):
        skip, quotient = exact_dedup.geometry(rows)
        # As many ranges meet a task's fingerprints as a million of them would fill.
        part = every[: len(every) // 5] if rows > 10**9 else every
        prefixes = part >> np.uint64(64 - skip)
        cuts = np.flatnonzero(np.r_[True, prefixes[1:] != prefixes[:-1]])
        per_range = max(1, exact_dedup.FILTER_ROWS >> skip)
        sample = np.split(part, cuts[1:])[:200]
        sample = [np.unique(np.r_[s, s[0] + np.arange(max(0, per_range - len(s)), dtype=np.uint64)]) for s in sample]
        held = sum(len(s) for s in sample)
        size = sum(len(exact_dedup.build(s, np.ones(len(s), np.uint64), quotient, skip)) for s in sample)
        assert size <= 2 * 8 * held


def exact_twin(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(plain(text), []).append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        stays = 1
        for i in ids:
            kept = i == keep and stays > 0
            stays -= kept
            out.append((i, keep, len(ids), bool(kept), hashlib.sha256(text).hexdigest()))
    return out


def test_exact(spark, odd, odd_rows, folder):
    got = [tuple(r) for r in exact_dedup.op10(spark, folder(documents=odd)).collect()]
    assert Counter(got) == Counter(exact_twin(odd_rows))


def test_a_shared_fingerprint_is_told_apart_by_bytes(spark, monkeypatch):
    """With fingerprints of two bits most texts meet; groups must not change."""

    rows = [(i, "x" * (i % 7) + ("Ab" if i % 2 else "aB")) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    real = exact_dedup.normal

    def normal(docs, columns, with_text):
        from pyspark.sql import functions as F

        return real(docs, columns, with_text).withColumn(
            "print", F.lit(7).cast("long")
        )

    monkeypatch.setattr(exact_dedup, "normal", normal)
    from pyspark.sql import functions as F

    got = exact_dedup.groups(spark, docs.withColumn("row", F.monotonically_increasing_id())).drop("row")
    assert Counter(tuple(r) for r in got.collect()) == Counter(exact_twin(rows))


def test_exact_stage(spark, clashing, odd_rows):
    got = exact_dedup.deduplicated(spark, clashing)
    assert got.schema == clashing.schema
    want = Counter((i, h) for i, _, _, kept, h in exact_twin(odd_rows) if kept)
    assert Counter((r.doc_id, hashlib.sha256(plain(r.text)).hexdigest()) for r in got.collect()) == want


# --- SimHash ----------------------------------------------------------------


def print_twin(text):
    words = plain(text).split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def near_roots(rows, radius=4):
    prints = [print_twin(r[1]) for r in rows]
    n = len(rows)
    pairs = [(i, j) for i in range(n) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= radius]
    return prints, roots(n, pairs)


def near_twin(rows):
    prints, root = near_roots(rows)
    least = {}
    for r, row in zip(root, rows, strict=True):
        if row[0] is not None:
            least[r] = min(least.get(r, row[0]), row[0])
    return [(row[0], f"{p:016x}", least.get(r)) for row, p, r in zip(rows, prints, root, strict=True)]


def test_simhash(spark, odd, odd_rows, folder):
    got = [tuple(r) for r in simhash.op7(spark, folder(documents=odd)).collect()]
    want = near_twin(odd_rows)
    assert Counter(got) == Counter(want)


def test_simhash_stage(spark, clashing, odd_rows):
    got = simhash.deduplicated(spark, clashing)
    assert got.schema == clashing.schema
    stays = Counter(r.doc_id for r in got.collect())
    want = Counter(c for _, c in {(r, t[2]) for r, t in zip(near_roots(odd_rows)[1], near_twin(odd_rows))})
    assert stays == want


@pytest.mark.parametrize("radius", [0, 1, 4, 7])
def test_bit_sliced_comparison(radius):
    rng = np.random.default_rng(radius)
    for _ in range(12):
        n = int(rng.integers(2, 400))
        prints = rng.integers(0, 2**63, 6, dtype=np.uint64)[rng.integers(0, 6, n)]
        for i in range(n):
            for b in rng.integers(0, 64, rng.integers(0, 5)):
                prints[i] ^= np.uint64(1) << np.uint64(b)
        bucket = rng.integers(0, int(rng.integers(1, 5)), n)
        order = np.lexsort((prints, bucket, -np.bincount(bucket)[bucket]))
        prints, bucket = prints[order], bucket[order]
        pairs = [
            (i, j)
            for i in range(n)
            for j in range(i)
            if bucket[i] == bucket[j] and int(prints[i] ^ prints[j]).bit_count() <= radius
        ]
        assert simhash.linked(prints, bucket, radius).tolist() == roots(n, pairs)


@pytest.mark.parametrize("radius,rows", [(4, 10), (4, 10**7), (4, 10**10), (2, 10**6)])
def test_tables_miss_no_pair(radius, rows):
    tables = simhash.tables_for(rows, radius)
    rng = np.random.default_rng(0)
    for _ in range(300):
        flips = sum(1 << int(b) for b in rng.choice(64, radius, replace=False))
        assert any(not flips & mask for mask in tables)


def test_crowded_buckets_are_cut_into_tiles(spark, monkeypatch):
    """Many prints around few centres, so that every table has crowded buckets."""
    monkeypatch.setattr(simhash, "TILE_ROWS", 40)
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**62, 3)
    prints = []
    for _ in range(500):
        p = int(centres[rng.integers(0, 3)])
        for b in rng.choice(20, rng.integers(0, 6), replace=False):
            p ^= 1 << int(b)
        prints.append(p)
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(prints)], "doc_id long, print long")
    found = {r["print"]: r.component_id for r in simhash.components(spark, rows).collect()}
    pairs = [(i, j) for i in range(500) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    assert [found[p] for p in prints] == roots(500, pairs)


def test_long_chains_become_one_component(spark):
    edges = [(i + 1, i) for i in range(300) if i % 50 != 49]
    got = simhash.stars(spark, spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(tuple(r) for r in got) == [(i, i // 50 * 50) for i in range(300) if i % 50]


# --- lines ------------------------------------------------------------------


def line_twin(rows, least=20, docs=3):
    def key(line):
        return line.strip(b" \t\n\x0b\x0c\r").lower()

    holders, keep = Counter(), {}
    for doc_id, text, *_ in rows:
        for k in {key(x) for x in (text or "").encode().split(b"\n")}:
            holders[k] += 1
            own = -(2**63) if doc_id is None else doc_id
            keep[k] = max(keep.get(k, own), own)
    out = []
    for doc_id, text, *_ in rows:
        own = -(2**63) if doc_id is None else doc_id
        lines = (text or "").encode().split(b"\n")
        kept = [
            x for x in lines
            if len(key(x).decode()) < least or holders[key(x)] < docs or keep[key(x)] == own
        ]
        rest = b"\n".join(kept)
        out.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256(rest).hexdigest()))
    return out


def test_lines(spark, odd, odd_rows, folder):
    got = [tuple(r) for r in line_dedup.op4(spark, folder(documents=odd)).collect()]
    want = line_twin(odd_rows)
    assert sum(r[2] for r in want) > 5
    assert Counter(got) == Counter(want)


def test_line_texts(spark, odd, odd_rows):
    got = Counter((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in line_dedup.deduplicated(odd).collect())
    assert got == Counter((r[0], r[3]) for r in line_twin(odd_rows))


def test_a_line_in_all_batches_is_merged_in_lots(spark, monkeypatch):
    rows = [(i, f"a line that every single document holds\na line of number {i // 3} and others") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(line_dedup, "BATCH_TEXT", 500)
    monkeypatch.setattr(line_dedup, "LOT_BYTES", 1_024)
    monkeypatch.setattr(line_dedup, "FEW_BATCHES", 40)
    batches = spark.createDataFrame([(b, b % 3) for b in range(90)], "batch long, shard long")
    entry = np.zeros(4, line_dedup.ENTRY).tobytes()
    lists, lots = line_dedup.in_lots(batches.withColumn("entries", F.lit(bytearray(entry))))
    assert {r.lots for r in lots.collect()} == {4} and {r.lot for r in lists.collect()} == {0, 1, 2, 3}
    got = line_dedup.deduplicated(docs).collect()
    want = [r[:3] for r in line_twin(rows)]
    assert Counter((r.doc_id, r.n_lines, r.n_dropped) for r in got) == Counter(want)


def test_many_equal_rows(spark, monkeypatch):
    rows = [(1, "one line that is long enough\nand one more that is long enough"), (None, None)]
    docs = spark.range(100_000).select(F.lit(rows[0][0]).cast("long").alias("doc_id"), F.lit(rows[0][1]).alias("text"))
    nulls = spark.range(2_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    other = spark.createDataFrame([(0, rows[0][1])], "doc_id long, text string")
    every = docs.unionByName(nulls).unionByName(other)
    collapsed, _, crowded = line_dedup.collapsed(every)
    assert crowded and sorted(r.copies for r in collapsed.collect()) == [1, 2_000, 100_000]
    monkeypatch.setattr(line_dedup, "SPREAD_ROWS", 30_000)
    got = line_dedup.deduplicated(every).groupBy("doc_id", "n_lines", "n_dropped", "text").count()
    want = {(1, 2, 0, rows[0][1], 100_000), (None, 1, 0, "", 2_000), (0, 2, 2, "", 1)}
    assert {tuple(r) for r in got.collect()} == want


def test_lines_with_clashing_columns(spark, clashing, odd_rows, folder, monkeypatch):
    monkeypatch.setattr(line_dedup, "EQUAL_ROWS", 1)
    monkeypatch.setattr(line_dedup, "FEW_BATCHES", 0)
    got = [tuple(r) for r in line_dedup.op4(spark, folder(documents=clashing)).collect()]
    assert Counter(got) == Counter(line_twin(odd_rows))


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 5000])
def test_minimal_perfect_hash(n):
    rng = np.random.default_rng(n)
    entries = np.zeros(n, line_dedup.ENTRY)
    entries["lo"], entries["hi"] = rng.integers(0, 2**63, (2, n), dtype=np.uint64)
    entries["lo"][: n // 3] = 9  # equal halves must not matter
    entries["docs"], entries["keep"] = rng.integers(1, 9, n), rng.integers(-5, 5, n)
    index = line_dedup.LineIndex.unpack(line_dedup.LineIndex.build(entries).pack())
    slot = index.probe(entries["lo"], entries["hi"])
    assert sorted(slot.tolist()) == list(range(n))
    assert (index.docs[slot] == entries["docs"]).all() and (index.keep[slot] == entries["keep"]).all()
    others = rng.integers(0, 2**63, (2, 1000), dtype=np.uint64)
    assert (index.probe(*others) == -1).all()


def test_empty(spark, empty, folder):
    where = folder(documents=empty)
    for query in (exact_dedup.op10, simhash.op7, line_dedup.op4):
        assert query(spark, where).collect() == []
    assert exact_dedup.deduplicated(spark, empty).collect() == []
    assert simhash.deduplicated(spark, empty).collect() == []
