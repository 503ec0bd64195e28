"""The manifest against a tree built in plain Python."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from compare import compare, duck

from strandline.llm import merkle


def h(x):
    return hashlib.sha256(x.encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def lowered(text):
    return text if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def up(nodes):
    """(root, for each node its list of (left, right))."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for i, a in enumerate(at):
            run = level[a - a % 16 : a - a % 16 + 16]
            paths[i].append(("".join(run[: a % 16]), "".join(run[a % 16 + 1 :])))
        at = [a // 16 for a in at]
        level = [h("".join(level[i : i + 16])) for i in range(0, len(level), 16)]
    return level[0], paths


def plain(rows):
    leaves = []
    for doc_id, text, lang, source, n in rows:
        head = field(doc_id) + field(source) + field(lang) + field(n)
        leaf = h(head + field(text))
        bad = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        leaves.append((source, doc_id, leaf, h(head + field(lowered(text))) if bad else leaf))
    if not leaves:
        return []
    sources = sorted({x[0] for x in leaves}, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: sorted((x for x in leaves if x[0] == s), key=lambda x: (x[1] is not None, x[1] or 0, x[2])) for s in sources}
    trees = {s: up([x[2] for x in own[s]]) for s in sources}
    root, over = up([trees[s][0] for s in sources])
    out = []
    for s, above in zip(sources, over):
        subroot, paths = trees[s]
        for (_, doc_id, leaf, changed), path in zip(own[s], paths):
            fold = changed
            for a, b in path + above:
                fold = h(a + fold + b)
            proof = h("".join(a + b for a, b in path + above))
            out.append((doc_id, leaf, subroot, root, proof, fold, fold == root))
    return out


def key(r):
    return (r[0] is not None, r[0] or 0, r[1:])


def answer(spark, folder, df):
    return sorted((tuple(r) for r in merkle.op13(spark, folder(documents=df)).collect()), key=key)


def test_odd_rows(spark, odd, odd_rows, folder):
    assert answer(spark, folder, odd) == sorted(plain(odd_rows), key=key)


def test_many_rows(spark, folder):
    rng = random.Random(4)
    ids = rng.sample(range(-40_000, 40_000), 1200)
    rows = [(i, rng.choice(["Ab c", "x", None, ""]), None, rng.choice(["hot"] * 9 + [f"s{n}" for n in range(40)]), 3) for i in ids]
    rows += [(None, f"t{i % 50}", "en", "hot", 1) for i in range(300)]  # a crowded id
    rows += [rows[0]] * 100 + [(2**62, "A", None, None, 1), (-(2**62), "B", None, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = answer(spark, folder, df.repartition(6))
    assert got == sorted(plain(rows), key=key)
    assert {r[-1] for r in got} == {True, False}


def test_several_blocks(spark, folder):
    rows = [(i * 5, "B" if i % 3 else "b", None, "big" if i % 30 else "small", 1) for i in range(4600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert answer(spark, folder, df) == sorted(plain(rows), key=key)


def test_without_broadcasts(spark, clashing, odd_rows, folder, monkeypatch):
    from strandline.llm import common

    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    assert answer(spark, folder, clashing) == sorted(plain(odd_rows), key=key)


@pytest.mark.parametrize("n", [0, 1, 16, 17])
def test_few_rows(spark, folder, n):
    rows = [(i, "A", None, "s", 1) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert answer(spark, folder, df) == sorted(plain(rows), key=key)


def test_query_equals_sql(spark, odd, folder):
    where = folder(documents=odd.coalesce(1))
    con = duck("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{where}/documents.parquet/*.parquet'")
    ok, message = compare(spark, con, where, "op13", merkle.op13, merkle.OP13_SQL)
    assert ok, message


def test_proofs_as_rows(spark, odd):
    rows = merkle.manifest(spark, odd).rows(digest=False).collect()
    assert all(merkle.folded(r.leaf, [(x.l, x.r) for x in r.proof]) == r.root and r.verified for r in rows)


@pytest.mark.parametrize("n", [0, 1, 200, 255, 256, 700, 4096])
def test_ranks_of_containers(n):
    rng = np.random.default_rng(n)
    low = np.sort(rng.choice(4096, n, replace=False))
    counts = np.where(rng.random(n) < 0.1, rng.integers(2, 9, n), 1)
    payload = merkle.pack(low, counts)
    assert [x.tolist() for x in merkle.unpack(payload)] == [low.tolist(), counts.tolist()]
    wanted = rng.integers(0, 4096, 500)
    assert merkle.ranks(payload, wanted).tolist() == [int(counts[low < w].sum()) for w in wanted]
