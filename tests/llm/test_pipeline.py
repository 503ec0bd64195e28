"""The pipeline against a twin without Spark, and the package's place in the repository."""

import hashlib
import os
import re
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
from conftest import plain, words_of
from test_duplicates import exact_twin, near_twin
from test_mixing import filled

from strandline.llm import bpe, fertility, queries

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def kept_twin(rows):
    path = public_tokenizers.path(fertility.VOCABULARY)
    found = fertility.measured(pa.record_batch({"text": pa.array([r[1] for r in rows], pa.string())}), path)
    return [r for r, kept in zip(rows, fertility.judged(found)[1], strict=True) if kept]


def exact_kept(rows):
    left = Counter((i, h) for i, _, _, kept, h in exact_twin(rows) if kept)
    out = []
    for r in rows:
        place = (r[0], hashlib.sha256(plain(r[1])).hexdigest())
        if left[place]:
            left[place] -= 1
            out.append(r)
    return out


def near_kept(rows):
    """One row of each component; which of those sharing an id and component is free."""
    first = {}
    for row, (_, _, component) in zip(rows, near_twin(rows), strict=True):
        if row[0] == component:
            first.setdefault(component, row)
    return list(first.values())


def mixed_twin(rows):
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(words_of(r[1]))
    budget = sum(sizes.values())
    target = filled(sizes, budget)
    queue, upto = [], Counter()
    place = lambda r: (hashlib.md5(f"mix:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[0])
    for r in sorted(rows, key=place):
        n = len(words_of(r[1]))
        upto[r[3]] += n
        for epoch in range(3):
            if n:
                queue.append(((epoch * sizes[r[3]] + upto[r[3]]) / target[r[3]], *place(r), epoch, n, r))
    out, used = [], 0
    for *_, n, r in sorted(queue, key=lambda x: x[:4]):
        used += n
        if used > budget:
            break
        out.append(r)
    return out


def test_run(spark, odd_rows, folder):
    # Texts of their own ids, so that the near-duplicate stage has one answer.
    seen, rows = set(), []
    for r in odd_rows:
        if r[0] is not None and r[0] not in seen:
            seen.add(r[0])
            rows.append(r)
    rng = np.random.default_rng(4)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    for i in range(2000, 2060):
        text = " ".join("".join(rng.choice(letters, rng.integers(2, 8))) for _ in range(rng.integers(60, 200)))
        rows.append((i, text, "en", str(rng.choice(["p", "q", "hot", "hot"])), len(text)))
        if i % 6 == 0:
            rows.append((i + 500, text.upper(), "en", "q", len(text)))
        if i % 7 == 0:
            rows.append((i + 1000, text + " end", "en", "p", len(text)))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    where = folder(documents=spark.createDataFrame(rows, schema).repartition(4))
    want = mixed_twin(near_kept(exact_kept(kept_twin(rows))))
    codec = bpe.Codec(public_tokenizers.path(bpe.RANKS), public_tokenizers.PATTERN)
    expected = []
    for r in want:
        ids = codec.short.encode_ordinary(r[1])
        packed = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        expected.append((r[0], len(ids), packed, hashlib.sha256(r[1].encode()).hexdigest()))
    got = corpus_pipeline.run(spark, where).collect()
    assert len(expected) > 30
    assert Counter(tuple(r) for r in got) == Counter(expected)


def test_stages_keep_columns_and_take_empty_tables(spark, clashing, empty):
    for given in (clashing, empty):
        docs = given
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, "")
            assert docs.schema == given.schema
        corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()


def test_stage_names_and_queries():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "exact_dedup", "simhash_near_dedup", "source_mixing", "bpe_round_trip"]
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in queries.QUERIES) == 1
    assert set(queries.ORACLES) <= set(queries.QUERIES)


def test_nothing_else_imports_the_package():
    for top in ("strandline", "registry", "tests"):
        for where, _, names in os.walk(os.path.join(ROOT, top)):
            if "/llm" in where:
                continue
            for name in names:
                if name.endswith(".py"):
                    with open(os.path.join(where, name)) as file:
                        assert not re.search(r"strandline\.llm|corpus_pipeline", file.read()), name
