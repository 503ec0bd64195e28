"""Quality rules, the quality model and language-model scores."""

import math
import os
import zlib
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal
from math import log10

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from conftest import plain, words_of

from strandline.llm import fertility, lm_score, quality_model


def remainder(doc_id, by):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % by


# --- quality rules ----------------------------------------------------------


def rules_twin(text):
    words = words_of(text)
    windows = list(zip(words, words[1:], words[2:]))
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").encode().split(b"\n") if x.split()]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words),
        sum(len(w.decode()) for w in words),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
        failed,
    )


def test_rules(spark, odd, odd_rows, folder):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = fertility.op9(spark, folder(documents=odd)).collect()
    assert Counter((r.doc_id, *(r[n] for n in names)) for r in got) == Counter(
        (r[0], *rules_twin(r[1])) for r in odd_rows
    )
    assert not any(r.kept and r.base_failed for r in got)

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(fertility.VOCABULARY))
    ids_seen = Counter(r[0] for r in odd_rows)
    texts = {r[0]: r[1] for r in odd_rows if ids_seen[r[0]] == 1}
    for r in got:
        if r.doc_id in texts:
            ids = [i for w in words_of(texts[r.doc_id]) for i in model.encode(w.decode())]
            share = np.array(list(Counter(ids).values())) / max(1, len(ids))
            assert r.n_tokens == len(ids)
            assert r.byte_share == pytest.approx(sum(map(model.is_byte, ids)) / max(1, len(ids)))
            assert r.token_entropy == pytest.approx(-(share * np.log2(share)).sum() if ids else 0.0)


def test_bands_reject_by_script(spark):
    rng = np.random.default_rng(0)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    good = " ".join("".join(rng.choice(letters, rng.integers(2, 9))) for _ in range(300))
    bad = " ".join(f"{w}***" for w in rng.choice(good.split()[:12], 300))
    spelled = " ".join("".join(chr(0x1F300 + int(x)) for x in rng.integers(0, 200, 4)) + "a" for _ in range(300))
    docs = spark.createDataFrame([(1, good), (2, bad), (3, spelled)], "doc_id long, text string")
    got = {r.doc_id: r for r in fertility.quality(docs).collect()}
    assert [got[i].kept for i in (1, 2, 3)] == [True, False, False]
    assert not any(got[i].base_failed for i in (1, 2, 3)) and got[3].byte_share > 0.1


@pytest.mark.parametrize("word,script", [("the", "latin"), ("*é", "latin"), ("слово", "cyrillic"), ("日本", "han"),
                                         ("한국", "hangul"), ("ελ", "greek"), ("ابج", "semitic"), ("123", "none"),
                                         ("हि", "indic")])
def test_scripts(word, script):
    assert fertility.SCRIPTS[fertility.script_of(word)] == script


def test_rules_stage(spark, clashing):
    verdicts = Counter((r.doc_id, r.kept) for r in fertility.quality(clashing).collect() if r.kept)
    got = fertility.kept_documents(spark, clashing)
    assert got.schema == clashing.schema
    assert Counter((r.doc_id, True) for r in got.collect()) == verdicts


def test_clean_documents_stay():
    import duckdb
    import os
    import pyarrow as pa

    where = "/root/testdata/sf0.01"
    if not os.path.isdir(where):
        pytest.skip("no test tables")
    rows = duckdb.execute(
        f"SELECT text FROM '{where}/documents.parquet' JOIN '{where}/labels.parquet' USING (doc_id) WHERE quality = 1"
    ).fetchall()
    found = fertility.measured(
        pa.record_batch({"text": pa.array([t for (t,) in rows])}), public_tokenizers.path(fertility.VOCABULARY)
    )
    failed, kept = fertility.judged(found)
    assert (kept | failed).mean() > 0.999


def test_bands_follow_the_language(spark):
    import os

    where = "/root/testdata/sf0.1"
    if not os.path.isdir(where):
        pytest.skip("no test tables")
    docs = spark.read.parquet(f"{where}/documents.parquet")
    labels = spark.read.parquet(f"{where}/labels.parquet").select("doc_id", "quality")
    rows = fertility.quality(docs).join(labels, "doc_id").filter("NOT base_failed").toPandas()
    junk, clean = rows[rows.quality == 0], rows[rows.quality == 1]
    assert (~junk.kept).mean() > 0.9
    assert clean.kept.mean() > 0.999


def half_up(x, digits):
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def bands_twin(rows):
    """Bands from measured rows (dicts), without Spark."""
    seen, groups = set(), {}
    for r in rows:
        if r["base_failed"] or not r["n_tokens"] or r["lang"] is None:
            continue
        length = math.log2(r["n_tokens"])
        values = (half_up(length, 2), *(half_up(r[c], 3) for c in ("token_entropy", "chars_per_token", "byte_share")))
        one = (r["script"], r["lang"], r["n_words"], r["word_chars"], r["n_tokens"], math.floor(2 * length), *values)
        if one not in seen:
            seen.add(one)
            groups.setdefault(one[:2], {}).setdefault(one[5], []).append(values)
    bands = {}
    for key, steps in groups.items():
        steps = [np.array(v) for v in steps.values() if len(v) >= fertility.LEAST_OF_LENGTH]
        if sum(map(len, steps)) < fertility.LEAST_TEXTS:
            continue
        steps.sort(key=lambda v: np.median(v[:, 0]))
        bounds = []
        for column, factor, least in zip((1, 2, 3), (-3.5, -6.0, 6.0), fertility.LEAST_SPREADS):
            modes, spreads = [], []
            for v in steps:
                q = np.percentile(v[:, column], np.arange(0, 101, 5))
                start = min(range(11), key=lambda i: (round(q[i + 10] - q[i], 9), i))
                modes.append(q[start + 5])
                spreads.append(round(q[start + 10] - q[start], 9) / 1.349)
            spreads = np.maximum(spreads, max(np.median(spreads), least))
            bounds.append(np.array(modes) + factor * spreads)
        bands[key] = ([np.median(v[:, 0]) for v in steps], *bounds)
    return bands


def test_bands_equal_a_plain_derivation(spark, monkeypatch):
    where = "/root/testdata/sf0.01"
    if not os.path.isdir(where):
        pytest.skip("no test tables")
    monkeypatch.setattr(fertility, "LEAST_TEXTS", 60)
    monkeypatch.setattr(fertility, "LEAST_OF_LENGTH", 8)
    docs = spark.read.parquet(f"{where}/documents.parquet")
    rows = fertility.scratch(spark, fertility.measures(docs, public_tokenizers.path(fertility.VOCABULARY)), "m")
    got, want = fertility.derive(rows), bands_twin([r.asDict() for r in rows.collect()])
    assert got.keys() == want.keys() and len(got) > 1
    for key, band in got.items():
        for a, b in zip(band, want[key]):
            assert a == pytest.approx(b, abs=1e-6)


def test_junk_does_not_set_the_band(spark):
    """A third and two fifths of a language are junk of lower entropy."""
    rng = np.random.default_rng(8)
    kinds = "doc_id long, n_words long, word_chars long, n_tokens long, chars_per_token double, byte_share double, token_entropy double, script string, base_failed boolean, lang string"
    for junk in (300, 320):
        rows = [(i, 100 + i, 400 + i, 256, float(rng.normal(2.2, 0.05)), 0.0, float(rng.normal(6.2, 0.1)), "latin", False, "en")
                for i in range(600 if junk == 300 else 480)]
        rows += [(10_000 + i, 100, 500 + i, 256, 1.8, 0.0, float(rng.uniform(3.5, 5.2)), "latin", False, "en") for i in range(junk)]
        band = fertility.derive(spark.createDataFrame(rows, kinds))["latin", "en"]
        # The junk ends at 5.2; the more of it, the wider the half that is mostly clean.
        assert 5.1 < band.least_entropy[0] < 6.0


def test_derived_bounds_are_never_looser():
    row = {"n_words": 100, "n_repeat_words": 0, "script": 0, "n_tokens": 256, "byte_share": 0.0}
    m = {k: np.array([v] * 2) for k, v in row.items()}
    m |= {"chars_per_token": np.array([2.0, 1.0]), "token_entropy": np.array([3.0, 6.3])}
    loose = {("latin", "en"): fertility.Derived((7.0, 9.0), (1.0, 1.0), (0.1, 0.1), (0.9, 0.9))}
    assert fertility.judged(m, ["en"] * 2, loose)[1].tolist() == [False, False]


def test_each_measure_binds():
    row = {"n_words": 100, "n_repeat_words": 0, "script": 0, "n_tokens": 256}
    usual = {"chars_per_token": 2.2, "byte_share": 0.0, "token_entropy": 6.0}
    bands = {("latin", "en"): fertility.Derived((7.0, 9.0), (5.0, 5.6), (2.0, 2.0), (0.06, 0.06))}
    cases = [{}, {"chars_per_token": 1.9}, {"byte_share": 0.08}, {"token_entropy": 5.2}]
    m = {k: np.array([(row | usual | c)[k] for c in cases]) for k in row | usual}
    assert fertility.judged(m, ["en"] * 4, bands)[1].tolist() == [True, False, False, False]
    assert fertility.judged(m, ["xx"] * 4, bands)[1].tolist() == [True, True, True, False]


# --- quality model ----------------------------------------------------------


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(2)
    vocabulary = ["".join(rng.choice(list("etaoinshr"), rng.integers(2, 8))) for _ in range(80)]
    rows, labels = [], []
    for i in range(700):
        words = [str(w) for w in rng.choice(vocabulary, rng.integers(30, 90))]
        quality = int(i % 4 != 0)
        rows.append((i, " ".join(words) if quality else " ".join(w.upper() + "$$$" for w in words)))
        labels.append((i, quality, 0))
    rows += [(700, None), (701, ""), (None, "no id"), (702, " ".join(vocabulary * 400)), rows[3]]
    labels += [(800, None, 0), (None, 1, 0), (5, 1 - int(5 % 4 != 0), 0), (900, 1, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_model(spark, labelled, folder):
    docs, labels = labelled
    got = quality_model.op3(spark, folder(documents=docs, labels=labels)).collect()
    assert len(got) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (remainder(r.doc_id, 5) == 0) for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 700]
    right = sum(r.predicted == int(r.doc_id % 4 != 0) for r in held)
    assert len(held) > 80 and right / len(held) > 0.95


def test_held_out_labels_are_not_learnt(spark, labelled, folder, tmp_path_factory):
    docs, labels = labelled
    turned = spark.createDataFrame(
        [(r.doc_id, 1 - r.quality if r.quality is not None and remainder(r.doc_id, 5) == 0 else r.quality, 0)
         for r in labels.collect()], labels.schema)
    one = quality_model.op3(spark, folder(documents=docs, labels=labels)).collect()
    other_dir = str(tmp_path_factory.mktemp("turned"))
    docs.write.parquet(f"{other_dir}/documents.parquet")
    turned.write.parquet(f"{other_dir}/labels.parquet")
    two = quality_model.op3(spark, other_dir).collect()
    assert sorted(map(str, one)) == sorted(map(str, two))


def test_without_labels(spark, labelled, folder, empty):
    docs, labels = labelled
    got = quality_model.op3(spark, folder(documents=docs, labels=labels.limit(0))).collect()
    assert {r.score for r in got} == {0.5}
    model = quality_model.learn(docs, labels.filter("quality = 1"))
    assert model.score == (1.0,)


def test_a_very_long_text_does_not_displace_the_others(spark, labelled):
    import hashlib

    docs, labels = labelled
    first = min((i for i in range(700) if i % 4 == 0), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    long = spark.createDataFrame([(first, "LONG$$$ " * (20 * 2**20 // 8))], "doc_id long, text string")
    rest = docs.filter(f"doc_id IS NOT NULL AND doc_id <> {first} AND doc_id < 700")
    model = quality_model.learn(rest.unionByName(long), labels.select("doc_id", "quality"))
    assert model.bad and model.good and model.score[0] < 0.2 < 0.8 < model.score[-1]


def test_what_does_not_fit_is_passed_over():
    rows = [{"doc_id": i, "quality": 0, "place": str(i), "bytes": b} for i, b in enumerate((4, 9, 5, 2, 1))]
    assert [i for i, _ in quality_model.fitting(rows, 10)] == [0, 2, 4]


def test_calibration_rises():
    rng = np.random.default_rng(0)
    x = rng.normal(size=500)
    label = (rng.random(500) < 1 / (1 + np.exp(-3 * x))).astype(int)
    at, score = quality_model.calibrated(x, label, np.ones(500))
    assert list(at) == sorted(at) and list(score) == sorted(score) and 0 < score[0] < 0.2 < 0.8 < score[-1] < 1


# --- language model ---------------------------------------------------------


def base_twin(rows):
    tokens = [plain(r[1]).split() + [b""] for r in rows]
    held = [remainder(r[0], 7) == 2 for r in rows]
    count = Counter(w for t, h in zip(tokens, held, strict=True) if not h for w in t)
    n, v = sum(count.values()), len(count)
    return [
        (r[0], h, len(t), sum(count[w] > 0 for w in t), n, sum(log10((count[w] + 1) / (n + v + 1)) for w in t))
        for r, t, h in zip(rows, tokens, held, strict=True)
    ]


@pytest.mark.parametrize("common", [lm_score.COMMON, 40])
def test_base_scores(spark, odd, odd_rows, folder, monkeypatch, common):
    """With few common words nearly all counts come by the join."""
    found = lm_score.symbols_of
    monkeypatch.setattr(lm_score, "symbols_of", lambda counts: found(counts, 20, 8, common))
    got = lm_score.op2(spark, folder(documents=odd)).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[5])
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"]
    got_rows = sorted(([r[n] for n in names] for r in got), key=order)
    for a, b in zip(got_rows, sorted(base_twin(odd_rows), key=order), strict=True):
        assert a[:5] == list(b[:5]) and a[5] == pytest.approx(b[5], rel=1e-9)
    assert all(r.score < 0 for r in got)


def tiny(spark, n=400):
    rng = np.random.default_rng(1)
    follow = {f"w{i}": [f"w{(i * 3 + k) % 30}" for k in range(3)] for i in range(30)}
    rows = []
    for i in range(n):
        text = ["w0"]
        for _ in range(rng.integers(5, 60)):
            text.append(str(rng.choice(follow[text[-1]])))
        rows.append((i, " ".join(text)))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_beats_the_base_on_held_out_texts(spark, folder):
    got = lm_score.op2(spark, folder(documents=tiny(spark))).filter("held_out").toPandas()
    per_token = lambda c: got[c].sum() / got["n_tokens"].sum()
    assert per_token("score") > per_token("base_score") + 0.5


def test_symbols_are_a_distribution_over_all_words(spark):
    docs = tiny(spark, 60)
    counts = lm_score.word_counts(docs)
    symbols, often = lm_score.symbols_of(counts, shortlist=6, classes=4)
    p = lm_score.train(spark, lm_score.sequences(docs, symbols), symbols, rounds=1)
    scorer, size = lm_score.Scorer(p), symbols.size
    one, two = np.array([0, 3, 9]), np.array([2, 0, 5])
    every = np.array([10 ** scorer.log10(one, two, np.full(3, s)) for s in range(size)])
    assert every.sum(axis=0) == pytest.approx(1, abs=1e-4)
    assert sum(symbols.counts) == symbols.tokens == sum(often.values())
    for c in range(4):  # within a class: all its words, and one that is unknown
        words = [w for w in often if w not in symbols.shortlist and lm_score.class_of(w, 4) == c]
        total = symbols.counts[6 + c] + symbols.class_words[c] + 1
        assert sum(often[w] + 1 for w in words) + 1 == total


def plain_log10(p, one, two, next):
    """The probability of one symbol, with a sum over all others written out."""
    context = [float(a) * float(b) + float(c) * float(d) for a, b, c, d in zip(p.before[one], p.place[0], p.before[two], p.place[1])]
    scores = [sum(x * float(y) for x, y in zip(context, row)) + float(b) for row, b in zip(p.after, p.bias)]
    top = max(scores)
    return (scores[next] - top - math.log(sum(math.exp(x - top) for x in scores))) / math.log(10)


@pytest.mark.parametrize("common", [lm_score.COMMON, 40])
def test_scores_equal_plain_sums(spark, odd, odd_rows, common):
    """Each text's score from given parameters: symbols by the model, words by their class's counts."""
    counts = lm_score.word_counts(odd)
    symbols, often = lm_score.symbols_of(counts, 12, 5, common)
    rng = np.random.default_rng(5)
    draw = lambda *shape: rng.normal(0, 0.7, shape).astype(np.float32)
    p = lm_score.Parameters(draw(17, 8), draw(17, 8), draw(2, 8), draw(17))
    model = spark.sparkContext.broadcast(lm_score.Model(symbols, p, often))
    docs = odd.selectExpr("doc_id", "false AS held_out", "text")
    got = lm_score.scores(docs, counts, model, spark).collect()

    seen, number, known = Counter(w for r in odd_rows for w in plain(r[1]).split()), symbols.numbers(), {}
    inner = Counter()
    for w, n in seen.items():
        if w not in number:
            inner[lm_score.class_of(w, 5)] += n + 1

    def score(text):
        total, one, two = 0.0, number[b""], number[b""]
        for w in [*plain(text).split(), b""]:
            c = lm_score.class_of(w, 5)
            s = number.get(w, 12 + c)
            if (one, two, s) not in known:
                known[one, two, s] = plain_log10(p, one, two, s)
            total += known[one, two, s] + (0 if w in number else log10((seen[w] + 1) / (inner[c] + 1)))
            one, two = s, one
        return total

    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = sorted(((r[0], score(r[1])) for r in odd_rows), key=order)
    for a, b in zip(sorted(((r.doc_id, r.score) for r in got), key=order), want, strict=True):
        assert a[0] == b[0] and a[1] == pytest.approx(b[1], rel=1e-4)


def test_sums_far_apart():
    """Factors whose product is nothing in floats are summed one by one."""
    p = lm_score.Parameters(*(np.array(x, np.float32) for x in ([[30], [-30]], [[5], [-5]], [[1], [1]], [0, 0])))
    got = lm_score.Scorer(p).log10(np.array([0, 0, 1]), np.array([1, 0, 1]), np.array([0, 0, 0]))
    assert got == pytest.approx([log10(0.5), 0, -600 / math.log(10)], abs=1e-3)


def test_symbols_grow_with_the_vocabulary(spark):
    sizes = [lm_score.sizes_of(10**k) for k in (0, 3, 6, 9)]
    assert sizes == [(16, 16), (160, 40), (1600, 400), (16000, 4000)]
    counts = spark.range(8000).selectExpr("cast(concat('w', id) AS binary) AS word", "id + 1 AS n")
    symbols, _ = lm_score.symbols_of(counts)
    assert (len(symbols.shortlist), symbols.classes) == (320, 80)


def test_a_large_share_is_read_in_parts(spark, monkeypatch):
    docs = tiny(spark)
    counts = lm_score.word_counts(docs)
    symbols, _ = lm_score.symbols_of(counts)
    found = lm_score.sequences(docs, symbols)
    batches = found.coalesce(1).toArrow().to_batches(max_chunksize=50)
    parts = list(lm_score.parts_of(iter(batches), 120))
    assert [len(k) for k, _ in parts[:-1]] == [150] * (len(parts) - 1) and len(parts[-1][0]) <= 150
    assert sum(len(k) for k, _ in parts) == found.count()
    again = [lm_score.train(spark, found, symbols, rounds=1).flat() for _ in range(2)]
    assert np.array_equal(*again)


def test_sequences(spark, odd, odd_rows):
    counts = lm_score.word_counts(odd)
    symbols, _ = lm_score.symbols_of(counts, shortlist=12, classes=3)
    size, number = symbols.size, symbols.numbers()
    want = Counter()
    for r in odd_rows:
        s = [number.get(w, len(symbols.shortlist) + lm_score.class_of(w, 3)) for w in plain(r[1]).split()]
        s = [number[b""]] * 2 + s + [number[b""]]
        want.update((a * size + b) * size + c for a, b, c in zip(s, s[1:], s[2:]))
    assert {r.key: r.n for r in lm_score.sequences(odd, symbols).collect()} == want


def test_sequences_travel_packed(spark, odd, monkeypatch):
    """A row for each group and flush is shuffled, not one for each sequence; a group's keys come mixed."""
    counts = lm_score.word_counts(odd)
    symbols, _ = lm_score.symbols_of(counts, shortlist=40, classes=9)
    whole = [tuple(r) for r in lm_score.sequences(odd, symbols).collect()]
    monkeypatch.setattr(lm_score, "IN_GROUP", 5000)
    monkeypatch.setattr(lm_score, "GATHERED", 700)
    found = lm_score.sequences(odd, symbols)
    assert "Aggregate" not in found._jdf.queryExecution().toString()
    got = [tuple(r) for r in found.collect()]
    assert len(set(got)) == len(got) > 10_000 and sorted(got) == sorted(whole)
    hashes = lm_score.mixing_hash(np.array([k for k, _ in whole]))
    assert (np.diff(hashes) > 0).all()
    hashes, groups = lm_score.mixing_hash(np.array([k for k, _ in got])), -(-symbols.tokens // 5000)
    group = (((hashes >> 32) + 2**31) * groups) >> 32
    assert set(group) == set(range(groups)) and groups > 5
    assert all((np.diff(hashes[group == g]) > 0).all() for g in range(groups))


def test_mixing_hash_is_that_of_spark(spark):
    keys = [0, 1, 7, 3_306_744_124, 2**62 + 5, 2**63 - 1]
    rows = spark.createDataFrame([(k,) for k in keys], "key long").selectExpr("xxhash64(key) AS h").collect()
    assert lm_score.mixing_hash(np.array(keys)).tolist() == [r.h for r in rows]


def test_symbols_of_words():
    listed = [b"a", b"ab", b"zzab", "é".encode(), "слово".encode(), b"x" * 300, b"\x00", b"own"]
    symbols = lm_score.Symbols((b"", b"own", b"zzab"), 7, (), (), 0, 0)
    want = [symbols.numbers().get(w, 3 + lm_score.class_of(w, 7)) for w in listed]
    words = pa.array([b"before", *listed, b"behind"], pa.binary())
    assert symbols.of(words.slice(1, len(listed))).tolist() == want
    assert symbols.of(words.slice(0, 0)).tolist() == []


def test_a_step_equals_plain_sums():
    """One step against slopes summed row by row."""
    rng = np.random.default_rng(4)
    draw = lambda *shape: rng.normal(0, 0.5, shape).astype(np.float32)
    p, noise = lm_score.Parameters(draw(9, 4), draw(9, 4), draw(2, 4), draw(9)), rng.dirichlet(np.ones(9))
    two, one, next = (rng.integers(0, 9, 30) for _ in range(3))
    count = rng.integers(1, 6, 30)
    trainer = lm_score.Trainer(p, noise, 2.0, 0.2, [1])
    trainer.step(two, one, next, count)
    upto = np.cumsum(noise)
    drawn = np.searchsorted(upto, np.random.default_rng([1]).random(lm_score.NOISE) * upto[-1], side="right").clip(max=8)
    slopes = lm_score.Parameters(*(np.zeros(x.shape) for x in p))
    for a, b, c, many in zip(two, one, next, count, strict=True):
        weight = many / (2.0 * np.sqrt(30))
        predicted = p.before[b] * p.place[0] + p.before[a] * p.place[1]
        to_predicted = np.zeros(4)
        for s, real in [(c, True), *((d, False) for d in drawn)]:
            x = predicted @ p.after[s] + p.bias[s] - np.log(noise[s] * lm_score.NOISE)
            up = weight / (1 + np.exp(x)) if real else -weight / (1 + np.exp(-x))
            slopes.after[s] += up * predicted
            slopes.bias[s] += up
            to_predicted += up * p.after[s]
        slopes.place[:] += to_predicted * p.before[b], to_predicted * p.before[a]
        slopes.before[b] += to_predicted * p.place[0]
        slopes.before[a] += to_predicted * p.place[1]
    for now, old, slope in zip(trainer.now, p, slopes, strict=True):
        assert now == pytest.approx(old + 0.2 * slope / np.sqrt(0.01 + slope * slope), abs=1e-4)


def test_empty(spark, empty, folder):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    where = folder(documents=empty, labels=labels)
    for query in (fertility.op9, quality_model.op3, lm_score.op2):
        assert query(spark, where).collect() == []
