"""Quality rules by tokeniser fertility.

A public vocabulary made from ordinary text needs few tokens for ordinary text.
Three measures say how ordinary a text is: characters of its words per token, the
share of tokens that are single bytes because the vocabulary has no piece for
them, and the entropy of its tokens. What is ordinary is read from all documents
that pass the base rules: for each script and language, and each half power of two
of tokens, the median and the spread of the side that junk does not reach. A bound
is so many spreads from the median, between lengths by interpolation. Equal measures
count once, so that copies don't narrow a band. Languages of under ``LEAST_TEXTS``
texts, and texts without a language, use their script's fixed bands.

A text fails the base rules, or is judged by the bands of its language and of the
script that most of its lettered words are in. Words are encoded once for each batch and counted as
often as they occur; the vocabulary starts a piece at every blank, so words don't
depend on their neighbours.

Defined cases: null and empty texts have no words, all counts 0, fail the base
rules and measure 0; a text without letters is of script ``none``; very long texts
are measured whole; repeated rows get a row each; an empty table gives an empty
result; ``kept_documents`` returns all columns, whatever their names.
"""

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import (
    arrow,
    as_bytes,
    documents,
    fresh_name,
    if_small,
    numbered,
    prepare,
    scratch,
    slices,
    words,
)

VOCABULARY = "piece_bpe_32k.model"
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 50, 50, 3
#: Words whose tokens a worker remembers.
REMEMBERED = 200_000


class Band(NamedTuple):
    """What a script's texts may measure; entropy (bits) has a floor that is the
    least of ``flat`` and ``base + slope * log2(tokens)``."""

    least_chars: float
    most_chars: float
    most_bytes: float
    base: float
    slope: float
    flat: float


# Fixed values, for languages with too few texts to derive bands from. Alphabets have pieces of several letters in the vocabulary; of the
# others' characters many are spelled in three bytes.
BANDS = {
    "latin": Band(1.3, 9.0, 0.10, 3.4, 0.28, 6.35),
    "cyrillic": Band(1.0, 9.0, 0.20, 3.0, 0.28, 5.8),
    "greek": Band(0.6, 6.0, 0.60, 2.2, 0.25, 4.5),
    "semitic": Band(0.4, 6.0, 0.80, 2.0, 0.25, 4.2),
    "han": Band(0.3, 3.0, 0.85, 2.2, 0.28, 5.0),
    "hangul": Band(0.3, 3.0, 0.90, 2.2, 0.28, 4.5),
    "indic": Band(0.3, 4.0, 0.95, 1.8, 0.25, 4.0),
    "other": Band(0.25, 9.0, 1.00, 1.5, 0.25, 3.5),
    "none": Band(0.25, 9.0, 1.00, 1.5, 0.25, 3.5),
}
SCRIPTS = list(BANDS)
#: A derived band needs so many texts, and so many of each length it is known at.
LEAST_TEXTS, LEAST_OF_LENGTH = 200, 30
#: Points of a measure's distribution that a band is read from, and those of them that span
#: its half. Of all such spans the shortest is the densest half; its middle point is the mode
#: taken, and its width, of a normal distribution, 1.349 spreads.
POINTS, HALF, HALF_WIDTH = 20, 10, 1.349
#: Spreads that a text may be from the mode: entropy and characters per token below it,
#: bytes above it; and the least spread of each.
ENTROPY_SPREADS, CHARS_SPREADS, BYTES_SPREADS = 3.5, 6.0, 6.0
LEAST_SPREADS = (0.05, 0.01, 0.01)


class Derived(NamedTuple):
    """Bounds at lengths ``at`` (log2 of tokens, rising)."""

    at: tuple[float, ...]
    least_entropy: tuple[float, ...]
    least_chars: tuple[float, ...]
    most_bytes: tuple[float, ...]


#: By script and language.
Bands = dict[tuple[str, str], Derived]
# The first code point of each stretch of letters, and its script.
STRETCHES = [
    (0x0041, "latin"),
    (0x0370, "greek"),
    (0x0400, "cyrillic"),
    (0x0530, "other"),
    (0x0590, "semitic"),
    (0x0900, "indic"),
    (0x0E00, "other"),
    (0x1100, "hangul"),
    (0x1200, "other"),
    (0x1E00, "latin"),
    (0x1F00, "greek"),
    (0x2000, "none"),
    (0x2C60, "latin"),
    (0x2C80, "other"),
    (0x3040, "han"),
    (0xA000, "other"),
    (0xA640, "cyrillic"),
    (0xA720, "latin"),
    (0xA840, "other"),
    (0xAC00, "hangul"),
    (0xD7B0, "other"),
    (0xF900, "han"),
    (0xFB00, "latin"),
    (0xFB1D, "semitic"),
    (0xFF00, "other"),
    (0x20000, "han"),
]
_STARTS = np.array([s for s, _ in STRETCHES])
_SCRIPT = np.array([SCRIPTS.index(name) for _, name in STRETCHES])


@lru_cache(2)
def pieces(path: str):
    """The vocabulary, which of its ids are bytes, and the words it has been asked for."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    of_bytes = np.array([model.is_byte(i) for i in range(model.get_piece_size())])
    return model, of_bytes, {}


def script_of(word: str) -> int:
    """The script of the word's first letter."""
    for letter in word:
        if letter.isalpha():
            return int(_SCRIPT[np.searchsorted(_STARTS, ord(letter), "right") - 1])
    return SCRIPTS.index("none")


def tokens_of(path: str, distinct: list[bytes]) -> tuple[list[tuple[list[int], int]], np.ndarray]:
    """(ids, script) of each word, and which ids are bytes."""
    model, of_bytes, known = pieces(path)
    if len(known) > REMEMBERED:
        known.clear()
    new = [w for w in distinct if w not in known]
    texts = [w.decode() for w in new]
    known.update(zip(new, zip(model.encode(texts), map(script_of, texts)), strict=True))
    return [known[w] for w in distinct], of_bytes


def repeated_words(doc: np.ndarray, word: np.ndarray, n_words: int, n_docs: int) -> np.ndarray:
    """For each text the words in three-word windows that it has twice or more."""
    if len(word) < WINDOW:
        return np.zeros(n_docs, np.int64)
    inside = doc[WINDOW - 1 :] == doc[: 1 - WINDOW]
    at = np.flatnonzero(inside)
    key = doc[at].astype(np.int64) * n_words + word[at]
    for ahead in range(1, WINDOW):
        key = key * n_words + word[at + ahead]
        _, key, count = np.unique(key, return_inverse=True, return_counts=True)
        more = count[key] > 1
        at, key = at[more], key[more]
    covered = np.zeros(len(word), bool)
    for ahead in range(WINDOW):
        covered[at + ahead] = True
    return np.bincount(doc[covered], minlength=n_docs)


def measured(batch: pa.RecordBatch, path: str) -> dict[str, np.ndarray]:
    """The base counts and the three measures of the batch's texts."""
    texts = as_bytes(batch)
    n = len(texts)
    doc, word, distinct = words(texts)
    found, of_bytes = tokens_of(path, distinct.to_pylist())
    n_words = np.bincount(doc, minlength=n)
    chars = pc.utf8_length(distinct.cast(pa.string())).to_numpy(zero_copy_only=False)
    dup_lines = []
    for text in texts:
        lines = [line for line in text.split(b"\n") if line.strip()]
        dup_lines.append(len(lines) - len(set(lines)))

    # Tokens of each distinct word, then of each word in its place.
    sizes = np.fromiter((len(ids) for ids, _ in found), np.int64, len(found))
    flat = np.fromiter((i for ids, _ in found for i in ids), np.int64, int(sizes.sum()))
    starts = np.cumsum(sizes) - sizes
    each = sizes[word]
    offsets = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
    token = flat[np.repeat(starts[word], each) + offsets] if len(flat) else flat
    token_doc = np.repeat(doc, each)
    n_tokens = np.bincount(token_doc, minlength=n)
    n_bytes = np.bincount(token_doc, weights=of_bytes[token], minlength=n)
    pair, count = np.unique(token_doc * len(of_bytes) + token, return_counts=True)
    owner = pair // len(of_bytes)
    share = count / np.maximum(n_tokens[owner], 1)
    entropy = np.bincount(owner, weights=-share * np.log2(share), minlength=n)
    per_script = np.zeros((n, len(SCRIPTS)), np.int64)
    scripts = np.fromiter((s for _, s in found), np.int64, len(found))
    np.add.at(per_script, (doc, scripts[word] if len(found) else word), 1)
    per_script[:, SCRIPTS.index("none")] = 0
    script = np.where(per_script.any(axis=1), per_script.argmax(axis=1), SCRIPTS.index("none"))
    word_chars = np.bincount(doc, weights=chars[word] if len(chars) else None, minlength=n)
    return {
        "n_words": n_words,
        "word_chars": word_chars.astype(np.int64),
        "n_symbols": np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in texts], np.int64),
        "n_dup_lines": np.array(dup_lines, np.int64),
        "n_repeat_words": repeated_words(doc, word, len(distinct), n),
        "n_tokens": n_tokens,
        "chars_per_token": word_chars / np.maximum(n_tokens, 1),
        "byte_share": n_bytes / np.maximum(n_tokens, 1),
        "token_entropy": entropy,
        "script": script,
    }


def base_failed(m: dict[str, np.ndarray]) -> np.ndarray:
    return (m["n_words"] < MIN_WORDS) | (
        100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"]
    )


def judged(
    m: dict[str, np.ndarray], langs: list[str | None] | None = None, bands: Bands | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(base_failed, kept)"""
    failed = base_failed(m)
    length = np.log2(np.maximum(m["n_tokens"], 1))
    band = np.array([BANDS[s] for s in SCRIPTS])[m["script"]]
    least, most, most_bytes, base, slope, flat = band.T.copy()
    floor = np.minimum(flat, base + slope * length)
    if bands:
        names = [SCRIPTS[s] for s in m["script"]]
        keys = list(zip(names, langs, strict=True))
        for key in set(keys) & bands.keys():
            rows, known = np.array([k == key for k in keys]), bands[key]
            at = length[rows]
            # Below the shortest known length entropy can't fall faster than log2(tokens).
            shorter = np.maximum(known.at[0] - at, 0)
            # Never looser than the fixed bounds: where junk prevails it can't set the rule.
            floor[rows] = np.maximum(floor[rows], np.interp(at, known.at, known.least_entropy) - shorter)
            least[rows] = np.maximum(least[rows], np.interp(at, known.at, known.least_chars))
            most_bytes[rows] = np.minimum(most_bytes[rows], np.interp(at, known.at, known.most_bytes))
    ordinary = (
        (m["chars_per_token"] >= least)
        & (m["chars_per_token"] <= most)
        & (m["byte_share"] <= most_bytes)
        & (m["token_entropy"] >= floor)
    )
    return failed, ~failed & ordinary


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MEASURES = ["chars_per_token", "byte_share", "token_entropy"]
_SCHEMA = pa.schema(
    [(c, pa.int64()) for c in ["doc_id", *COUNTS, "n_tokens"]]
    + [(c, pa.float64()) for c in MEASURES]
    + [("script", pa.string()), ("base_failed", pa.bool_()), ("kept", pa.bool_())]
)
_MEASURED = pa.schema([*list(_SCHEMA)[:-1], ("lang", pa.string())])


def _columns(schema: pa.Schema) -> str:
    types = {"int64": "long", "double": "double", "string": "string", "bool": "boolean"}
    return ", ".join(f"{f.name} {types[str(f.type)]}" for f in schema)


def language(docs: DataFrame) -> Column:
    """The documents' language as text; null where they have no such column."""
    named = any(c.lower() == "lang" for c in docs.columns)
    return (F.col("lang") if named else F.lit(None)).cast("string").alias("lang")


def measures(docs: DataFrame, path: str, row: str | None = None) -> DataFrame:
    """Counts and measures of every text, with its language; ``row`` is a number to carry along."""
    schema = _MEASURED if row is None else pa.schema([*_MEASURED, ("row", pa.int64())])
    carried = [] if row is None else [F.col(row).alias("row")]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = measured(batch, path)
            names = [SCRIPTS[s] for s in found["script"]]
            rows = found | {c: batch.column(c) for c in batch.schema.names if c != "text"}
            yield arrow(rows | {"script": names, "base_failed": base_failed(found)}, schema)

    return docs.select("doc_id", "text", language(docs), *carried).mapInArrow(measure, _columns(schema))


def dense_half(points: list[float]) -> tuple[float, float]:
    """The middle and the spread of the shortest span of points that holds half of the texts."""
    at = np.array(points)
    width = np.round(at[HALF:] - at[:-HALF], 9)
    first = int(width.argmin())
    return float(at[first + HALF // 2]), float(width[first] / HALF_WIDTH)


def derive(rows: DataFrame) -> Bands:
    """Bands from all of the measures' ``rows`` that pass the base rules.

    Each measure's densest half is looked for, by length, so that junk of another kind
    does not move the band unless there is more of it than of the rest. Values are
    rounded, so that percentiles are exact over a bounded number of them
    and don't depend on how the rows lie. What comes to the driver is a row for each
    language, script and length of ``LEAST_OF_LENGTH`` texts.
    """
    length = F.log2("n_tokens")
    texts = (
        rows.filter("NOT base_failed AND n_tokens > 0 AND lang IS NOT NULL")
        .select(
            "script", "lang", "n_words", "word_chars", "n_tokens",
            F.floor(2 * length).alias("step"),
            F.round(length, 2).alias("length"),
            F.round("token_entropy", 3).alias("entropy"),
            F.round("chars_per_token", 3).alias("chars"),
            F.round("byte_share", 3).alias("bytes"),
        )
        .distinct()
    )
    points = ", ".join(str(i / POINTS) for i in range(POINTS + 1))
    parts = [F.expr(f"percentile({c}, array({points})) AS {c}") for c in ("entropy", "chars", "bytes")]
    values = [F.count("*").alias("n"), F.expr("percentile(length, 0.5) AS at"), *parts]
    groups: dict[tuple[str, str], list] = {}
    known = texts.groupBy("script", "lang", "step").agg(*values).filter(F.col("n") >= LEAST_OF_LENGTH)
    for r in known.collect():
        groups.setdefault((r["script"], r["lang"]), []).append(r)
    found: Bands = {}
    for key, steps in groups.items():
        if sum(r["n"] for r in steps) < LEAST_TEXTS:
            continue
        steps.sort(key=lambda r: r["at"])
        bounds = []
        for name, spreads, least in zip(
            ("entropy", "chars", "bytes"), (-ENTROPY_SPREADS, -CHARS_SPREADS, BYTES_SPREADS), LEAST_SPREADS, strict=True
        ):
            middle, spread = np.array([dense_half(r[name]) for r in steps]).T
            spread = np.maximum(spread, max(float(np.median(spread)), least))
            bounds.append(tuple((middle + spreads * spread).tolist()))
        found[key] = Derived(tuple(r["at"] for r in steps), *bounds)
    return found


def verdicts(rows: DataFrame, bands: Bands, carried: list[str]) -> DataFrame:
    """``carried`` columns of the measures' ``rows``, and kept."""
    kinds = {f.name: f for f in [*_MEASURED, pa.field("row", pa.int64())]}
    schema = pa.schema([*(kinds[c] for c in carried), ("kept", pa.bool_())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in [*COUNTS, "n_tokens", *MEASURES]}
            names = batch.column("script").to_pylist()
            found["script"] = np.array([SCRIPTS.index(s) for s in names], np.int64)
            _, kept = judged(found, batch.column("lang").to_pylist(), bands)
            yield arrow({c: batch.column(c) for c in carried} | {"kept": kept}, schema)

    return rows.mapInArrow(judge, _columns(schema))


def quality(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The counts, measures and verdict of every text."""
    path = path or public_tokenizers.path(VOCABULARY)
    rows = scratch(docs.sparkSession, measures(docs, path), "measures")
    return verdicts(rows, derive(rows), _SCHEMA.names[:-1])


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir))


def kept_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents that pass, with their columns; each text is encoded once."""
    prepare(spark)
    row = fresh_name(docs, "_row")
    rows = numbered(spark, docs, row)
    found = scratch(spark, measures(rows, public_tokenizers.path(VOCABULARY), row), "measures")
    gone = verdicts(found, derive(found), ["row"]).filter("NOT kept").select(F.col("row").alias(row))
    gone = scratch(spark, gone, "rejected")
    return rows.join(if_small(gone, gone.count(), 16), row, "left_anti").select(*docs.columns)
