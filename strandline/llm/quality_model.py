"""A quality classifier that compresses.

Two zstandard dictionaries are built, one from texts labelled good, one from bad.
A text is compressed with each, in pieces, so that all of a long text meets the
dictionaries. How much smaller the good one makes it, for each byte of the text,
is monotonely calibrated on labelled texts that no dictionary has seen.

Learning reads a bounded sample of labelled rows: for each class the first
``sample_rows`` ids in the order of a hash, as far as ``sample_bytes`` reach; a text
that doesn't fit any more is passed over for the next. A text of more than
``TEXT_PIECES`` pieces stands in the sample with so many of them, chosen by a hash.
Texts alternate between dictionary and calibration. The sample is all that comes
to the driver. Class sizes for the calibration are counted over all labels.

Defined cases: null text is empty text, whose difference is 0; labels that are null
or contradict each other are not learnt; without texts of both classes every score
is the share of label 1, or 0.5 without labels; texts of any length are compressed
whole; equal rows get equal scores; an empty table gives an empty result.
"""

import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import arrow, as_bytes, documents, prepare, remainder, scratch, slices

SAMPLE_ROWS, SAMPLE_BYTES = 4_000, 12 << 20
#: Pieces of a labelled text that learning reads.
TEXT_PIECES = 32
DICTIONARY_BYTES, PIECE_BYTES, LEVEL = 112 << 10, 2048, 3
#: A piece of dictionary training must be seen by at least so many samples.
LEAST_SAMPLES = 16
THRESHOLD = 0.3


class Model(NamedTuple):
    """Two dictionaries (empty without both classes) and the calibration's knots."""

    bad: bytes
    good: bytes
    at: tuple[float, ...]
    score: tuple[float, ...]


def in_pieces(text: bytes) -> list[bytes]:
    return [text[i : i + PIECE_BYTES] for i in range(0, len(text), PIECE_BYTES)]


def sampled(text: bytes, place: str) -> bytes:
    """The text, or of a long one ``TEXT_PIECES`` pieces in their order."""
    pieces = in_pieces(text)
    if len(pieces) <= TEXT_PIECES:
        return text
    chosen = sorted(range(len(pieces)), key=lambda i: (zlib.crc32(f"{place}/{i}".encode()), i))
    return b"".join(pieces[i] for i in sorted(chosen[:TEXT_PIECES]))


def fitting(rows: list, limit: int) -> list[tuple]:
    """(doc_id, quality) of the rows that fit into ``limit`` bytes of their class, by place."""
    found, held = [], {0: 0, 1: 0}
    for row in sorted(rows, key=lambda r: r["place"]):
        if held[row["quality"]] + row["bytes"] <= limit:
            held[row["quality"]] += row["bytes"]
            found.append((row["doc_id"], row["quality"]))
    return found


@lru_cache(2)
def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(dictionary)
    known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=known, write_checksum=False, write_content_size=False, write_dict_id=False
    )


def difference(text: bytes, bad: bytes, good: bytes) -> float:
    """Bytes that the good dictionary saves against the bad one, for each byte of text."""
    if not (text and bad and good):
        return 0.0
    with_bad, with_good = compressor(bad), compressor(good)
    saved = sum(len(with_bad.compress(p)) - len(with_good.compress(p)) for p in in_pieces(text))
    return saved / len(text)


def dictionary(texts: list[bytes]) -> bytes:
    """A dictionary of the texts; short of samples, the texts themselves."""
    pieces = [p for t in texts for p in in_pieces(t)]
    size = sum(map(len, pieces))
    if len(pieces) >= LEAST_SAMPLES and size >= 10 * 1024:
        try:
            return zstandard.train_dictionary(
                min(DICTIONARY_BYTES, size // 8), pieces, level=LEVEL
            ).as_bytes()
        except zstandard.ZstdError:  # too little in common to train on
            pass
    return b"".join(pieces)[-DICTIONARY_BYTES:]


def calibrated(x: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[tuple, tuple]:
    """Knots of the best rising curve of label over ``x`` (pool adjacent violators)."""
    blocks: list[list[float]] = []  # weight, weighted label, weighted x
    for i in np.argsort(x, kind="stable"):
        blocks.append([weight[i], weight[i] * label[i], weight[i] * x[i]])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    at = tuple(b[2] / b[0] for b in blocks)
    # Half a row of either class in each block keeps scores inside 0 and 1.
    half = 0.5 * float(weight.mean())
    return at, tuple((b[1] + half) / (b[0] + 2 * half) for b in blocks)


def learn(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES
) -> Model:
    """``labels``: doc_id and quality of the rows to learn from."""
    agreed = (
        labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .filter("quality = other")
        .select("doc_id", F.col("quality").cast("int"), F.md5(F.col("doc_id").cast("string")).alias("place"))
    )
    totals = {r["quality"]: r["count"] for r in agreed.groupBy("quality").count().collect()}
    some = None
    for quality in (0, 1):
        of_class = agreed.filter(F.col("quality") == quality).orderBy("place").limit(sample_rows)
        some = of_class if some is None else some.unionByName(of_class)
    labelled = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .join(F.broadcast(some), "doc_id")  # 2 * sample_rows
        .groupBy("doc_id", "quality", "place")
        .agg(F.max(F.coalesce("text", F.lit(""))).alias("text"))
    )
    schema = pa.schema(
        [("doc_id", pa.int64()), ("quality", pa.int32()), ("place", pa.string()), ("part", pa.binary())]
    )

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column("place").to_pylist()
            part = [sampled(t, p) for t, p in zip(as_bytes(batch), places, strict=True)]
            yield arrow({c: batch.column(c) for c in ("doc_id", "quality", "place")} | {"part": part}, schema)

    sample = scratch(
        docs.sparkSession,
        labelled.mapInArrow(parts, "doc_id long, quality int, place string, part binary"),
        "labelled",
    )
    sizes = sample.select("doc_id", "quality", "place", F.octet_length("part").alias("bytes"))
    chosen = docs.sparkSession.createDataFrame(fitting(sizes.collect(), sample_bytes), "doc_id long, quality int")
    texts = sample.join(F.broadcast(chosen), ["doc_id", "quality"]).select("quality", "place", "part").collect()
    kinds: dict[int, list[bytes]] = {0: [], 1: []}
    for row in sorted(texts, key=lambda r: r["place"]):
        kinds[row["quality"]].append(bytes(row["part"]))
    n = sum(totals.values())
    if min(map(len, kinds.values())) < 2:
        return Model(b"", b"", (0.0,), (totals.get(1, 0) / n if n else 0.5,))
    bad, good = (dictionary(kinds[q][::2]) for q in (0, 1))
    unseen = [(q, t) for q in (0, 1) for t in kinds[q][1::2]]
    label = np.array([q for q, _ in unseen])
    x = np.array([difference(t, bad, good) for _, t in unseen])
    weight = np.where(label == 1, totals[1] / (label == 1).sum(), totals[0] / (label == 0).sum())
    return Model(bad, good, *calibrated(x, label, weight * len(label) / weight.sum()))


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (doc_id, held_out, text) with score and predicted."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("held_out", pa.bool_()),
            ("size_difference", pa.float64()),
            ("score", pa.float64()),
            ("predicted", pa.int32()),
        ]
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = np.array([difference(t, model.bad, model.good) for t in as_bytes(batch)])
            found = np.interp(x, model.at, model.score)
            rows = {
                "doc_id": batch.column("doc_id"),
                "held_out": batch.column("held_out"),
                "size_difference": x,
                "score": found,
                "predicted": (found >= threshold).astype(np.int32),
            }
            yield arrow(rows, schema)

    return docs.select("doc_id", "held_out", "text").mapInArrow(
        score, "doc_id long, held_out boolean, size_difference double, score double, predicted int"
    )


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = prepare(spark).read.parquet(f"{sf_dir}/labels.parquet")
    model = learn(docs, labels.filter(remainder("doc_id", 5) != 0))
    return scored(docs.withColumn("held_out", remainder("doc_id", 5) == 0), model)
