"""Exact duplicates by counting quotient filters, then by bytes.

A text, lower-cased in A-Z, has a 64-bit fingerprint. Its upper bits are the
quotient, the rest the remainder. Every task builds a counting quotient filter of
its fingerprints: which quotients occur, how many remainders each has, the
remainders in order, and how often those occur that occur again. A filter has about
as many quotients as fingerprints, so its size follows what is in it, however many
ranges there are. Filters of one range of quotients
meet in one task and are merged by their sorted remainders; nothing is lost, as
all bits are kept. A fingerprint counted once belongs to a text without a copy,
whose bytes never move. Texts of the others are grouped by their bytes, after
copies within a task are put together.

Defined cases: null text is empty text; of equal texts the row with the largest id
stays, a null id being smaller than any, and of rows with that id exactly one;
keep_id is null only where all ids of the group are; an empty table gives an empty
result; other columns are not looked at, and ``deduplicated`` returns them as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
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
)

#: Rows whose fingerprints one merging task holds, about; and the fewest ranges.
RANGE_ROWS, RANGES = 1_000_000, 64
#: Fingerprints that a task gathers before it writes a filter.
FILTER_ROWS = 1_000_000


# --- the filter -------------------------------------------------------------


def geometry(rows: int) -> tuple[int, int]:
    """(range bits, most quotient bits in a range): all filters of a job share them."""
    ranges = max(RANGES, rows // RANGE_ROWS + 1)
    return (ranges - 1).bit_length(), 20


def _narrow(largest: int) -> str:
    return "<u1" if largest < 1 << 8 else "<u2" if largest < 1 << 16 else "<u4"


def build(prints: np.ndarray, counts: np.ndarray, quotient_bits: int, skip_bits: int) -> bytes:
    """A filter of fingerprints that agree in their first ``skip_bits``."""
    order = np.argsort(prints, kind="stable")
    prints, counts = prints[order], counts[order]
    first = np.flatnonzero(np.r_[True, prints[1:] != prints[:-1]]) if len(prints) else []
    distinct = prints[first]
    totals = np.add.reduceat(counts, first).astype("<u8") if len(distinct) else counts.astype("<u8")
    bits = min(quotient_bits, max(3, len(distinct).bit_length()))
    rest_bits = 64 - skip_bits - bits
    own = distinct & np.uint64((1 << (64 - skip_bits)) - 1)
    quotients = (own >> np.uint64(rest_bits)).astype(np.int64)
    runs = np.bincount(quotients, minlength=1 << bits)
    occupied = np.packbits(runs > 0)
    remainders = own & np.uint64((1 << rest_bits) - 1)
    again = np.flatnonzero(totals > 1)
    head = np.array([len(distinct), int((runs > 0).sum()), len(again), bits], "<u4")
    parts = (occupied, runs[runs > 0].astype(_narrow(len(distinct))), remainders.astype("<u8"))
    return b"".join(x.tobytes() for x in (head, *parts, again.astype("<u4"), totals[again]))


def contents(payload: bytes, prefix: int, quotient_bits: int, skip_bits: int):
    """(fingerprints in order, counts) of a filter: nothing was lost."""
    n, n_runs, n_again, bits = (int(x) for x in np.frombuffer(payload, "<u4", 4))
    at = 16

    def part(kind: str, count: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(payload, kind, count, at)
        at += found.nbytes
        return found

    bitmap = part("<u1", (1 << bits) // 8)
    runs, remainders = part(_narrow(n), n_runs), part("<u8", n)
    counts = np.ones(n, np.uint64)
    again = part("<u4", n_again)
    counts[again] = part("<u8", n_again)
    quotients = np.repeat(np.flatnonzero(np.unpackbits(bitmap)), runs).astype(np.uint64)
    rest_bits = 64 - skip_bits - bits
    upper = np.uint64((prefix << (64 - skip_bits)) & (2**64 - 1)) if skip_bits else np.uint64(0)
    return upper | (quotients << np.uint64(rest_bits)) | remainders, counts


def filters(prints: DataFrame, rows: int) -> DataFrame:
    """A filter (range, payload) for each task and range of quotients."""
    skip_bits, quotient_bits = geometry(rows)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out():
            every = np.sort(np.concatenate(held)) if held else np.zeros(0, np.uint64)
            prefixes = (every >> np.uint64(64 - skip_bits)).astype(np.int64)
            cuts = np.flatnonzero(np.r_[True, prefixes[1:] != prefixes[:-1]]) if len(every) else []
            for part in np.split(every, cuts[1:]) if len(every) else []:
                one = np.ones(len(part), np.uint64)
                rows = {
                    "range": [int(part[0] >> np.uint64(64 - skip_bits))],
                    "payload": [build(part, one, quotient_bits, skip_bits)],
                }
                yield arrow(rows, pa.schema([("range", pa.int64()), ("payload", pa.binary())]))

        for batch in batches:
            held.append(batch.column("print").to_numpy().view(np.uint64))
            if sum(map(len, held)) >= FILTER_ROWS:
                yield from out()
                held.clear()
        yield from out()

    return prints.select("print").mapInArrow(gather, "range long, payload binary")


def repeated(made: DataFrame, rows: int) -> DataFrame:
    """Fingerprints counted more than once, by merging the filters of each range."""
    skip_bits, quotient_bits = geometry(rows)

    def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        prefix = int(key[0])
        parts = [contents(p, prefix, quotient_bits, skip_bits) for p in group["payload"]]
        prints, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
        merged = build(prints, counts, quotient_bits, skip_bits)
        prints, counts = contents(merged, prefix, quotient_bits, skip_bits)
        more = counts > 1
        return pd.DataFrame({"print": prints[more].view(np.int64), "n": counts[more].astype(np.int64)})

    return made.groupBy("range").applyInPandas(merge, "print long, n long")


# --- documents --------------------------------------------------------------


def normal(docs: DataFrame, columns: list[str], with_text: bool) -> DataFrame:
    """``columns`` (longs) and, of the lower-cased text, fingerprint, hash and perhaps itself."""
    fields = [(c, pa.int64()) for c in columns] + [("print", pa.int64())]
    fields += [("normal", pa.binary())] if with_text else [("text_sha256", pa.string())]
    schema = pa.schema(fields)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [t.lower() for t in as_bytes(batch)]
            prints = np.array([xxhash.xxh3_64_intdigest(t) for t in texts], np.uint64)
            rows = {c: batch.column(c) for c in columns} | {"print": prints.view(np.int64)}
            if with_text:
                rows["normal"] = texts
            else:
                rows["text_sha256"] = [hashlib.sha256(t).hexdigest() for t in texts]
            yield arrow(rows, schema)

    types = {"int64": "long", "binary": "binary", "string": "string"}
    ddl = ", ".join(f"{f.name} {types[str(f.type)]}" for f in schema)
    return docs.select(*columns, "text").mapInArrow(read, ddl)


def groups(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Each row of ``docs`` (row, doc_id, text) with keep_id, group_size, kept, text_sha256."""
    rows = scratch(spark, normal(docs, ["row", "doc_id"], with_text=False), "prints")
    n = rows.count()
    made = repeated(filters(rows, n), n).select("print")
    many = scratch(spark, made, "repeated")
    sent = if_small(many, many.count(), 16)
    # Byte verification: texts of one fingerprint are one group only if they are equal.
    same = (
        normal(docs, ["doc_id"], with_text=True)
        .join(sent, "print", "left_semi")
        .groupBy("print", "normal")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select(F.sha2("normal", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    # Which of the rows with the largest id: the one with the largest number.
    last = (
        rows.join(sent, "print", "left_semi")
        .groupBy("text_sha256")
        .agg(F.max(F.struct("doc_id", "row")).alias("last"))
        .select("text_sha256", F.col("last.row").alias("keep_row"))
    )
    verified = scratch(spark, same.join(last, "text_sha256"), "verified")
    found = if_small(verified, verified.count(), 120)
    copied = F.col("group_size").isNotNull()
    return rows.join(found, "text_sha256", "left").select(
        "row",
        "doc_id",
        F.when(copied, F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(True)).alias("kept"),
        "text_sha256",
    )


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("row", F.monotonically_increasing_id())
    return groups(spark, docs).drop("row")


def deduplicated(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One document of each group of equal texts, with its columns."""
    prepare(spark)
    row = fresh_name(docs, "_row")
    kept = numbered(spark, docs, row)
    decided = groups(spark, kept.select(F.col(row).alias("row"), "doc_id", "text"))
    gone = scratch(spark, decided.filter(~F.col("kept")).select(F.col("row").alias(row)), "copies")
    return kept.join(if_small(gone, gone.count(), 16), row, "left_anti").select(*docs.columns)


OP10_SQL = """
WITH hashed AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
    FROM documents
), numbered AS (
    SELECT *, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
           count(*) OVER (PARTITION BY text_sha256) AS group_size,
           row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) AS place
    FROM hashed
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM numbered
"""
