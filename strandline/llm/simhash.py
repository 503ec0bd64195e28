"""Near duplicates by SimHash and bit-sliced comparison.

A text's fingerprint has a bit set where more than half of its shingles' hashes
have it. Fingerprints that differ in at most ``radius`` bits are linked, and the
linked are one component. Copies share a fingerprint, so only distinct
fingerprints are compared.

Candidates are exact. Cut into ``radius + agree`` blocks of bits, two linked
fingerprints agree in at least ``agree`` whole blocks; so there is one table for
each choice of ``agree`` blocks, and only rows of one table with equal bits in
them meet. ``agree`` is the smallest number that keeps the expected bucket small.
A bucket that is crowded all the same is cut into tiles, each pair of tiles being
a bucket of its own.

A task compares many buckets at once. It keeps bit ``b`` of all its rows in plane
``b``; a plane against itself, shifted by ``d`` rows, gives one bit of the
distance of 64 pairs a word. Carry-save counters add such bits up, and words in
which all pairs are beyond the radius are dropped on the way. A task reports a
spanning star of what it linked, never all pairs. Components grow from these
links by alternating large-star and small-star steps, each written to the shared
folder.

Defined cases: null and empty texts, or texts without a word, have fingerprint
zero, which links like any other; texts shorter than a shingle are one shingle;
the component's id is its smallest id that is not null, null if there is none;
an empty table gives an empty result; ``deduplicated`` keeps of each component
the row with the smallest id, of equal ones one, and returns all columns.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
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
)

SHINGLE, RADIUS, SEED = 4, 4, 42
#: Rows that one comparing task holds, rows of the largest bucket that is left
#: whole, and the expected rows of a bucket.
TASK_ROWS, TILE_ROWS, BUCKET_ROWS = 100_000, 8_192, 256
#: Words of 64 pairs compared at once, and planes added between two looks at them.
LIVE_WORDS, LOOK = 1 << 15, 8


# --- fingerprints -----------------------------------------------------------


def fingerprint(text: bytes, width: int = SHINGLE, seed: int = SEED) -> int:
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    ahead = [words[i:] for i in range(width)] if len(words) >= width else [[b" ".join(words)]]
    totals, at = np.zeros(64, np.int64), iter(zip(*ahead))
    for start in range(0, n, 1 << 14):
        size = min(n - start, 1 << 14)
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(b" ".join(next(at)), seed) for _ in range(size)), "<u8", size
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        totals += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * totals > n, bitorder="little").view("<u8")[0])


def prints(docs: DataFrame, columns: list[str], width: int = SHINGLE) -> DataFrame:
    """``columns`` (longs) and the fingerprint of each text, as a signed long."""
    schema = pa.schema([(c, pa.int64()) for c in [*columns, "print"]])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([fingerprint(t, width) for t in as_bytes(batch)], np.uint64)
            yield arrow({c: batch.column(c) for c in columns} | {"print": found.view(np.int64)}, schema)

    return docs.select(*columns, "text").mapInArrow(read, ", ".join(f"{f.name} long" for f in schema))


# --- comparison -------------------------------------------------------------


def masks(radius: int, agree: int) -> list[int]:
    """The bits of each table: all choices of ``agree`` of the blocks."""
    edges = [64 * i // (radius + agree) for i in range(radius + agree + 1)]
    blocks = [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(blocks, agree)]


def tables_for(rows: int, radius: int) -> list[int]:
    agree = 1
    while agree < 6 and rows >> min(m.bit_count() for m in masks(radius, agree)) > BUCKET_ROWS:
        agree += 1
    return masks(radius, agree)


def linked(prints: np.ndarray, bucket: np.ndarray, radius: int) -> np.ndarray:
    """For each row the first row it is linked to, over links within a bucket.

    ``bucket`` is sorted by size, largest first, so that the rows that still have
    a partner ``d`` places on are the first ones.
    """
    n = len(prints)
    root = np.arange(n)
    if n < 2:
        return root
    words = n // 64 + 2
    bits = np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.zeros((64, words), np.uint64)
    for b in range(64):
        packed = np.packbits(bits[:, b], bitorder="little")
        planes[b].view(np.uint8)[: len(packed)] = packed
    del bits
    sizes = np.bincount(bucket)[bucket]
    levels = max(1, radius.bit_length())
    start = (1 << levels) - radius - 1  # so that radius + 1 differences overflow

    def compare(at: np.ndarray, by: np.ndarray, same: np.ndarray) -> None:
        """Words ``at`` against the rows ``by`` places on; ``same``: pairs that count."""
        far, low = by >> 6, (by & 63).astype(np.uint64)
        high = np.uint64(63) - low
        one = np.uint64(1)
        counters = [np.full(len(at), (2**64 - 1) * (start >> k & 1), np.uint64) for k in range(levels)]
        over = ~same
        for b in range(64):
            plane = planes[b]
            other = (plane[at + far] >> low) | ((plane[np.minimum(at + far + 1, words - 1)] << one) << high)
            carry = plane[at] ^ other
            for k in range(levels):
                counters[k], carry = counters[k] ^ carry, counters[k] & carry
            over |= carry
            if b % LOOK == LOOK - 1:
                live = np.flatnonzero(~over)
                if len(live) < len(at):
                    if not len(live):
                        return
                    at, far, low, high, by, over = (x[live] for x in (at, far, low, high, by, over))
                    counters = [c[live] for c in counters]
        hits = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        word, bit = np.nonzero(hits)
        left = at[word] * 64 + bit
        join(left, left + by[word])

    def join(left: np.ndarray, right: np.ndarray) -> None:
        nonlocal root
        while True:
            a, b = root[left], root[right]
            if (differ := a != b).sum() == 0:
                return
            a, b, left, right = a[differ], b[differ], left[differ], right[differ]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root != root[root]).any():
                root = root[root]

    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    held_words = 0
    for d in range(1, int(sizes.max())):
        reach = int(np.searchsorted(-sizes, -d))  # rows in buckets of more than d
        pairs = np.packbits(bucket[: reach - d] == bucket[d:reach], bitorder="little")
        same = np.zeros(-(-len(pairs) // 8), np.uint64)
        same.view(np.uint8)[: len(pairs)] = pairs
        at = np.flatnonzero(same)
        held.append((at, np.full(len(at), d), same[at]))
        held_words += len(at)
        if held_words >= LIVE_WORDS:
            compare(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held, held_words = [], 0
    if held_words:
        compare(*(np.concatenate(x) for x in zip(*held, strict=True)))
    return root


def links(spark: SparkSession, distinct: DataFrame, rows: int, radius: int = RADIUS) -> DataFrame:
    """Links (a > b) between distinct fingerprints that join all pairs within the radius."""
    tables = tables_for(rows, radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in tables]
    held = F.array(
        *[
            F.struct(F.lit(t).alias("t"), F.col("print").bitwiseAND(F.lit(m).cast("long")).alias("key"))
            for t, m in enumerate(signed)
        ]
    )
    placed = distinct.select("print", F.explode(held).alias("at")).select("print", "at.*")
    crowded = scratch(
        spark,
        placed.groupBy("t", "key").agg(F.count("*").alias("n")).filter(F.col("n") > TILE_ROWS),
        "crowded",
    )
    parts = crowded.select("t", "key", F.ceil(F.col("n") * 2 / TILE_ROWS).cast("int").alias("parts"))
    mine = F.pmod(F.xxhash64("print"), F.col("parts")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: j != F.col("mine"))
    tiles = F.when(
        F.col("parts") > 1,
        F.transform(
            others,
            lambda j: F.struct(F.least("mine", j).alias("x"), F.greatest("mine", j).alias("y")),
        ),
    ).otherwise(F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y"))))
    # Rows to compare once crowded buckets are cut: each of theirs goes to all tiles of its part.
    n_crowded, more = crowded.join(parts, ["t", "key"]).select(
        F.count("*"), F.coalesce(F.sum(F.col("n") * (F.col("parts") - 2)), F.lit(0))
    ).first()
    tasks = max(32, (rows * len(tables) + more) // TASK_ROWS + 1)
    ready = (
        placed.join(if_small(parts, n_crowded, 24), ["t", "key"], "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("mine", mine)
        .select("print", "t", "key", F.explode(tiles).alias("tile"))
        .select(
            "print",
            F.xxhash64("t", "key", "tile.x", "tile.y").alias("bucket"),
            F.pmod(F.xxhash64("t", "key", "tile.x", "tile.y"), F.lit(tasks)).alias("task"),
        )
    )

    def compare(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        # Buckets are told apart by a hash; should two share it, more is compared, not less.
        _, bucket, size = np.unique(group["bucket"], return_inverse=True, return_counts=True)
        keep = size[bucket] > 1
        own, bucket = group["print"].to_numpy()[keep], bucket[keep]
        order = np.lexsort((own, bucket, -size[bucket]))
        own, bucket = own[order], bucket[order]
        root = linked(own.view(np.uint64), bucket, radius)
        found = pd.DataFrame({"a": own, "b": own[root]})
        found = found[found["a"] != found["b"]]
        low, high = found.min(axis=1), found.max(axis=1)
        return pd.DataFrame({"a": high, "b": low}).drop_duplicates()

    return ready.groupBy("task").applyInPandas(compare, "a long, b long").distinct()


# --- components -------------------------------------------------------------


def stars(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Each node but the smallest of its component (a), with that smallest (b)."""

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()

    edges = scratch(spark, edges, "links")
    now = state(edges)
    while now[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least"))
        large = (
            edges.select(F.col("b").alias("a"), F.col("a").alias("far"))
            .join(least, "a")
            .select(F.col("far").alias("a"), F.least("a", "least").alias("b"))
            .distinct()
        )
        low = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(low, "a").select(
            F.explode(
                F.array(
                    F.struct(F.col("a"), F.col("least").alias("b")),
                    F.struct(F.col("b").alias("a"), F.col("least").alias("b")),
                )
            ).alias("e")
        )
        edges = scratch(spark, small.select("e.*").filter("a != b").distinct(), "stars")
        before, now = now, state(edges)
        if now == before:
            break
    return edges


def components(spark: SparkSession, rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """For each distinct ``print`` of rows (doc_id, print): root and component_id."""
    distinct = scratch(
        spark, rows.groupBy("print").agg(F.min("doc_id").alias("least")), "distinct-prints"
    )
    n = distinct.count()
    tree = stars(spark, links(spark, distinct, n, radius)).withColumnsRenamed({"a": "print", "b": "root"})
    member = distinct.join(tree, "print", "left").withColumn("root", F.coalesce("root", "print"))
    # Only components of several prints are looked up; of the others the print knows all.
    ids = member.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n")).filter("n > 1")
    ids = scratch(spark, ids.drop("n"), "component-ids")
    own = F.coalesce("component_id", "least").alias("component_id")
    found = member.join(if_small(ids, ids.count(), 16), "root", "left").select("print", "root", own)
    found = scratch(spark, found, "components")
    return if_small(found, n, 24)


def hexadecimal(print: str) -> Column:
    return F.lower(F.lpad(F.hex(print), 16, "0"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scratch(spark, prints(documents(spark, sf_dir), ["doc_id"]), "simhash")
    return rows.join(components(spark, rows), "print").select(
        "doc_id", hexadecimal("print").alias("fingerprint"), "component_id"
    )


def deduplicated(
    spark: SparkSession, docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """One document of each component, with its columns."""
    prepare(spark)
    row = fresh_name(docs, "_row")
    kept = numbered(spark, docs, row)
    rows = scratch(
        spark, prints(kept.select(F.col(row).alias("row"), "doc_id", "text"), ["row", "doc_id"], width), "simhash"
    )
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    member = rows.join(components(spark, rows, radius), "print")
    first = member.groupBy("root").agg(F.min(place).alias("first")).select(F.col("first.row").alias(row))
    gone = scratch(
        spark, rows.select(F.col("row").alias(row)).join(first, row, "left_anti"), "near-copies"
    )
    return kept.join(if_small(gone, gone.count(), 16), row, "left_anti").select(*docs.columns)
