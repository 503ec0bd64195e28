"""Vector codes by product quantisation with ball k-means, in whole numbers.

A vector's components become floor(scale * x) and are cut into parts; each part position
has a codebook, refined by rounds of k-means. All sums, distances and comparisons are
whole numbers, so results don't depend on how rows are spread.

An entry with the parts assigned to it is a ball: its centre, and a radius no part of it
lies beyond. When entries move, a part still knows its ball. Another entry can be as near
as the own one only if its centre is at most twice the part's distance from the own
centre away. So an entry's neighbours are those at most twice its radius away; a part
nearer its centre than half the way to the nearest neighbour is in the stable core and
stays without another distance; any other lies in a ring, which is known from the sorted
distances between centres, and is compared with the neighbours up to that ring only. The
first round has no balls yet and compares with all entries.

A round is one pass over written rows: codes are found, written beside the vector, and
counts, sums and radii for each entry are summed up by Spark. Only codebooks (parts x
entries, a parameter) come to the driver.

Defined cases: rows whose vector is null or holds a null or non-finite component are
dropped, and so are empty vectors, lengths that the parts don't divide, and lengths other
than that of the first kept id; null ids come last, and rows of one id are in the order
of their components; repeated rows count each; with fewer rows than entries there are as
many entries as rows; ties go to the lower index; an empty table gives an empty result;
columns other than the three named are not looked at. Components beyond +-2^24 after
scaling are an error, since sums could leave 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import arrow, if_small, prepare, scratch

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: The largest component after scaling, so that 2^30 squared distances still fit.
LARGEST = 1 << 24


# --- one codebook -----------------------------------------------------------


@dataclass
class Balls:
    """Centres (entries x width) of one part position, with squared radii where known."""

    centres: np.ndarray
    radii: np.ndarray | None = None

    def __post_init__(self):
        gaps = squared(self.centres[:, None, :] - self.centres[None, :, :])
        k = len(gaps)
        gaps[np.arange(k), np.arange(k)] = -1
        self.order = np.argsort(gaps, axis=1, kind="stable")[:, 1:]
        self.gaps = np.take_along_axis(gaps, self.order, axis=1)
        if self.radii is None:
            self.neighbours = np.full(k, k - 1)
        else:
            self.neighbours = (self.gaps <= 4 * self.radii[:, None]).sum(axis=1)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each point's nearest centre, by all of them."""
        best = np.zeros(len(points), np.int64)
        least = squared(points - self.centres[0])
        for j in range(1, len(self.centres)):
            found = squared(points - self.centres[j])
            closer = found < least
            best[closer], least[closer] = j, found[closer]
        return best, least

    def moved(self, points: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """As ``nearest``, from the balls the points were in; also the distances worked out."""
        to_own = squared(points - self.centres[own])
        best, least, made = own.copy(), to_own.copy(), len(points)
        most = self.neighbours.max(initial=0)
        rows = np.flatnonzero(self.neighbours[own] > 0) if most else np.zeros(0, np.int64)
        for ring in range(most):
            home = own[rows]
            reached = (ring < self.neighbours[home]) & (self.gaps[home, ring] <= 4 * to_own[rows])
            rows = rows[reached]
            if not len(rows):
                break
            other = self.order[own[rows], ring]
            found = squared(points[rows] - self.centres[other])
            made += len(rows)
            closer = (found < least[rows]) | ((found == least[rows]) & (other < best[rows]))
            best[rows[closer]], least[rows[closer]] = other[closer], found[closer]
        return best, least, made


def squared(x: np.ndarray) -> np.ndarray:
    return np.einsum("...i,...i->...", x, x)


# --- rows -------------------------------------------------------------------


def whole(vectors: DataFrame, id: str, vector: str, label: str, parts: int, scale: int) -> DataFrame:
    """vec_id, label and whole components of the rows with a usable vector."""
    x = F.col(vector).cast("array<double>")
    fine = F.col(vector).isNotNull() & (F.size(vector) > 0) & (F.size(vector) % parts == 0)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    in_reach = F.forall(x, lambda c: F.abs(c * scale) <= LARGEST)
    error = F.raise_error(F.lit(f"a component is beyond {LARGEST} after scaling")).cast("array<bigint>")
    scaled = F.transform(x, lambda c: F.floor(c * scale).cast("bigint"))
    return vectors.filter(fine & F.coalesce(finite, F.lit(False))).select(
        F.col(id).cast("bigint").alias("vec_id"),
        F.col(label).alias("label"),
        F.when(in_reach, scaled).otherwise(error).alias("parts"),
    )


def matrix(batch: pa.RecordBatch, parts: int) -> np.ndarray:
    """The components as rows x parts x width."""
    flat = pc.list_flatten(batch.column("parts")).to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, parts, -1)


def coded(rows: DataFrame, books: list[Balls], label_type: str, known: bool) -> DataFrame:
    """The rows with code (one byte a part) and error; ``known``: they have a code from before."""
    parts = len(books)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points = matrix(batch, parts)
            codes = np.empty((batch.num_rows, parts), np.uint8)
            error = np.zeros(batch.num_rows, np.int64)
            if known:
                before = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, parts)
            for p, book in enumerate(books):
                if known:
                    best, least, _ = book.moved(points[:, p], before[:, p].astype(np.int64))
                else:
                    best, least = book.nearest(points[:, p])
                codes[:, p] = best
                error += least
            columns = [batch.column(c) for c in ("vec_id", "label", "parts")]
            columns += [pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "parts", "code", "error"])

    kept = ["vec_id", "label", "parts", *(["code"] if known else [])]
    schema = f"vec_id bigint, label {label_type}, parts array<bigint>, code binary, error bigint"
    return rows.select(*kept).mapInArrow(assign, schema)


def contents(rows: DataFrame, books: list[Balls]) -> DataFrame:
    """part, entry, n, sums and the largest squared distance of the parts with each code."""
    parts, entries = len(books), len(books[0].centres)
    schema = pa.schema(
        [("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64())), ("far", pa.int64())]
    )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = sums = far = None
        for batch in batches:
            if not batch.num_rows:
                continue
            points = matrix(batch, parts)
            codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, parts)
            if n is None:
                n = np.zeros((parts, entries), np.int64)
                sums = np.zeros((parts, entries, points.shape[2]), np.int64)
                far = np.zeros((parts, entries), np.int64)
            for p, book in enumerate(books):
                own = codes[:, p].astype(np.int64)
                n[p] += np.bincount(own, minlength=entries)
                np.add.at(sums[p], own, points[:, p])
                np.maximum.at(far[p], own, squared(points[:, p] - book.centres[own]))
        if n is not None:
            used = np.argwhere(n > 0)
            at = tuple(used.T)
            yield arrow(
                {"part": used[:, 0], "entry": used[:, 1], "n": n[at], "sums": sums[at].tolist(), "far": far[at]}, schema
            )

    made = rows.select("parts", "code").mapInArrow(add, "part int, entry int, n bigint, sums array<bigint>, far bigint")
    width = books[0].centres.shape[1]
    totals = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]
    return made.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.max("far").alias("far"), *totals)


def refined(rows: DataFrame, books: list[Balls]) -> list[Balls]:
    """Codebooks with each used entry at the floor of its parts' mean, and the new balls."""
    width = books[0].centres.shape[1]
    centres = [b.centres.copy() for b in books]
    radii = [np.zeros(len(b.centres), np.int64) for b in books]
    for r in contents(rows, books).collect():  # parts x entries rows at most
        old = centres[r.part][r.entry].copy()
        new = np.array([r[f"s{i}"] // r.n for i in range(width)], np.int64)
        centres[r.part][r.entry] = new
        # No farther than before plus the way the centre went; rounded up.
        away = np.ceil(np.sqrt(float(r.far)) + np.sqrt(float(squared(new - old)))) + 1
        radii[r.part][r.entry] = int(away) ** 2
    return [Balls(c, r) for c, r in zip(centres, radii, strict=True)]


@dataclass
class Codes:
    """Rows (vec_id, label, parts, code, error) and the codebooks of their codes."""

    rows: DataFrame
    books: list[Balls]

    def sha256(self) -> str:
        numbers = (str(x) for b in self.books for entry in b.centres.tolist() for x in entry)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def compressed(
    spark: SparkSession,
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> Codes:
    """Codes of all usable vectors; at most 256 entries."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte a part")
    prepare(spark)
    kept = scratch(spark, whole(vectors, id, vector, label, parts, scale), "vectors")
    label_type = kept.schema["label"].dataType.simpleString()
    order = [F.col("vec_id").asc_nulls_last(), F.col("parts")]
    first = kept.select("vec_id", "parts").orderBy(*order).limit(1).collect()
    if not first:
        return Codes(kept.withColumn("code", F.lit(b"")).withColumn("error", F.lit(0).cast("bigint")), [])
    size = len(first[0].parts)
    kept = kept.filter(F.size("parts") == size)
    seeds = kept.select("vec_id", "parts").orderBy(*order).limit(entries).collect()
    start = np.array([r.parts for r in seeds], np.int64).reshape(len(seeds), parts, -1)
    books = [Balls(start[:, p].copy()) for p in range(parts)]
    rows = kept
    for n in range(rounds):
        rows = scratch(spark, coded(rows, books, label_type, n > 0), "codes")
        books = refined(rows, books)
    return Codes(scratch(spark, coded(rows, books, label_type, rounds > 0), "codes"), books)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = prepare(spark).read.parquet(f"{sf_dir}/embeddings.parquet")
    found = compressed(spark, vectors)
    # A label is a key of a few: its sum is worked out first and then brought to its rows.
    sums = found.rows.groupBy("label").agg(F.sum("error").alias("label_error"))
    sums = scratch(spark, sums.withColumnRenamed("label", "own"), "labels")
    sums = if_small(sums, sums.count(), 64)
    same = F.col("label").eqNullSafe(F.col("own"))
    return found.rows.join(sums, same, "left").select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(found.sha256()).alias("codebooks_sha256"),
    )


def _sql() -> str:
    """The contract for vectors of one length, as plain rounds over all entries."""
    text = f"""
WITH kept AS (
    SELECT row_number() OVER (ORDER BY vec_id) AS place, vec_id, label,
           list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS xs
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
    SELECT place, vec_id, label, p, xs[p * len(xs) // {PARTS} + 1 : (p + 1) * len(xs) // {PARTS}] AS v
    FROM kept, range({PARTS}) AS r(p)
), book0 AS MATERIALIZED (
    SELECT p, place - 1 AS j, v AS c FROM parts WHERE place <= {ENTRIES}
)"""
    distance = "list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for r in range(ROUNDS + 1):
        text += f""", near{r} AS MATERIALIZED (
    SELECT place, vec_id, label, p, v, min({{'d': CAST({distance} AS BIGINT), 'j': j}}) AS best
    FROM parts JOIN book{r} USING (p) GROUP BY ALL
)"""
        if r < ROUNDS:
            text += f""", means{r} AS (
    SELECT p, j, list(m ORDER BY i) AS c
    FROM (
        SELECT p, best.j AS j, i, CAST(floor(sum(v[i]) / count(*)) AS BIGINT) AS m
        FROM (SELECT p, best, v, unnest(range(1, len(v) + 1)) AS i FROM near{r})
        GROUP BY ALL
    ) GROUP BY ALL
), book{r + 1} AS MATERIALIZED (
    SELECT p, j, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN means{r} m USING (p, j)
)"""
    return (
        text
        + f""", coded AS (
    SELECT place, vec_id, label, string_agg(printf('%02x', best.j), '' ORDER BY p) AS code,
           CAST(sum(best.d) AS BIGINT) AS error
    FROM near{ROUNDS} GROUP BY ALL
), books AS (
    SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, j)) AS codebooks_sha256 FROM book{ROUNDS}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded, books
"""
    )


OP12_SQL = _sql()
