"""Approximate cosine search in cells that are trained on the vectors themselves.

A bounded sample gives the centres of the cells and, for what is left of a vector beside
its centre, sixteen small codebooks: a vector is kept as it is and as a code of a byte a
part. A search scans the codes of the cells nearest to a question, a sixteenth of the
bytes of 64 floats, and compares only the likeliest candidates exactly. How many cells and
candidates that takes is measured when the index is built, on questions from the sample
against all vectors.

All vectors are indexed; only training is bounded. Vectors that are null, or hold a null
or non-finite component, are left out. A collection without any can't be trained on, and
``build`` raises ``ValueError``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.operators import retrieval
from strandline.operators.retrieval import DISTANCE_DIGITS, TOP_K
from strandline.session import shared_dir
from strandline.sources.tables import balanced

# Vectors that centres and codebooks are trained on, about, and at least so many a centre.
SAMPLE, SAMPLE_PER_CELL = 65_536, 16
PARTS, ENTRIES, ROUNDS = 16, 256, 8
# Questions that probes and candidates are measured with, and the shares of their
# neighbours that must lie in the cells asked, and be found at last.
TRIALS, TARGET_IN_CELLS, TARGET_RECALL = 128, 0.985, 0.97
_CELLS, _BOOKS, _SETTINGS = "cells", "books", "settings"
# The centres of the cells stand beside the codebooks under this part.
_CENTRES = -1
_HASHES = 1 << 30
_AT_ONCE = 4_000_000


@dataclass(frozen=True)
class TrainedIndex:
    path: str
    rows: DataFrame  # vector_id, vector, code, cell
    centres: np.ndarray
    books: list[np.ndarray]
    probes: int
    candidates: int

    @property
    def cells(self) -> int:
        return len(self.centres)


def _closeness(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Larger for nearer centres, in the order of the squared distance."""
    return points @ centres.T - 0.5 * np.einsum("ij,ij->i", centres, centres)


def _closest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    step = max(1, _AT_ONCE // len(centres))
    pieces = [
        np.argmax(_closeness(points[at : at + step], centres), axis=1) for at in range(0, len(points), step)
    ]
    return np.concatenate(pieces) if pieces else np.zeros(0, dtype=int)


def _means(points: np.ndarray, entries: int) -> np.ndarray:
    """k-means; entries that nothing is near stay where they were."""
    distinct = np.unique(points, axis=0)
    if len(distinct) <= entries:
        return distinct
    centres = distinct[np.random.default_rng(17).choice(len(distinct), entries, replace=False)]
    for _ in range(ROUNDS):
        own = _closest(points, centres)
        counts = np.bincount(own, minlength=entries)[:, None]
        sums = np.stack([np.bincount(own, column, entries) for column in points.T], axis=1)
        centres = np.where(counts > 0, sums / np.maximum(counts, 1), centres)
    return centres


def _cuts(dimensions: int) -> list[slice]:
    edges = np.linspace(0, dimensions, min(PARTS, dimensions) + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]


_ENTRY = "part int, entry int, centre array<double>"


def _trained(entries: int):
    """The group function: the codebook of one part of the sample."""

    def run(rows: pa.Table) -> pa.Table:
        part = rows.column("part")[0].as_py()
        # In the order of ids, so that a task that runs again trains the same book.
        made = _means(retrieval._matrix(rows.sort_by("vector_id")), entries)
        return pa.table(
            [
                pa.array([part] * len(made), pa.int32()),
                pa.array(range(len(made)), pa.int32()),
                pa.array(made.tolist(), pa.list_(pa.float64())),
            ],
            names=["part", "entry", "centre"],
        )

    return run


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            unit = retrieval._unit(retrieval._matrix(pa.Table.from_batches([batch])))
            vectors = pa.array(list(unit), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("vector_id"), vectors], names=["vector_id", "vector"])


def _pieces(centres: np.ndarray):
    """What is left of each vector beside its centre, cut into parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = retrieval._matrix(pa.Table.from_batches([batch]))
            left = unit - centres[_closest(unit, centres)]
            for part, cut in enumerate(_cuts(unit.shape[1])):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(left), pa.int32()),
                        batch.column("vector_id"),
                        pa.array(list(np.ascontiguousarray(left[:, cut])), pa.list_(pa.float64())),
                    ],
                    names=["part", "vector_id", "vector"],
                )

    return run


def _encoded(centres: np.ndarray, books: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = retrieval._unit(retrieval._matrix(pa.Table.from_batches([batch])))
            cells = _closest(unit, centres)
            left = unit - centres[cells]
            cuts = _cuts(unit.shape[1])
            codes = np.stack([_closest(left[:, c], b) for c, b in zip(cuts, books, strict=True)], axis=1)
            made = pa.array([code.tobytes() for code in codes.astype(np.uint8)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vector_id"), batch.column("vector"), made, pa.array(cells.astype("int32"))],
                names=["vector_id", "vector", "code", "cell"],
            )

    return run


def _whole(vectors: DataFrame) -> DataFrame:
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    rows = retrieval._fresh(vectors, "vector_id", "vector")
    return rows.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & F.forall("vector", finite))


def _write(rows: DataFrame, path: str, centres: np.ndarray, books: list[np.ndarray], mode: str) -> None:
    kind = rows.schema["vector"].dataType.simpleString()
    coded = rows.mapInArrow(_encoded(centres, books), f"vector_id bigint, vector {kind}, code binary, cell int")
    balanced(coded, "cell").write.mode(mode).partitionBy("cell").parquet(f"{path}/{_CELLS}")


def _books(spark: SparkSession, path: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """The centres and the codebooks: at most SAMPLE / SAMPLE_PER_CELL and PARTS * ENTRIES rows."""
    by_part: dict[int, list] = {}
    for row in spark.read.parquet(path).orderBy("part", "entry").collect():
        by_part.setdefault(row.part, []).append(row.centre)
    centres = np.array(by_part.pop(_CENTRES))
    return centres, [np.array(by_part[part]) for part in sorted(by_part)]


def build(
    vectors: DataFrame,
    path: str,
    per_cell: int = retrieval.VECTORS_PER_CELL,
    k: int = TOP_K,
    sample: int = SAMPLE,
    target: float = TARGET_RECALL,
) -> TrainedIndex:
    """Train cells and codes, write all vectors into them, and measure what a search asks.

    ``vectors`` has ``vector_id`` (unique) and ``vector``. There are about ``per_cell``
    vectors a cell, more where the sample would have under ``SAMPLE_PER_CELL`` a centre.
    Probes and candidates are counted for ``k`` neighbours and the share ``target``.
    """
    spark, rows = vectors.sparkSession, _whole(vectors)
    total = rows.count()
    if not total:
        raise ValueError("no vectors to train on")
    drawn = shared_dir(spark, "trained-sample")
    taken = rows
    if total > sample:
        taken = rows.where(F.pmod(F.xxhash64("vector_id"), F.lit(_HASHES)) < int(_HASHES * sample / total))
    taken.mapInArrow(_units, "vector_id bigint, vector array<double>").write.parquet(drawn)
    units = spark.read.parquet(drawn)
    cells = max(1, min(ceil(total / per_cell), min(total, sample) // SAMPLE_PER_CELL))
    books = f"{path}/{_BOOKS}"
    grouped = units.select(F.lit(_CENTRES).alias("part"), "vector_id", "vector").groupBy("part")
    grouped.applyInArrow(_trained(cells), _ENTRY).write.mode("error").parquet(books)
    centres = _books(spark, books)[0]
    pieces = units.mapInArrow(_pieces(centres), "part int, vector_id bigint, vector array<double>")
    pieces.groupBy("part").applyInArrow(_trained(ENTRIES), _ENTRY).write.mode("append").parquet(books)
    _write(rows, path, *_books(spark, books), "error")
    return measure(spark, path, units, k, target)


def add(spark: SparkSession, path: str, vectors: DataFrame) -> None:
    """Append vectors to the cells that are there; ``measure`` again where many came."""
    _write(_whole(vectors), path, *_books(spark, f"{path}/{_BOOKS}"), "append")


def _opened(spark: SparkSession, path: str, probes: int, candidates: int) -> TrainedIndex:
    cells = f"{path}/{_CELLS}"
    kind = spark.read.parquet(cells).schema["vector"].dataType.simpleString()
    rows = spark.read.schema(f"vector_id bigint, vector {kind}, code binary, cell int").parquet(cells)
    return TrainedIndex(path, rows, *_books(spark, f"{path}/{_BOOKS}"), probes, candidates)


def open_index(spark: SparkSession, path: str) -> TrainedIndex:
    """The index with what was measured last."""
    last = spark.read.parquet(f"{path}/{_SETTINGS}").orderBy(F.desc("version")).first()
    return _opened(spark, path, last.probes, last.candidates)


def _codes(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    codes = column.to_pylist()
    return np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1)


def _scores(asked: np.ndarray, centres: np.ndarray, books: list[np.ndarray], codes: np.ndarray) -> np.ndarray:
    """Cosines of questions and coded vectors; ``centres`` has a row for each vector, or one."""
    scores = np.broadcast_to(asked @ centres.T, (len(asked), len(codes))).copy()
    for part, (cut, book) in enumerate(zip(_cuts(asked.shape[1]), books, strict=True)):
        scores += (asked[:, cut] @ book.T)[:, codes[:, part]]
    return np.round(scores, DISTANCE_DIGITS)


def _ahead(asked: np.ndarray, probed: np.ndarray, bars: np.ndarray, centres: np.ndarray, books: list[np.ndarray]):
    """How many codes of the cells a question asks score as high as each neighbour's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ahead = np.zeros(bars.shape, dtype=np.int64)
        step = max(1, _AT_ONCE // max(1, len(asked)))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                piece = batch.slice(at, step)
                cells = np.asarray(piece.column("cell"))
                scores = _scores(asked, centres[cells], books, _codes(piece.column("code")))
                scores[~probed[:, cells]] = -np.inf
                for rank in range(bars.shape[1]):
                    ahead[:, rank] += (scores >= bars[:, rank, None]).sum(axis=1)
        spots = np.indices(bars.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(spots[0]), pa.array(spots[1]), pa.array(ahead.ravel())], names=["asked", "rank", "ahead"]
        )

    return run


def _share(values: np.ndarray, share: float) -> int:
    """The least bound that ``share`` of the values keep."""
    return int(np.sort(values)[min(len(values) - 1, ceil(share * len(values)) - 1)])


def measure(
    spark: SparkSession, path: str, sample: DataFrame, k: int = TOP_K, target: float = TARGET_RECALL
) -> TrainedIndex:
    """Count probes and candidates on questions of ``sample``, and keep them in the index.

    The questions' neighbours are searched exactly among all vectors, without the
    question's own. Then all codes are read once: a neighbour is found by as many
    candidates as there are codes in the cells asked that score as high as its own.
    """
    index = _opened(spark, path, 1, 1)
    trials = sample.orderBy(F.xxhash64("vector_id", F.lit(5)), "vector_id").limit(TRIALS)
    trials = trials.select(F.col("vector_id").alias("query_id"), "vector")
    questions = {row.query_id: row.vector for row in trials.collect()}
    exact = retrieval.knn_cosine(index.rows, trials, k + 1).where("vector_id <> query_id")
    # At most TRIALS * (k + 1) rows.
    near = F.broadcast(exact.select("query_id", "vector_id", "rank"))
    found = index.rows.select("vector_id", "cell", "code").join(near, "vector_id").collect()
    probes, candidates = index.cells, k
    if found:
        ids = sorted(questions)
        asked = retrieval._unit(np.array([questions[i] for i in ids]))
        order = np.argsort(-np.round(_closeness(asked, index.centres), DISTANCE_DIGITS), axis=1, kind="stable")
        place = np.argsort(order, axis=1)
        spot = {i: at for at, i in enumerate(ids)}
        depth = np.array([place[spot[r.query_id], r.cell] + 1 for r in found])
        probes = _share(depth, max(target, TARGET_IN_CELLS))
        bars, at_rank = np.full((len(ids), k + 1), np.inf), []
        for row in found:
            code = np.frombuffer(bytes(row.code), np.uint8)[None]
            at = spot[row.query_id]
            bars[at, row["rank"] - 1] = _scores(asked[at : at + 1], index.centres[[row.cell]], index.books, code)[0, 0]
            at_rank.append((at, row["rank"] - 1))
        counted = index.rows.select("cell", "code").mapInArrow(
            _ahead(asked, place < probes, bars, index.centres, index.books), "asked bigint, rank bigint, ahead bigint"
        )
        ahead = {(r.asked, r["rank"]): r.ahead for r in counted.groupBy("asked", "rank").agg(
            F.sum("ahead").alias("ahead")).collect()}
        # Those outside the cells asked are found by no number of candidates.
        counts = np.sort([ahead[s] if d <= probes else np.inf for s, d in zip(at_rank, depth, strict=True)])
        counts = counts[np.isfinite(counts)]
        candidates = max(k, int(counts[min(len(counts), ceil(target * len(found))) - 1]))
    settings = f"{path}/{_SETTINGS}"
    version = 0
    if _exists(spark, settings):
        version = spark.read.parquet(settings).agg(F.max("version")).first()[0] + 1
    kept = spark.createDataFrame([(version, probes, candidates)], "version int, probes int, candidates int")
    kept.coalesce(1).write.mode("append").parquet(settings)
    return open_index(spark, path)


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def _asks(centres: np.ndarray, probes: int):
    """Each question once for each of the cells nearest to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = retrieval._unit(retrieval._matrix(pa.Table.from_batches([batch])))
            close = np.round(_closeness(unit, centres), DISTANCE_DIGITS)
            cells = np.argsort(-close, axis=1, kind="stable")[:, :probes]
            asked = batch.take(pa.array(np.repeat(np.arange(len(unit)), cells.shape[1])))
            yield pa.RecordBatch.from_arrays(
                [*asked.columns, pa.array(cells.ravel().astype("int32"))], names=["query_id", "vector", "cell"]
            )

    return run


def _likeliest(centres: np.ndarray, books: list[np.ndarray], candidates: int):
    """The group function: the codes of a cell that score highest for each question."""

    def run(questions: pa.Table, rows: pa.Table) -> pa.Table:
        found = ([], [], [], [])
        if questions.num_rows and rows.num_rows:
            cell = rows.column("cell")[0].as_py()
            asked, ids = retrieval._unit(retrieval._matrix(questions)), np.asarray(questions.column("query_id"))
            codes, vector_ids = _codes(rows.column("code")), np.asarray(rows.column("vector_id"))
            step = max(1, _AT_ONCE // len(codes))
            for start in range(0, len(ids), step):
                scores = _scores(asked[start : start + step], centres[[cell]], books, codes)
                for at, row in zip(ids[start : start + step], scores, strict=True):
                    near = np.arange(len(row))
                    if len(row) > candidates:
                        near = np.flatnonzero(row >= -np.partition(-row, candidates - 1)[candidates - 1])
                    near = near[np.lexsort((vector_ids[near], -row[near]))[:candidates]]
                    found[0].append(np.full(len(near), at))
                    found[1].append(vector_ids[near])
                    found[2].append(np.full(len(near), cell))
                    found[3].append(row[near])
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.float64())
        columns = [pa.array(np.concatenate(x) if x else [], t) for x, t in zip(found, kinds, strict=True)]
        return pa.table(columns, names=["query_id", "vector_id", "cell", "score"])

    return run


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sides = [
            retrieval._unit(retrieval._matrix(pa.table({"vector": batch.column(name)})))
            for name in ("question", "vector")
        ]
        distances = np.round(1.0 - np.einsum("ij,ij->i", *sides), DISTANCE_DIGITS)
        yield pa.RecordBatch.from_arrays(
            [batch.column("query_id"), batch.column("vector_id"), pa.array(distances)],
            names=["query_id", "vector_id", "distance"],
        )


def search(
    index: TrainedIndex,
    questions: DataFrame,
    k: int = TOP_K,
    probes: int | None = None,
    candidates: int | None = None,
) -> DataFrame:
    """Like ``retrieval.knn_cosine``, by ``candidates`` codes of the ``probes`` nearest cells.

    Both are by default as measured for the index. With as many probes as cells and as
    many candidates as vectors the result is the exact one. The first pass reads ids and
    codes only; vectors are read for the candidates, joined by cell and id.
    """
    probes, candidates = probes or index.probes, max(k, candidates or index.candidates)
    whole = _whole(questions.withColumnRenamed("query_id", "vector_id"))
    asked = whole.select(F.col("vector_id").alias("query_id"), "vector")
    kind = asked.schema["vector"].dataType.simpleString()
    spread = asked.mapInArrow(_asks(index.centres, probes), f"query_id bigint, vector {kind}, cell int")
    codes = retrieval._fresh(index.rows, "vector_id", "code", "cell")
    parts = retrieval._counted(codes.select("cell"), "parts", retrieval.VECTORS_PER_GROUP)
    blocks = retrieval._counted(spread.select("cell"), "blocks", retrieval.QUESTIONS_PER_GROUP)
    sizes = parts.join(blocks, "cell")
    block = retrieval._own("query_id", F.col("blocks"), "block")
    part = retrieval._own("vector_id", F.col("parts"), "part")
    left = spread.join(sizes, "cell").select(
        "query_id", "vector", "cell", block, retrieval._each(F.col("parts"), "part")
    )
    right = codes.join(sizes, "cell").select(
        "vector_id", "code", "cell", part, retrieval._each(F.col("blocks"), "block")
    )
    group = ["cell", "part", "block"]
    likeliest = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(
        _likeliest(index.centres, index.books, candidates),
        "query_id bigint, vector_id bigint, cell int, score double",
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vector_id")
    likeliest = likeliest.withColumn("place", F.row_number().over(best)).where(F.col("place") <= candidates)
    there = retrieval._fresh(index.rows, "vector_id", "vector", "cell")
    beside = retrieval._fresh(asked, "query_id", "vector").withColumnRenamed("vector", "question")
    pairs = likeliest.select("query_id", "vector_id", "cell").join(there, ["cell", "vector_id"]).join(beside, "query_id")
    return retrieval._rank(
        pairs.select("query_id", "vector_id", "question", "vector").mapInArrow(_compared, retrieval._FOUND), k
    )
