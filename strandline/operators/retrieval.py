"""Cosine top-k: exact over all vectors, approximate over the likeliest cells.

The exact search deals vectors out over parts and questions over blocks; a group is a
bounded number of both, and one matrix product, of which at most k rows per question are
left. The approximate one has the collection in cells; a question goes to the cells it
asks, and crowded cells are cut into parts and blocks the same way. Nothing pairs
questions and vectors as rows, and neither side passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import ceil, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.session import shared_dir
from strandline.sources.tables import balanced

# Vectors and questions in one group.
VECTORS_PER_GROUP, QUESTIONS_PER_GROUP = 50_000, 2_048
# Distances held at once by a task.
_DISTANCES_AT_ONCE = 4_000_000
TOP_K = 3
DISTANCE_DIGITS = 12
# Vectors of a cell, on average.
VECTORS_PER_CELL = 4_096
# The share of the neighbours that the probes are counted for. Above the 0.9 that
# a search must find, as measured recall scatters by the questions asked.
TARGET_RECALL = 0.93
# Seeded questions by which probes are counted, and cells of theirs held at once.
_TRIAL_QUESTIONS, _TRIAL_CELLS = 256, 1 << 24
# Rows of questions and cells that leave a task at once; each row has the question's vector.
_ASKED_AT_ONCE = 16_384
# Neighbours that are sent to the chunks; more are joined by a shuffle.
_BROADCAST_ROWS = 100_000
# Where the parts of an index lie.
_CELLS, _PLANES = "cells", "planes"


def similarity(distance: Column) -> Column:
    return F.round(1 - distance, 3)


def _unit(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-30)


def _matrix(table: pa.Table) -> np.ndarray:
    flat = table.column("vector").combine_chunks()
    flat = flat.flatten() if not isinstance(flat, pa.ChunkedArray) else pa.concat_arrays(flat.chunks).flatten()
    return np.asarray(flat, dtype=np.float64).reshape(table.num_rows, -1)


def _top_k(k: int):
    """The group function: the best ``k`` of the vectors for each question."""

    def run(questions: pa.Table, vectors: pa.Table) -> pa.Table:
        found = ([], [], [])
        if questions.num_rows and vectors.num_rows:
            asked, ids = _unit(_matrix(questions)), np.asarray(questions.column("query_id"))
            matrix, vector_ids = _unit(_matrix(vectors)), np.asarray(vectors.column("vector_id"))
            step = max(1, _DISTANCES_AT_ONCE // len(matrix))
            for start in range(0, len(ids), step):
                # Rounded, so that copies of a vector tie in whichever group they are.
                distances = np.round(1.0 - asked[start : start + step] @ matrix.T, DISTANCE_DIGITS)
                for at, row in zip(ids[start : start + step], distances, strict=True):
                    # Everything tied with the k-th stays in until the vector ids decide.
                    near = np.arange(len(row))
                    if len(row) > k:
                        near = np.flatnonzero(row <= np.partition(row, k - 1)[k - 1])
                    near = near[np.lexsort((vector_ids[near], row[near]))[:k]]
                    found[0].append(np.full(len(near), at))
                    found[1].append(vector_ids[near])
                    found[2].append(row[near])
        kinds = (pa.int64(), pa.int64(), pa.float64())
        columns = [pa.array(np.concatenate(x) if x else [], t) for x, t in zip(found, kinds, strict=True)]
        return pa.table(columns, names=["query_id", "vector_id", "distance"])

    return run


def _rank(found: DataFrame, k: int) -> DataFrame:
    nearest = Window.partitionBy("query_id").orderBy("distance", "vector_id")
    return (
        found.withColumn("rank", F.row_number().over(nearest))
        .where(F.col("rank") <= k)
        .select("query_id", "vector_id", "rank", "distance", similarity(F.col("distance")).alias("similarity"))
    )


_FOUND = "query_id bigint, vector_id bigint, distance double"


def _own(column: str, parts: Column | int, name: str) -> Column:
    number = parts if isinstance(parts, Column) else F.lit(parts)
    return F.pmod(F.xxhash64(column), number).cast("int").alias(name)


def _each(number: Column | int, name: str) -> Column:
    number = number if isinstance(number, Column) else F.lit(number)
    return F.explode(F.sequence(F.lit(0), number - 1)).alias(name)


def _fresh(df: DataFrame, *columns: str) -> DataFrame:
    """The columns under new identities, so that a table can be searched for its own rows."""
    return df.select(*[F.col(c).alias(c) for c in columns])


def _met(questions: DataFrame, vectors: DataFrame, group: list[str], k: int) -> DataFrame:
    found = questions.groupBy(*group).cogroup(vectors.groupBy(*group)).applyInArrow(_top_k(k), _FOUND)
    return _rank(found, k)


def knn_cosine(vectors: DataFrame, questions: DataFrame, k: int = TOP_K) -> DataFrame:
    """The ``k`` vectors nearest to each question, ties by ``vector_id``.

    ``vectors`` has ``vector_id`` and ``vector``, ``questions`` has
    ``query_id`` and ``vector``. Columns: query_id, vector_id, rank, distance,
    similarity. Both are counted first; no vector is read for that.
    """
    parts = max(1, ceil(vectors.count() / VECTORS_PER_GROUP))
    blocks = max(1, ceil(questions.count() / QUESTIONS_PER_GROUP))
    known = F.col("vector").isNotNull()
    asked = _fresh(questions.where(known), "query_id", "vector").select(
        "query_id", "vector", _own("query_id", blocks, "block"), _each(parts, "part")
    )
    there = _fresh(vectors.where(known), "vector_id", "vector").select(
        "vector_id", "vector", _own("vector_id", parts, "part"), _each(blocks, "block")
    )
    return _met(asked, there, ["part", "block"], k)


def _counted(rows: DataFrame, name: str, each: int) -> DataFrame:
    return rows.groupBy("cell").agg(F.ceil(F.count("*") / each).cast("int").alias(name))


def _search(vectors: DataFrame, questions: DataFrame, k: int) -> DataFrame:
    """Top k where ``cell`` is equal; both sides have one."""
    vectors = _fresh(vectors, "vector_id", "vector", "cell")
    questions = _fresh(questions, "query_id", "vector", "cell")
    parts = _counted(vectors.select("cell"), "parts", VECTORS_PER_GROUP)
    blocks = _counted(questions.select("cell"), "blocks", QUESTIONS_PER_GROUP)
    sizes = parts.join(blocks, "cell")
    block, part = _own("query_id", F.col("blocks"), "block"), _own("vector_id", F.col("parts"), "part")
    asked = questions.join(sizes, "cell").select("query_id", "vector", "cell", block, _each(F.col("parts"), "part"))
    there = vectors.join(sizes, "cell").select("vector_id", "vector", "cell", part, _each(F.col("blocks"), "block"))
    return _met(asked, there, ["cell", "part", "block"], k)


def hyperplanes(dimensions: int, bits: int) -> np.ndarray:
    # Seeded, so that an index built again has the same cells; each keeps its own planes.
    return np.random.default_rng(20_240_229).standard_normal((bits, dimensions))


def bits_for(vectors: int, per_cell: int = VECTORS_PER_CELL) -> int:
    """Cells double with the collection, so that a cell's size stays the same."""
    return max(1, int(np.ceil(np.log2(max(vectors, 1) / per_cell))))


def _far_neighbour(vectors: int, dimensions: int, k: int) -> float:
    """The cosine that the k-th neighbour has among random vectors of any direction.

    Where vectors crowd, neighbours are nearer and share more sides.
    """
    at = np.linspace(-1, 1, 200_001)
    density = np.maximum(1 - at * at, 0) ** ((dimensions - 3) / 2) if dimensions > 2 else np.ones_like(at)
    above = np.cumsum(density[::-1])[::-1] / density.sum()
    return float(at[np.searchsorted(-above, -min(1.0, k / max(vectors, 1)))])


@lru_cache(64)
def probes_for(
    bits: int, dimensions: int, per_cell: int = VECTORS_PER_CELL, k: int = TOP_K, target: float = TARGET_RECALL
) -> int:
    """How many of the ``2 ** bits`` cells a question must ask to find ``target`` of
    its neighbours, on average.

    A neighbour at angle t of a question with margin m to a plane is on the same
    side with probability Phi(m / tan t); the product over the planes is its chance
    of being in a cell. The chances are summed in the order in which cells are
    asked, for seeded questions and the k-th neighbour of random vectors, which is
    the farthest that a collection of this size and dimension has to offer.
    """
    cells = 1 << bits
    cosine = _far_neighbour(cells * per_cell // 2, dimensions, k)
    if cosine <= 0:
        return cells
    slope = cosine / np.sqrt(max(1 - cosine * cosine, 1e-12))
    trials = max(8, min(_TRIAL_QUESTIONS, _TRIAL_CELLS // cells))
    margins = np.abs(np.random.default_rng(7).standard_normal((trials, bits)))
    found = np.zeros(cells)
    for row in margins:
        cost, chance = np.zeros(1), np.ones(1)
        for margin in row:
            same = 0.5 * (1 + erf(margin * slope / sqrt(2)))
            cost = np.concatenate([cost, cost + margin * margin])
            chance = np.concatenate([chance * same, chance * (1 - same)])
        found += np.cumsum(chance[np.argsort(cost, kind="stable")])
    return min(cells, int(np.searchsorted(found / trials, target)) + 1)


def _cell_numbers(planes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(planes.shape[0])
        for batch in batches:
            flat = np.asarray(batch.column("vector").flatten(), dtype=np.float64)
            sides = flat.reshape(batch.num_rows, -1) @ planes.T > 0
            cells = pa.array((sides @ weights).astype("int32"), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vector_id"), batch.column("vector"), cells],
                names=["vector_id", "vector", "cell"],
            )

    return run


@dataclass(frozen=True)
class VectorIndex:
    """A collection in cells, with the planes that make them, as they lie in the index."""

    rows: DataFrame  # vector_id, vector, cell
    planes: np.ndarray
    per_cell: int

    @property
    def cells(self) -> int:
        return 1 << len(self.planes)


def index_rebuild(
    vectors: DataFrame, path: str, dimensions: int, per_cell: int = VECTORS_PER_CELL
) -> VectorIndex:
    """Write the whole collection anew, partitioned by cell, and read it back.

    A cell is the pattern of sides a vector is on of random hyperplanes, as
    many as the collection needs; near vectors share most sides. Cells need no
    training and no shuffle to compute. A crowded cell is split over files. The
    planes are written last, beside the cells: a search reads them from there, so
    it can't ask by others than the index was built with.
    """
    spark = vectors.sparkSession
    clean = vectors.select("vector_id", "vector").where(F.col("vector").isNotNull())
    planes = hyperplanes(dimensions, bits_for(clean.count(), per_cell))
    kind = clean.schema["vector"].dataType.simpleString()
    cells = clean.mapInArrow(_cell_numbers(planes), f"vector_id bigint, vector {kind}, cell int")
    balanced(cells, "cell").write.mode("error").partitionBy("cell").parquet(f"{path}/{_CELLS}")
    made = [(bit, plane.tolist(), per_cell) for bit, plane in enumerate(planes)]
    listed = spark.createDataFrame(made, "bit int, plane array<double>, per_cell int").coalesce(1)
    listed.write.mode("error").parquet(f"{path}/{_PLANES}")
    return open_index(spark, path)


def index_add(index_path: str, vectors: DataFrame) -> None:
    """Append vectors to the cells of an index, by its own planes."""
    planes = open_index(vectors.sparkSession, index_path).planes
    clean = vectors.select("vector_id", "vector").where(F.col("vector").isNotNull())
    kind = clean.schema["vector"].dataType.simpleString()
    cells = clean.mapInArrow(_cell_numbers(planes), f"vector_id bigint, vector {kind}, cell int")
    balanced(cells, "cell").write.mode("append").partitionBy("cell").parquet(f"{index_path}/{_CELLS}")


def open_index(spark: SparkSession, path: str) -> VectorIndex:
    listed = spark.read.parquet(f"{path}/{_PLANES}").orderBy("bit").collect()  # one row for each bit
    rows = spark.read.schema(f"vector_id bigint, vector {_kind(spark, path)}, cell int").parquet(f"{path}/{_CELLS}")
    return VectorIndex(rows, np.array([r.plane for r in listed]), listed[0].per_cell)


def _kind(spark: SparkSession, path: str) -> str:
    return spark.read.parquet(f"{path}/{_CELLS}").schema["vector"].dataType.simpleString()


def _probed(planes: np.ndarray, probes: int):
    """Each question once for each of its likeliest cells, in batches of bounded length."""

    def piece(batch: pa.RecordBatch, rows: list[np.ndarray], cells: list[np.ndarray]) -> pa.RecordBatch:
        asked = batch.take(pa.array(np.concatenate(rows)))
        return pa.RecordBatch.from_arrays(
            [*asked.columns, pa.array(np.concatenate(cells).astype("int32"))],
            names=["query_id", "vector", "cell"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            margins = _unit(_matrix(pa.Table.from_batches([batch]))) @ planes.T
            rows, cells, held = [], [], 0
            for at, own in enumerate(margins):
                # What it costs to be in a cell, for all cells: bit by bit they double.
                cost = np.zeros(1)
                for margin in own:
                    crossed = margin * margin
                    cost = np.concatenate([cost + (crossed if margin > 0 else 0.0),
                                           cost + (0.0 if margin > 0 else crossed)])
                nearest = np.argsort(np.round(cost, DISTANCE_DIGITS), kind="stable")[:probes]
                for start in range(0, len(nearest), _ASKED_AT_ONCE):
                    some = nearest[start : start + _ASKED_AT_ONCE]
                    if held + len(some) > _ASKED_AT_ONCE:
                        yield piece(batch, rows, cells)
                        rows, cells, held = [], [], 0
                    rows.append(np.full(len(some), at))
                    cells.append(some)
                    held += len(some)
            yield piece(batch, rows, cells)

    return run


def knn_approx(
    index: VectorIndex, questions: DataFrame, k: int = TOP_K, probes: int | str | None = None
) -> DataFrame:
    """Like ``knn_cosine``, asking only the ``probes`` likeliest cells per question,
    by default as many as the number of cells asks for, and all of them for ``"all"``.

    The cell is a partition column and the join's key, so cells nobody asks are
    not opened. Cells are taken in order of how little a question would have to
    move to be in them; as many probes as there are cells give the exact answer.
    """
    bits, dimensions = index.planes.shape
    if probes is None:
        probes = probes_for(bits, dimensions, index.per_cell, k)
    elif probes == "all":
        probes = index.cells
    asked = questions.select("query_id", "vector").where(F.col("vector").isNotNull())
    kind = asked.schema["vector"].dataType.simpleString()
    spread = asked.mapInArrow(_probed(index.planes, probes), f"query_id bigint, vector {kind}, cell int")
    return _search(index.rows, spread, k)


def retrieve_chunks(neighbours: DataFrame, chunks: DataFrame, chunk_id: str = "vector_id") -> DataFrame:
    """Each neighbour with its chunk's columns: text, source, title, url, date.

    The search is run once: its few rows are written to the shared folder, counted
    there, and travel to the chunks as long as they are few.
    """
    spark, path = neighbours.sparkSession, shared_dir(neighbours.sparkSession, "neighbours")
    neighbours.withColumnRenamed("vector_id", chunk_id).write.parquet(path)
    found = spark.read.parquet(path)
    if found.count() <= _BROADCAST_ROWS:
        found = F.broadcast(found)
    return chunks.join(found, chunk_id)


def recall(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """Which share of the exact neighbours the approximate search found."""
    hit = approximate.select("query_id", "vector_id", F.lit(True).alias("hit"))
    found, total = F.count("hit"), F.count("*")
    return exact.join(hit, ["query_id", "vector_id"], "left").agg(
        total.alias("neighbours"),
        found.alias("found"),
        (found.cast("double") / F.nullif(total, F.lit(0))).alias("recall"),
    )
