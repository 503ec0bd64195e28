"""What the operators share that read a sorted partition once, keeping some of its rows.

Rows are dealt out by a group (a key and a slice of it) and sorted within it; a task then
reads its rows as a stream of Arrow batches and keeps only what later rows may still ask
for. Output leaves in batches, so neither a group nor its result is ever held as a whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame

# Rows that leave a task at once, and kept rows that may be closed before they are let go.
OUT_ROWS = 20_000
_SLACK_ROWS = 100_000


class Kept:
    """Rows of earlier batches, by number, until they are let go."""

    def __init__(self, kind: pa.DataType):
        self.kind, self.chunks, self.size = kind, [], 0

    def add(self, column: pa.Array) -> int:
        """Keep a column's rows; the number of the first."""
        self.chunks.append(column)
        self.size += len(column)
        return self.size - len(column)

    def take(self, numbers: Sequence[int | None]) -> pa.Array:
        wanted = pa.array(numbers, pa.int64())
        if not self.size:
            return pa.nulls(len(numbers), self.kind)
        return pa.chunked_array(self.chunks, self.kind).take(wanted).combine_chunks()

    @property
    def crowded(self) -> bool:
        return self.size >= _SLACK_ROWS

    def shrink(self, needed: Iterable[int]) -> dict[int, int] | None:
        """Let go of all rows but ``needed``, if they are the fewer; old to new numbers."""
        needed = sorted(needed)
        if not self.crowded or self.size < 2 * len(needed):
            return None
        self.chunks = [_plain(self.take(needed), self.kind)]
        self.size = len(needed)
        return {old: new for new, old in enumerate(needed)}


def _plain(column: pa.Array | pa.ChunkedArray, kind: pa.DataType) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        return pa.concat_arrays(column.chunks) if column.num_chunks else pa.nulls(0, kind)
    return column


def batch_of(columns: dict[str, pa.Array | pa.ChunkedArray]) -> pa.RecordBatch:
    arrays = [_plain(c, c.type) for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def swept(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], run, schema: str) -> DataFrame:
    """``run`` over the partitions of ``df``, whose groups are whole and in order."""
    dealt = df.repartition(*group).sortWithinPartitions(*group, *order)
    return dealt.mapInArrow(run, schema)


def groups_of(batch: pa.RecordBatch, columns: Sequence[str]) -> Iterator[tuple]:
    """The group of each row, as a tuple."""
    return zip(*[batch.column(c).to_pylist() for c in columns], strict=True)
