"""What the operators of this package share: words, scratch tables, bounded batches.

Words are runs of anything but the six ASCII blanks; lower-casing touches A-Z
only. Over UTF-8 bytes both are what ``bytes.split()`` and ``bytes.lower()`` do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.session import configure, shared_dir

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = b" \t\n\x0b\x0c\r"

#: Text that a task hands to Python at once. A longer text is a batch of its own.
BATCH_BYTES = 8 << 20
#: Text whose words a task holds as Python objects at once.
SLICE_BYTES = 2 << 20
#: What may be sent to every executor. Beyond it the same join shuffles instead.
BROADCAST_BYTES = 32 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """The library's settings, and Arrow batches limited by bytes as well as rows."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")


def scratch(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Later steps read what was written, so a lost executor never makes an
    earlier step run again, and row numbers given before stay as they are.
    """
    path = shared_dir(spark, f"llm-{purpose}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(spark: SparkSession, docs: DataFrame, name: str) -> DataFrame:
    """The rows with a number each in column ``name``, written down so that it stays."""
    return scratch(spark, docs.withColumn(name, F.monotonically_increasing_id()), "rows")


def fresh_name(df: DataFrame, wish: str) -> str:
    """``wish``, or a longer name, that no column of ``df`` has in any case."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def if_small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df`` with a broadcast hint when ``rows`` rows are known to fit, else as it is."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def remainder(doc_id: str, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % by


def slices(
    batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each part has at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        sizes = [len(x) if x else 0 for x in as_bytes(batch, text)]
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def as_bytes(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts as UTF-8; null is empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def words(texts: list[bytes] | pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The text and the number of each word in order, and the distinct words by number.

    An Arrow column of texts is read as it is; a null in it is empty.
    """
    if isinstance(texts, pa.Array):
        column = texts.cast(pa.string()).fill_null("")
    else:
        column = pa.array(texts, pa.binary()).cast(pa.string())
    split = pc.ascii_split_whitespace(pc.ascii_lower(column) if lower else column)
    flat = split.flatten()
    sizes = np.diff(split.offsets.to_numpy())
    some = pc.greater(pc.binary_length(flat), 0)
    doc = np.repeat(np.arange(len(texts)), sizes)[some.to_numpy(zero_copy_only=False)]
    coded = flat.filter(some).cast(pa.binary()).dictionary_encode()
    return doc, coded.indices.to_numpy().astype(np.int64), coded.dictionary


def arrow(rows: dict[str, Iterable], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(rows[f.name], f.type) for f in schema], schema=schema
    )


Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
