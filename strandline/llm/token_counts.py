"""Token counts of whole texts, without the tokens.

Texts are split at blanks, which the tokenizer drops: no token, normalisation or
special string reaches over one. What lies between is encoded once for each task
and batch however often it occurs, in batches of equal bytes, and only lengths
are kept; a text's count is the sum of its parts'.

Defined cases: null and empty texts have 0 bytes and 0 tokens; a text without a
blank is one part, encoded whole; an empty table gives an empty result.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from strandline.llm.common import arrow, as_bytes, documents, slices

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
#: Bytes of parts that go to the tokenizer in one call, and parts remembered by a worker.
CALL_BYTES, REMEMBERED = 1 << 18, 400_000


@lru_cache(2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


def by_bytes(parts: Iterable[bytes], limit: int = CALL_BYTES) -> Iterator[list[bytes]]:
    """The parts in lists of about ``limit`` bytes; a longer part is alone."""
    held, size = [], 0
    for part in parts:
        if held and size + len(part) > limit:
            yield held
            held, size = [], 0
        held.append(part)
        size += len(part)
    if held:
        yield held


class Counter:
    """Lengths of parts, remembered."""

    def __init__(self, path: str):
        self.path, self.known = path, {}

    def counts(self, texts: list[bytes]) -> list[int]:
        split = [text.split() for text in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = set().union(*split).difference(self.known)
        for parts in by_bytes(sorted(new)):
            found = tokenizer(self.path).encode_batch_fast(
                [p.decode() for p in parts], add_special_tokens=False
            )
            self.known.update(zip(parts, map(len, found), strict=True))
        return [sum(map(self.known.__getitem__, parts)) for parts in split]


@lru_cache(2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit."""
    path = path or public_tokenizers.path(VOCABULARY)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in slices(batches):
            texts = as_bytes(batch)
            found = own.counts(texts)
            rows = {
                "doc_id": batch.column("doc_id"),
                "n_bytes": [len(t) for t in texts],
                "n_tokens": found,
                "over_limit": [n > limit for n in found],
            }
            yield arrow(rows, schema)

    return docs.select("doc_id", "text").mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))
