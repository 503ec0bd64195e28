"""Byte-level BPE encoding and decoding as a tree reduction.

A text is cut in halves until a piece is short, pieces are encoded, and
neighbours are joined. Joining encodes a window around the seam again. The window
ends where a blank follows a character that is no blank. No match of the pattern
that splits texts can hold such a pair, and what a match looks at beyond its end
is at most the character after it, so a split lies there in the whole text, in
each piece, and in the window: tokens outside can't change. A window that finds
no such place is doubled, up to the whole piece. Decoding joins the bytes of
halves the same way.

Defined cases: null and empty texts have no ids; texts of any length are encoded
whole; repeated rows are encoded each; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession

from strandline.llm.common import arrow, as_bytes, documents, prepare, slices

RANKS = "byte_bpe_multi_50k.tiktoken"
PIECE_CHARS = 2_048
WINDOW_CHARS = 64
_SPLIT = re.compile(r"(?<=\S)[ \t\n\r]")


class Codec:
    """The ranks of one vocabulary, and the tree over them."""

    def __init__(self, path: str, pattern: str, piece: int = PIECE_CHARS, window: int = WINDOW_CHARS):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.short = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.lengths = np.zeros(max(self.tokens) + 1, np.int64)
        self.lengths[list(self.tokens)] = [len(t) for t in self.tokens.values()]
        self.piece, self.window = max(1, piece), max(1, window)

    def _leaf(self, text: str) -> np.ndarray:
        return np.array(self.short.encode_ordinary(text), np.uint32)

    def encode(self, text: str) -> np.ndarray:
        if len(text) <= self.piece:
            return self._leaf(text)
        middle = len(text) // 2
        left, right = text[:middle], text[middle:]
        return self.join(left, self.encode(left), right, self.encode(right))

    def join(self, left: str, left_ids: np.ndarray, right: str, right_ids: np.ndarray) -> np.ndarray:
        """The ids of ``left + right`` from the ids of both."""
        if not left or not right:
            return right_ids if not left else left_ids
        start, end = self._last_split(left), self._first_split(right)
        keep = len(left_ids) - self._covering(left_ids[::-1], left[start:])
        skip = self._covering(right_ids, right[:end])
        return np.concatenate(
            [left_ids[:keep], self._leaf(left[start:] + right[:end]), right_ids[skip:]]
        )

    def _last_split(self, text: str) -> int:
        reach = self.window
        while True:
            start = max(0, len(text) - reach)
            found = [m.start() for m in _SPLIT.finditer(text, start)]
            if found or not start:
                return found[-1] if found else 0
            reach *= 2

    def _first_split(self, text: str) -> int:
        reach = self.window
        while True:
            found = _SPLIT.search(text, 0, reach)
            if found or reach >= len(text):
                return found.start() if found else len(text)
            reach *= 2

    def _covering(self, ids: np.ndarray, text: str) -> int:
        """How many of the first ids make up exactly ``text``."""
        size = len(text.encode())
        upto = np.cumsum(self.lengths[ids[:size]])
        count = int(np.searchsorted(upto, size))
        if not size:
            return 0
        if count >= len(upto) or upto[count] != size:
            raise AssertionError("a token crosses a place where the pattern splits")
        return count + 1

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) <= self.piece:
            return b"".join(map(self.tokens.__getitem__, ids.tolist()))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


@lru_cache(2)
def codec(path: str, pattern: str) -> Codec:
    """One for each worker."""
    return Codec(path, pattern)


def encoded(
    docs: DataFrame,
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """doc_id, ids (array) and decoded (binary) of every text."""
    path = path or public_tokenizers.path(RANKS)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64())), ("decoded", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in slices(batches):
            ids = [own.encode(x.decode()) for x in as_bytes(batch)]
            rows = {
                "doc_id": batch.column("doc_id"),
                "ids": [x.astype(np.int64) for x in ids],
                "decoded": [own.decode(x) for x in ids],
            }
            yield arrow(rows, schema)

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id long, ids array<long>, decoded binary")


def digests(
    docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN
) -> DataFrame:
    """What ``encoded`` gives, as counts and hashes made where the ids are."""
    path = path or public_tokenizers.path(RANKS)
    out = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in slices(batches):
            counts, ids_hex, text_hex = [], [], []
            for text in as_bytes(batch):
                ids = own.encode(text.decode())
                counts.append(len(ids))
                ids_hex.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                text_hex.append(hashlib.sha256(own.decode(ids)).hexdigest())
            rows = {
                "doc_id": batch.column("doc_id"),
                "n_tokens": counts,
                "ids_sha256": ids_hex,
                "decoded_sha256": text_hex,
            }
            yield arrow(rows, schema)

    return docs.select("doc_id", "text").mapInArrow(digest, out)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir))


def stage(spark: SparkSession, docs: DataFrame) -> DataFrame:
    prepare(spark)
    return digests(docs)
