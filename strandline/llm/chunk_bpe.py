"""Byte-level BPE by content-defined chunks that documents share.

A rolling hash over the last 32 bytes cuts each text where its upper bits are zero, so
equal passages are cut alike wherever they stand. Chunks that occur once in all documents
are encoded where they are. Chunks that occur again are encoded once, in a table of their
own, and the ids are brought to the documents that hold them; texts only move if they hold
such a chunk and the list of them is too long to be sent.

A document's ids are those of its chunks, joined in pairs up a tree. A join encodes a
window around the seam again. The window ends where a blank follows a character that is
no blank, a place where the pattern always splits, one word further out than the seam
needs: that word's ids must agree with the ones there before. If they don't, or there is
no such place, the window is doubled, up to both sides as a whole. Ids are decoded at the
end; were a chunk's 128-bit hash another chunk's, the bytes would differ and the text is
encoded again as a whole.

Ids come from the ranks in the vocabulary's own file; its special strings are single
ids also inside texts, as the file's library has it.

Defined cases: null and empty texts have no ids; texts of any length are encoded whole;
repeated rows give a row each; an empty table gives an empty result; columns other than
doc_id and text are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import arrow, as_bytes, documents, if_small, prepare, scratch, slices

VOCABULARY = "byte_bpe_50k.json"
#: Bytes the rolling hash sees; a place in 2^CUT_BITS is cut; the least bytes of a chunk.
SEEN, CUT_BITS, LEAST = 32, 10, 128
#: Characters on either side of a seam that are encoded again at first.
WINDOW_CHARS = 48
_SPLIT = re.compile(r"(?<=\S)[ \t\n\r]")
_GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), 7) for b in range(256)], np.uint32)


# --- chunks -----------------------------------------------------------------


def rolling(data: np.ndarray) -> np.ndarray:
    """At each byte the hash of it and the 31 before it, by sums over doubled spans."""
    total, span = _GEAR[data], 1
    while span < SEEN:
        total[span:] += total[:-span] << np.uint32(span)
        span *= 2
    return total


def chunk_ends(texts: list[bytes], bits: int = CUT_BITS, least: int = LEAST) -> list[list[int]]:
    """Where the chunks of each text end, always between characters; none for an empty text."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.cumsum([0, *map(len, texts)])
    places = np.flatnonzero(rolling(data)[:-1] < np.uint32(1 << (32 - bits))) + 1 if len(data) else data
    places = places[(data[places] & 0xC0) != 0x80]
    ends = []
    for start, stop in zip(starts[:-1].tolist(), starts[1:].tolist()):
        own, last = [], start
        first, after = np.searchsorted(places, (start + max(least, SEEN), stop))
        for place in places[first:after].tolist():
            if place - last >= least:
                own.append(place - start)
                last = place
        if stop > start:
            own.append(stop - start)
        ends.append(own)
    return ends


def chunks(texts: list[bytes]) -> list[list[bytes]]:
    return [[t[a:b] for a, b in zip([0, *own], own)] for t, own in zip(texts, chunk_ends(texts))]


def name(chunk: bytes) -> bytes:
    return xxhash.xxh3_128_digest(chunk)


# --- ids --------------------------------------------------------------------


def byte_of() -> dict[str, int]:
    """The character that stands for each byte in such files: itself if printable, else from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Ranks and special strings of a file, and joins of what they encode."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN, window: int = WINDOW_CHARS):
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        to_byte, vocab = byte_of(), made["model"]["vocab"]
        special = {t["content"]: t["id"] for t in made["added_tokens"]}
        if any(re.search(r"\s", s) for s in special):
            raise ValueError("special strings with blanks are not supported")
        ranks = {bytes(map(to_byte.__getitem__, t)): i for t, i in vocab.items() if t not in special}
        merged = [m.split(" ") if isinstance(m, str) else m for m in made["model"]["merges"]]
        order = [vocab["".join(m)] for m in merged]
        if order != sorted(order):
            raise ValueError("ids must follow the order of merges")
        self.library = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self.special = set(special)
        tokens = {i: t for t, i in ranks.items()} | {i: s.encode() for s, i in special.items()}
        self.tokens = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.digits = list(map(str, range(len(self.tokens))))
        self.packed = "<u2" if len(self.tokens) <= 1 << 16 else "<u4"
        self.window = max(1, window)

    def leaf(self, text: str) -> list[int]:
        return self.library.encode(text, allowed_special=self.special, disallowed_special=())

    def pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.packed).tobytes()

    def unpack(self, ids: bytes) -> list[int]:
        return np.frombuffer(ids, self.packed).tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def encode(self, parts: list[bytes], known: dict[bytes, bytes]) -> list[int]:
        """The ids of the joined parts; ``known`` has the packed ids of some by name."""
        if not parts:
            return []
        nodes = []
        for part in parts:
            text, own = part.decode(), known.get(name(part)) if known else None
            nodes.append((text, self.leaf(text) if own is None else self.unpack(own)))
        while len(nodes) > 1:
            pairs = [self.join(*nodes[i], *nodes[i + 1]) for i in range(0, len(nodes) - 1, 2)]
            nodes = pairs + nodes[len(pairs) * 2 :]
        text, ids = nodes[0]
        return ids if self.decode(ids) == b"".join(parts) else self.leaf(text)

    def join(self, left: str, left_ids: list[int], right: str, right_ids: list[int]) -> tuple[str, list[int]]:
        """Both texts as one, with its ids."""
        text, at = left + right, len(left)
        reach = self.window
        while True:
            start, inner = self._outer(text, at, reach)
            end, last = self._beyond(text, at, reach)
            kept = self._covering(left_ids, text[start:at], start == 0, backward=True)
            skipped = self._covering(right_ids, text[at:end], end == len(text))
            if kept is not None and skipped is not None:
                again = self.leaf(text[start:end])
                before, after = left_ids[len(left_ids) - kept :], right_ids[:skipped]
                if self._agree(again, before, text[start:inner]) and self._agree(
                    again[::-1], after[::-1], text[last:end], backward=True
                ):
                    return text, left_ids[: len(left_ids) - kept] + again + right_ids[skipped:]
            reach *= 2

    def _outer(self, text: str, at: int, reach: int) -> tuple[int, int]:
        """A split left of ``at`` and the next one, or the text's start twice."""
        low = max(0, at - reach)
        found = [m.start() for m in _SPLIT.finditer(text, low, at)]
        return (found[-2], found[-1]) if len(found) > 1 else self._edge(low, 0, at)

    def _beyond(self, text: str, at: int, reach: int) -> tuple[int, int]:
        """A split right of ``at`` and the one before it, or the text's end twice."""
        high = min(len(text), at + reach)
        found = [m.start() for m in _SPLIT.finditer(text, at + 1, high)]
        return (found[1], found[0]) if len(found) > 1 else self._edge(high, len(text), at)

    @staticmethod
    def _edge(reached: int, edge: int, at: int) -> tuple[int, int]:
        """The edge once the window has reached it; else a place that no ids agree with."""
        return (edge, edge) if reached == edge else (at, -1)

    def _covering(self, ids: list[int], text: str, whole: bool, backward: bool = False) -> int | None:
        """How many ids at the side of the seam make up exactly ``text``; None if none do."""
        if whole:
            return len(ids)
        left, count = len(text.encode()), 0
        if not left:
            return None
        for i in reversed(ids) if backward else ids:
            left -= len(self.tokens[i])
            count += 1
            if left <= 0:
                break
        return count if left == 0 else None

    def _agree(self, again: list[int], before: list[int], margin: str, backward: bool = False) -> bool:
        """Whether both begin with the same ids for ``margin``; an edge has none to compare."""
        size = len(margin.encode())
        taken = 0
        while size > 0:
            if taken >= min(len(again), len(before)) or again[taken] != before[taken]:
                return False
            size -= len(self.tokens[again[taken]])
            taken += 1
        return size == 0


@lru_cache(2)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    """One for each worker."""
    return Vocabulary(path, pattern)


# --- documents --------------------------------------------------------------


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each chunk occurs in a batch."""
    schema = pa.schema([("chunk", pa.binary()), ("n", pa.int64())])
    for batch in slices(batches):
        found = Counter(name(c) for own in chunks(as_bytes(batch)) for c in own)
        yield arrow({"chunk": list(found), "n": list(found.values())}, schema)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chunks of a batch, each once."""
    schema = pa.schema([("chunk", pa.binary()), ("part", pa.binary())])
    for batch in slices(batches):
        found = {name(c): c for own in chunks(as_bytes(batch)) for c in own}
        yield arrow({"chunk": list(found), "part": list(found.values())}, schema)


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which chunks each text of a batch holds."""
    schema = pa.schema([("print", pa.binary()), ("chunk", pa.binary())])
    for batch in slices(batches):
        prints = batch.column("print").to_pylist()
        held = {(p, name(c)) for p, own in zip(prints, chunks(as_bytes(batch))) for c in own}
        yield arrow({"print": [p for p, _ in held], "chunk": [c for _, c in held]}, schema)


def with_known_ids(spark: SparkSession, docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, text, and the ids of those of its chunks that occur more than once."""
    prepare(spark)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("print", F.unhex(F.md5("text")))
    again = (
        docs.select("text").mapInArrow(_names, "chunk binary, n long")
        .groupBy("chunk").agg(F.sum("n").alias("n")).filter("n > 1").select("chunk")
    )
    again = scratch(spark, again, "chunks-again")
    n_again = again.count()
    sent = if_small(again, n_again, 32)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("chunk", pa.binary()), ("ids", pa.binary())])
        own = vocabulary(path, pattern)
        for batch in slices(batches, "part"):
            ids = [own.pack(own.leaf(c.decode())) for c in as_bytes(batch, "part")]
            yield arrow({"chunk": batch.column("chunk"), "ids": ids}, schema)

    coded = (
        docs.select("text").mapInArrow(_texts, "chunk binary, part binary")
        .join(sent, "chunk", "left_semi").dropDuplicates(["chunk"])
        .mapInArrow(encode, "chunk binary, ids binary")
    )
    coded = scratch(spark, coded, "chunk-ids")
    places = docs.select("print", "text").mapInArrow(_places, "print binary, chunk binary")
    places = places.join(sent, "chunk", "left_semi").dropDuplicates(["print", "chunk"])
    places = scratch(spark, places, "chunk-places")
    lists = (
        places.join(coded, "chunk").groupBy("print")
        .agg(F.collect_list(F.struct("chunk", "ids")).alias("known"))
    )
    prints = places.select("print").distinct()
    holders = if_small(prints, prints.count(), 32)
    some = docs.join(holders, "print", "left_semi").join(lists, "print", "left")
    none = docs.join(holders, "print", "left_anti")
    return some.select("doc_id", "text", "known").unionByName(
        none.select("doc_id", "text", F.lit(None).cast(some.schema["known"].dataType).alias("known"))
    )


def _encoded(own: Vocabulary, batch: pa.RecordBatch) -> Iterator[tuple[list[int], bytes]]:
    texts, known = as_bytes(batch), batch.column("known").to_pylist()
    for parts, held in zip(chunks(texts), known, strict=True):
        ids = own.encode(parts, {x["chunk"]: x["ids"] for x in held or ()})
        yield ids, own.decode(ids)


def encoded(
    spark: SparkSession, docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN
) -> DataFrame:
    """doc_id, ids (array) and decoded (binary) of every text."""
    path = path or public_tokenizers.path(VOCABULARY)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64())), ("decoded", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(path, pattern)
        for batch in slices(batches):
            ids, decoded = zip(*_encoded(own, batch), strict=True)
            yield arrow({"doc_id": batch.column("doc_id"), "ids": ids, "decoded": decoded}, schema)

    found = with_known_ids(spark, docs, path, pattern)
    return found.mapInArrow(encode, "doc_id long, ids array<long>, decoded binary")


def digests(
    spark: SparkSession, docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN
) -> DataFrame:
    """What ``encoded`` gives, as counts and hashes made where the ids are."""
    path = path or public_tokenizers.path(VOCABULARY)
    names = ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())
    schema = pa.schema([("doc_id", pa.int64()), *names])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(path, pattern)
        for batch in slices(batches):
            rows = {"doc_id": batch.column("doc_id"), "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for ids, decoded in _encoded(own, batch):
                listed = ",".join(map(own.digits.__getitem__, ids))
                rows["n_tokens"].append(len(ids))
                rows["ids_sha256"].append(hashlib.sha256(listed.encode()).hexdigest())
                rows["decoded_sha256"].append(hashlib.sha256(decoded).hexdigest())
            yield arrow(rows, schema)

    found = with_known_ids(spark, docs, path, pattern)
    return found.mapInArrow(digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(spark, documents(spark, sf_dir))
