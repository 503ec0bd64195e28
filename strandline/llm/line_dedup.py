"""Line dedup over sharded minimal perfect hashes.

Every line has a key, and long enough keys a 128-bit hash. Documents are dealt
into batches; a batch lists its distinct hashes once, packed by shard, with the
number of its documents that hold the line and the largest id among them. So a
line that a third of all documents share is counted once a batch.

A shard's index is a minimal perfect hash over its distinct hashes: in each level
hashes that fall alone into a place keep it, the rest go on to the next level; the
rank of the place is the slot. Slots lead into three arrays: a 32-bit fingerprint,
the number of documents, the id that keeps the line. Batches probe the arrays with
the hashes they listed and learn which of them are too frequent; the lines
themselves are never shuffled to be joined. With that, a batch cuts its documents.

A line that nearly every batch holds brings an entry a batch to its shard. Beyond
``FEW_BATCHES``, where one such line adds over a megabyte, lists are written down and
measured: a shard whose lists are over a limit is cut into lots of batches, each lot is
merged first, and the merged lots make the index, which each lot probes. Text is shuffled
twice then; below, once, as listing and cutting share a shuffle. Rows equal in id and text would share a batch: beyond a
limit they travel as one row with a count, which is spread again at the end.

Defined cases: null and empty text is one empty line; keys shorter than the limit
are never dropped; each row is a document; a null id is smaller than any, and rows
sharing the largest id all keep the line, equal rows too; a document may lose all its
lines; an empty table gives an empty result; columns beside ``doc_id`` and ``text`` are
neither read nor returned; ``deduplicated`` returns the texts.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import as_bytes, documents, if_small, scratch

MIN_CHARS, MIN_DOCS = 20, 3
#: Text of a batch, and of the documents whose lines one shard indexes on average.
BATCH_TEXT, SHARD_TEXT = 4 << 20, 32 << 20
#: Batches that a task gets on average, and the fewest tasks.
TASK_BATCHES, LEAST_TASKS = 4, 32
#: Lists of a shard that one group reads, and equal rows that go as they are.
LOT_BYTES, EQUAL_ROWS = 64 << 20, 1_024
#: Batches up to which the lists of shards need no measuring.
FEW_BATCHES = 1 << 15
#: Copies of a row that are spread at once.
SPREAD_ROWS = 1 << 16
NO_ID = -(1 << 63)
#: Places in a level for each hash that is left.
SPARE = 1.5

ENTRY = np.dtype([("lo", "<u8"), ("hi", "<u8"), ("docs", "<u8"), ("keep", "<i8")])
HIT = np.dtype([("lo", "<u8"), ("hi", "<u8"), ("keep", "<i8")])


# --- the index --------------------------------------------------------------


def _places(lo: np.ndarray, hi: np.ndarray, level: int, size: int) -> np.ndarray:
    odd = np.uint64((0x9E3779B97F4A7C15 * (2 * level + 1)) & (2**64 - 1))
    mixed = (lo ^ (hi * odd)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0x94D049BB133111EB)
    return ((mixed >> np.uint64(32)) % np.uint64(size)).astype(np.int64)


class LineIndex:
    """Minimal perfect hash of distinct 128-bit hashes, and the arrays behind it."""

    def __init__(self, levels: list[np.ndarray], prints, docs, keep):
        self.levels, self.prints, self.docs, self.keep = levels, prints, docs, keep
        ones = [np.cumsum(np.bitwise_count(bits), dtype=np.int64) for bits in levels]
        firsts = np.cumsum([0, *[int(x[-1]) for x in ones]])
        self.ranks = [
            first + np.r_[0, x[:-1]] for first, x in zip(firsts[:-1], ones, strict=True)
        ]

    @classmethod
    def build(cls, entries: np.ndarray) -> "LineIndex":
        """``entries``: distinct hashes."""
        levels, left = [], np.arange(len(entries))
        while len(left):
            size = max(64, int(SPARE * len(left)))
            at = _places(entries["lo"][left], entries["hi"][left], len(levels), size)
            alone = np.bincount(at, minlength=size)[at] == 1
            bits = np.zeros(-(-size // 64) * 64, np.uint8)
            bits[at[alone]] = 1
            levels.append(np.packbits(bits, bitorder="little").view("<u8"))
            left = left[~alone]
        n = len(entries)
        made = cls(levels, np.zeros(n, "<u4"), np.zeros(n, "<u4"), np.zeros(n, "<i8"))
        slot = made.slots(entries["lo"], entries["hi"])
        made.prints[slot] = entries["hi"] >> np.uint64(32)
        made.docs[slot] = np.minimum(entries["docs"], 2**32 - 1)
        made.keep[slot] = entries["keep"]
        return made

    def slots(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The slot of each hash, -1 where no level has it."""
        slot, left = np.full(len(lo), -1, np.int64), np.arange(len(lo))
        for level, (bits, rank) in enumerate(zip(self.levels, self.ranks, strict=True)):
            size = max(64, int(SPARE * (len(self.prints) - (int(rank[0]) if len(rank) else 0))))
            at = _places(lo[left], hi[left], level, size)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            found = (bits[word] >> bit) & np.uint64(1) == 1
            below = bits[word] & ((np.uint64(1) << bit) - np.uint64(1))
            slot[left[found]] = (rank[word] + np.bitwise_count(below))[found]
            left = left[~found]
        return slot

    def probe(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Slots whose fingerprint agrees, else -1."""
        slot = self.slots(lo, hi)
        known = slot >= 0
        known[known] = self.prints[slot[known]] == hi[known] >> np.uint64(32)
        return np.where(known, slot, -1)

    def pack(self) -> bytes:
        sizes = np.array([len(self.prints), *map(len, self.levels)], "<u8")
        parts = [np.array([len(sizes)], "<u8"), sizes, *self.levels, self.prints, self.docs, self.keep]
        return b"".join(p.tobytes() for p in parts)

    @classmethod
    def unpack(cls, packed: bytes) -> "LineIndex":
        at = 8 + 8 * int(np.frombuffer(packed, "<u8", 1)[0])
        n, *sizes = np.frombuffer(packed, "<u8", (at - 8) // 8, 8).astype(int).tolist()
        levels = []
        for size in sizes:
            levels.append(np.frombuffer(packed, "<u8", size, at))
            at += 8 * size
        prints, docs = np.frombuffer(packed, "<u4", n, at), np.frombuffer(packed, "<u4", n, at + 4 * n)
        return cls(levels, prints, docs, np.frombuffer(packed, "<i8", n, at + 8 * n))


def merged(parts: list[np.ndarray]) -> np.ndarray:
    """Entries with equal hashes made one: documents added up, the largest id kept."""
    every = np.concatenate(parts) if parts else np.zeros(0, ENTRY)
    every = every[np.lexsort((every["hi"], every["lo"]))]
    if not len(every):
        return every
    lo, hi = every["lo"], every["hi"]
    first = np.flatnonzero(np.r_[True, (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])])
    out = every[first]
    out["docs"] = np.add.reduceat(every["docs"], first)
    out["keep"] = np.maximum.reduceat(every["keep"], first)
    return out


# --- documents --------------------------------------------------------------


def key_hash(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The hash of a line's key, None for a key too short to be dropped."""
    key = line.strip().lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def collapsed(docs: DataFrame) -> tuple[DataFrame, int, bool]:
    """doc_id, text and copies, the size of all text, and whether equal rows were made one.

    Only rows of which there are many, or much text, are; others have one copy each.
    """
    own = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("same"))
    length = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    sums = own.groupBy("same").agg(F.count("*").alias("rows"), F.sum(length).alias("bytes"))
    many = (F.col("rows") > EQUAL_ROWS) | ((F.col("rows") > 1) & (F.col("bytes") > BATCH_TEXT))
    size, crowds = sums.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count_if(many)).first()
    if not crowds:
        return docs.select("doc_id", "text", F.lit(1).cast("long").alias("copies")), size, False
    crowded = scratch(docs.sparkSession, sums.where(many).select("same", F.lit(True).alias("many")), "equal-rows")
    marked = own.join(if_small(crowded, crowds, 16), "same", "left")
    one = marked.where("many").groupBy("doc_id", "text").agg(F.count("*").alias("copies"))
    rest = marked.where("many IS NULL").select("doc_id", "text", F.lit(1).cast("long").alias("copies"))
    return rest.unionByName(one), size, True


def spread_again(rows: DataFrame) -> DataFrame:
    """Each row as often as its column ``copies`` says, without that column."""
    columns = [c for c in rows.columns if c != "copies"]
    lots = F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) DIV {SPREAD_ROWS}"))
    by_lot = rows.select(*columns, "copies", F.explode(lots).alias("lot"))
    left = F.least(F.lit(SPREAD_ROWS).cast("long"), F.col("copies") - F.col("lot") * SPREAD_ROWS)
    ones = F.explode(F.sequence(F.lit(1).cast("long"), left)).alias("copy")
    return by_lot.select(*columns, ones).select(*columns)


def dealt(docs: DataFrame, batches: int) -> DataFrame:
    batch = F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches))
    tasks = max(LEAST_TASKS, batches // TASK_BATCHES)
    return docs.select("doc_id", "text", "copies", batch.alias("batch")).repartition(tasks, "batch")


def listed(in_batches: DataFrame, shards: int, min_chars: int) -> DataFrame:
    """(batch, shard, entries): the distinct hashes of each batch, packed by shard."""

    def read(key: tuple, group: pa.Table) -> pa.Table:
        held: dict[bytes, list[int]] = {}
        for part in group.to_batches():
            ids, copies = part.column("doc_id").to_pylist(), part.column("copies").to_pylist()
            for doc_id, text, n in zip(ids, as_bytes(part), copies, strict=True):
                own = NO_ID if doc_id is None else doc_id
                for found in {key_hash(line, min_chars) for line in text.split(b"\n")}:
                    if found is None:
                        continue
                    if (entry := held.get(found)) is None:
                        held[found] = [n, own]
                    else:
                        entry[0] += n
                        entry[1] = max(entry[1], own)
        entries = np.zeros(len(held), ENTRY)
        hashes = np.frombuffer(b"".join(held), "<u8").reshape(-1, 2)
        entries["lo"], entries["hi"] = hashes[:, 0], hashes[:, 1]
        entries["docs"] = [n for n, _ in held.values()]
        entries["keep"] = [k for _, k in held.values()]
        shard = (entries["lo"] >> np.uint64(20)) % np.uint64(shards)
        order = np.argsort(shard, kind="stable")
        entries, shard = entries[order], shard[order]
        cuts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if len(shard) else []
        return pa.table(
            {
                "batch": pa.array([key[0].as_py()] * len(cuts), pa.int64()),
                "shard": pa.array(shard[cuts].astype(np.int64) if len(shard) else [], pa.int64()),
                "entries": pa.array(
                    [p.tobytes() for p in np.split(entries, cuts[1:])] if len(shard) else [], pa.binary()
                ),
            }
        )

    return in_batches.groupBy("batch").applyInArrow(read, "batch long, shard long, entries binary")


def unpacked(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(x, ENTRY) for x in column.to_pylist()]


def in_lots(lists: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Where shards are cut: the lists with a column ``lot``, and (shard, lots) of those shards."""
    sums = lists.groupBy("shard").agg(F.sum(F.octet_length("entries").cast("long")).alias("bytes"))
    lots = sums.select("shard", F.ceil(F.col("bytes") / LOT_BYTES).alias("lots")).where("lots > 1")
    crowds = lots.count()
    if not crowds:
        return lists, None
    lots = if_small(scratch(lists.sparkSession, lots, "line-lots"), crowds, 16)
    lot = F.pmod(F.xxhash64("batch"), F.coalesce("lots", F.lit(1).cast("long")))
    return lists.join(lots, "shard", "left").withColumn("lot", lot), lots


def merge_lot(key: tuple, group: pa.Table) -> pa.Table:
    entries = merged(unpacked(group.column("entries"))).tobytes()
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "entries": pa.array([entries], pa.binary())})


def indexed(lists: DataFrame, lots: DataFrame | None) -> DataFrame:
    """(shard, index): with ``lots`` also (lot), once for each lot of the shard."""

    def build(key: tuple, group: pa.Table) -> pa.Table:
        index = LineIndex.build(merged(unpacked(group.column("entries"))))
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "index": pa.array([index.pack()], pa.binary())})

    schema = "shard long, index binary"
    if lots is None:
        return lists.groupBy("shard").applyInArrow(build, schema)
    whole = lists.where("lots IS NULL").select("shard", "entries")
    first = lists.where("lots IS NOT NULL").select("shard", "lot", "entries").groupBy("shard", "lot")
    parts = whole.unionByName(first.applyInArrow(merge_lot, "shard long, entries binary"))
    each = F.sequence(F.lit(0).cast("long"), F.coalesce("lots", F.lit(1).cast("long")) - 1)
    built = scratch(lists.sparkSession, parts.groupBy("shard").applyInArrow(build, schema), "line-index")
    return built.join(lots, "shard", "left").select("shard", "index", F.explode(each).alias("lot"))


def probed(lists: DataFrame, index: DataFrame, min_docs: int) -> DataFrame:
    """(batch, hits): of each batch's hashes those in ``min_docs`` documents or more."""

    def probe(lists: pa.Table, index: pa.Table) -> pa.Table:
        batches, hits = [], []
        shard = LineIndex.unpack(index.column("index")[0].as_py()) if index.num_rows else None
        for batch, own in zip(
            lists.column("batch").to_pylist(), unpacked(lists.column("entries")), strict=True
        ):
            slot = shard.probe(own["lo"], own["hi"])
            often = slot >= 0
            often[often] = shard.docs[slot[often]] >= min_docs
            if often.any():
                found = np.zeros(int(often.sum()), HIT)
                found["lo"], found["hi"] = own["lo"][often], own["hi"][often]
                found["keep"] = shard.keep[slot[often]]
                batches.append(batch)
                hits.append(found.tobytes())
        return pa.table({"batch": pa.array(batches, pa.int64()), "hits": pa.array(hits, pa.binary())})

    # Without lots the lists are grouped just as for the index, so that they are shuffled once.
    group = ["shard"]
    if "lot" in lists.columns:
        lists, group = lists.select("batch", "entries", "shard", "lot"), ["shard", "lot"]
    own, shards = lists.groupBy(*group), index.select("index", *group).groupBy(*group)
    return own.cogroup(shards).applyInArrow(probe, "batch long, hits binary")


def cut(in_batches: DataFrame, hits: DataFrame, min_chars: int, with_text: bool) -> DataFrame:
    """doc_id, copies, n_lines, n_dropped and the rest of each text, or its hash."""
    last, kind = ("text", pa.string()) if with_text else ("kept_sha256", pa.string())

    def lines_of(docs: pa.Table, hits: pa.Table) -> pa.Table:
        keep: dict[bytes, int] = {}
        for part in hits.column("hits").to_pylist():
            for hit in np.frombuffer(part, HIT):
                keep[hit.tobytes()[:16]] = int(hit["keep"])
        ids, n_lines, n_dropped, rest = [], [], [], []
        copies = docs.column("copies").to_pylist()
        for part in docs.to_batches():
            for doc_id, text in zip(part.column("doc_id").to_pylist(), as_bytes(part), strict=True):
                own = NO_ID if doc_id is None else doc_id
                lines = text.split(b"\n")
                kept = [x for x in lines if keep.get(key_hash(x, min_chars), own) == own] if keep else lines
                left = b"\n".join(kept)
                ids.append(doc_id)
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
                rest.append(left.decode() if with_text else hashlib.sha256(left).hexdigest())
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "copies": pa.array(copies, pa.int64()),
                "n_lines": pa.array(n_lines, pa.int64()),
                "n_dropped": pa.array(n_dropped, pa.int64()),
                last: pa.array(rest, kind),
            }
        )

    return (
        in_batches.groupBy("batch")
        .cogroup(hits.groupBy("batch"))
        .applyInArrow(lines_of, f"doc_id long, copies long, n_lines long, n_dropped long, {last} string")
    )


def deduplicated(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, with_text: bool = True
) -> DataFrame:
    """doc_id, n_lines, n_dropped and text without the lines that others keep."""
    rows, size, crowded = collapsed(docs)
    batches = max(LEAST_TASKS, size // BATCH_TEXT + 1)
    in_batches = dealt(rows, batches)
    lists = listed(in_batches, max(LEAST_TASKS, size // SHARD_TEXT + 1), min_chars)
    lots = None
    if batches > FEW_BATCHES:
        lists, lots = in_lots(scratch(docs.sparkSession, lists, "line-lists"))
    hits = probed(lists, indexed(lists, lots), min_docs)
    left = cut(in_batches, hits, min_chars, with_text)
    return spread_again(left) if crowded else left.drop("copies")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(documents(spark, sf_dir), with_text=False)


OP4_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines
    FROM documents
), lines AS (
    SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM docs
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM lines
), often AS (
    SELECT k, max(doc_id) AS keep FROM keyed WHERE length(k) >= 20
    GROUP BY k HAVING count(DISTINCT r) >= 3
), marked AS (
    SELECT r, keyed.doc_id, i, line, often.k IS NOT NULL AND keyed.doc_id IS DISTINCT FROM keep AS gone
    FROM keyed LEFT JOIN often ON keyed.k = often.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""
