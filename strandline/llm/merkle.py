"""A Merkle manifest of a table: a tree of hashes for each group, and one over the groups.

Where a row stands in its group comes from bitmaps, not from sorting rows. Ids are cut
into an upper part, which names a container, and the low 12 bits. Tasks make a bitmap (or,
for few ids, a short array) of the low parts of each container they meet, and those of
one container are merged. Containers are put in order and their counts summed up; with
these sums, and a directory of bit counts inside the container, the rank of an id is
its coordinate. Ids are counted before that, so that a container's bitmaps are few however
often an id occurs. Rows that share an id, and only those, are told apart by a sort.

Levels are then reduced by keyed slots: the key is the group and the coordinate divided by
4096, the slot the remainder. A task fills 4096 slots and makes three levels of runs of 16
from them; what is left is a table of a 4096th of the rows. Proofs go down the same way:
a block's row holds the siblings from there up to the root, and each row of the block
adds its own three levels. No task holds more than a block.

Defined cases: null ids come first in their group, rows of one id in the order of their
leaves; equal rows have a leaf each, side by side; a null group is a group, before all
others; null and empty values differ ('-' and '0:'); an empty table has no rows and no
root; columns that the leaves don't name are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm.common import arrow, documents, if_small, prepare, scratch

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Children of a node; levels that a task makes at once; slots of such a block.
FAN, STEP = 16, 3
BLOCK = FAN**STEP
#: Low bits of an id within a container; fewer ids than this are kept as an array.
LOW_BITS, FEW = 12, 256
#: The container of null ids, before that of any id.
NO_ID = -(1 << 62)
_ROW_BITS = 33  # monotonically_increasing_id: the partition stands above these bits


# --- leaves -----------------------------------------------------------------


def counted(value: Column) -> Column:
    """'-' for null, else the bytes of the value as text, a colon, and the text."""
    text = value.cast("string")
    size = F.octet_length(text).cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(size, F.lit(":"), text))


def leaf(values: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(counted, values)), 256))


def run_hash(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def levels_of(nodes: list[str], total: int) -> list[list[str]]:
    """The nodes of a block and of up to three levels above, as long as the group has several."""
    levels = [nodes]
    while total > 1 and len(levels) <= STEP:
        below = levels[-1]
        levels.append([run_hash(below[i : i + FAN]) for i in range(0, len(below), FAN)])
        total = -(-total // FAN)
    return levels


def siblings(levels: list[list[str]], slot: int) -> list[tuple[str, str]]:
    """What stands left and right of the slot's node in its run, level by level."""
    found = []
    for below in levels[:-1]:
        first, place = slot - slot % FAN, slot % FAN
        run = below[first : first + FAN]
        found.append(("".join(run[:place]), "".join(run[place + 1 :])))
        slot //= FAN
    return found


def folded(node: str, path: list[tuple[str, str]]) -> str:
    for left, right in path:
        node = hashlib.sha256(f"{left}{node}{right}".encode()).hexdigest()
    return node


# --- order over tables of any length ------------------------------------------


def in_order(spark: SparkSession, df: DataFrame, keys: list[Column], weights: dict[str, Column]) -> DataFrame:
    """``df`` with, for each weight, the sum of it over all rows before, in the order of the keys.

    Rows are dealt out by ranges of the keys and summed within a range; only the
    ranges' own sums are put in a row. Equal rows may fall into several ranges.
    """
    tie = F.col("_tie")
    dealt = df.withColumn("_tie", F.monotonically_increasing_id()).withColumns(weights)
    dealt = dealt.repartitionByRange(*keys, tie).sortWithinPartitions(*keys, tie)
    dealt = scratch(spark, dealt.withColumn("_place", F.monotonically_increasing_id()), "order")
    dealt = dealt.withColumn("_range", F.shiftright("_place", _ROW_BITS))
    sums = dealt.groupBy("_range").agg(*[F.sum(w).alias(f"{w}_sum") for w in weights])
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    upto = sums.select("_range", *[F.coalesce(F.sum(f"{w}_sum").over(earlier), F.lit(0)).alias(f"{w}_upto") for w in weights])
    inside = Window.partitionBy("_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    return (
        dealt.withColumns({f"{w}_inside": F.coalesce(F.sum(w).over(inside), F.lit(0)) for w in weights})
        .join(F.broadcast(upto), "_range")
        .select(*df.columns, *[(F.col(f"{w}_upto") + F.col(f"{w}_inside")).alias(w) for w in weights])
    )


# --- bitmaps ------------------------------------------------------------------


def pack(low: np.ndarray, counts: np.ndarray) -> bytes:
    """A container: which low parts occur, and the further copies of those that occur again."""
    if len(low) < FEW:
        held = b"A" + np.uint16(len(low)).tobytes() + low.astype("<u2").tobytes()
    else:
        bits = np.zeros(1 << LOW_BITS, np.uint8)
        bits[low] = 1
        held = b"B" + np.packbits(bits, bitorder="little").tobytes()
    more = counts > 1
    return held + low[more].astype("<i8").tobytes() + (counts[more] - 1).astype("<i8").tobytes()


def unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The low parts in order and how often each occurs."""
    low, again, extra, _ = _parts(payload)
    counts = np.ones(len(low), np.int64)
    counts[np.searchsorted(low, again)] += extra
    return low, counts


def _parts(payload: bytes):
    if payload[:1] == b"A":
        n = int(np.frombuffer(payload, "<u2", 1, 1)[0])
        low, at, words = np.frombuffer(payload, "<u2", n, 3).astype(np.int64), 3 + 2 * n, None
    else:
        bitmap = np.frombuffer(payload, np.uint8, (1 << LOW_BITS) // 8, 1)
        low, at = np.flatnonzero(np.unpackbits(bitmap, bitorder="little")), 1 + len(bitmap)
        words = np.frombuffer(payload, "<u8", (1 << LOW_BITS) // 64, 1)
    rest = np.frombuffer(payload, "<i8", offset=at) if at < len(payload) else np.zeros(0, np.int64)
    return low, rest[: len(rest) // 2], rest[len(rest) // 2 :], words


def ranks(payload: bytes, wanted: np.ndarray) -> np.ndarray:
    """How many rows of the container have a smaller low part than each of ``wanted``."""
    low, again, extra, words = _parts(payload)
    if words is None:
        found = np.searchsorted(low, wanted)
    else:
        directory = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
        word, bit = wanted >> 6, (wanted & 63).astype(np.uint64)
        below = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        found = directory[word] + np.bitwise_count(below)
    upto = np.concatenate([[0], np.cumsum(extra)])
    return found + upto[np.searchsorted(again, wanted)]


def containers(ids: DataFrame) -> DataFrame:
    """sid, high, payload and n (rows) from ids (sid, high, low, n)."""
    schema = pa.schema([("sid", pa.int64()), ("high", pa.int64()), ("payload", pa.binary())])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sid, high, low, n = (batch.column(c).to_numpy() for c in ("sid", "high", "low", "n"))
            order = np.lexsort((low, high, sid))
            sid, high, low, n = sid[order], high[order], low[order], n[order]
            new = np.flatnonzero(np.r_[True, (sid[1:] != sid[:-1]) | (high[1:] != high[:-1])])
            ends = [*new[1:], len(sid)]
            payloads = [pack(low[a:b], n[a:b]) for a, b in zip(new, ends, strict=True)]
            yield arrow({"sid": sid[new], "high": high[new], "payload": payloads}, schema)

    def merge(key: tuple, group: pa.Table) -> pa.Table:
        counts = np.zeros(1 << LOW_BITS, np.int64)
        for payload in group.column("payload").to_pylist():
            low, n = unpack(payload)
            counts[low] += n
        low = np.flatnonzero(counts)
        merged = {"sid": [key[0].as_py()], "high": [key[1].as_py()], "payload": [pack(low, counts[low])]}
        return pa.table(merged | {"n": [int(counts.sum())]})

    made = ids.mapInArrow(gather, "sid long, high long, payload binary")
    return made.groupBy("sid", "high").applyInArrow(merge, "sid long, high long, payload binary, n long")


def located(rows: DataFrame, directory: DataFrame) -> DataFrame:
    """``rows`` (sid, high, low, doc_id, leaf, changed) with ``at``, the rank of the id in its group."""
    columns = ["sid", "high", "low", "doc_id", "leaf", "changed"]
    types = "sid long, high long, low long, doc_id long, leaf binary, changed binary, at long"

    def rank(key: tuple, group: pa.Table, held: pa.Table) -> pa.Table:
        container = held.to_pylist()
        at = np.zeros(group.num_rows, np.int64)
        if group.num_rows:
            at = container[0]["base"] + ranks(container[0]["payload"], group.column("low").to_numpy())
        return group.select(columns).append_column("at", pa.array(at, pa.int64()))

    return (
        rows.select(*columns).groupBy("sid", "high")
        .cogroup(directory.select("sid", "high", "payload", "base").groupBy("sid", "high"))
        .applyInArrow(rank, types)
    )


# --- the tree -----------------------------------------------------------------

_PATH = "array<struct<l string, r string>>"


def _block() -> Column:
    return F.floor(F.col("at") / BLOCK).cast("long")


def _slots(group: pa.Table) -> list[int]:
    """The rows of the group in the order of their slots."""
    return np.argsort(group.column("at").to_numpy(), kind="stable").tolist()


def climbed(spark: SparkSession, nodes: DataFrame, largest: int) -> list[DataFrame]:
    """Tables of nodes (sid, at, node, total), each three levels above the one before."""

    def reduce(key: tuple, group: pa.Table) -> pa.Table:
        total = group.column("total")[0].as_py()
        below = group.column("node").to_pylist()
        made = levels_of([below[i] for i in _slots(group)], total)
        for _ in made[1:]:
            total = -(-total // FAN)
        return pa.table({"sid": [key[0].as_py()], "at": [key[1].as_py()], "node": made[-1], "total": [total]})

    tables = [nodes]
    while largest > 1:
        grouped = tables[-1].withColumn("block", _block()).groupBy("sid", "block")
        tables.append(scratch(spark, grouped.applyInArrow(reduce, "sid long, at long, node string, total long"), "nodes"))
        largest = -(-largest // BLOCK)
    return tables


def descended(spark: SparkSession, tables: list[DataFrame], paths: DataFrame) -> DataFrame:
    """Paths (sid, at, path) to the root of the first table's nodes, from those of the last one's."""

    def extend(key: tuple, group: pa.Table, above: pa.Table) -> pa.Table:
        rows = _slots(group)
        at, total = group.column("at").to_pylist(), group.column("total")[0].as_py()
        below = group.column("node").to_pylist()
        levels, upper = levels_of([below[i] for i in rows], total), above.column("path")[0].as_py()
        own = [[{"l": a, "r": b} for a, b in siblings(levels, slot)] + upper for slot in range(len(rows))]
        kind = pa.list_(pa.struct([("l", pa.string()), ("r", pa.string())]))
        return pa.table(
            {"sid": [key[0].as_py()] * len(rows), "at": [at[i] for i in rows], "path": pa.array(own, kind)}
        )

    for nodes in reversed(tables[:-1]):
        children = nodes.withColumn("block", _block()).groupBy("sid", "block")
        parents = paths.withColumnRenamed("at", "block").groupBy("sid", "block")
        paths = scratch(spark, children.cogroup(parents).applyInArrow(extend, f"sid long, at long, path {_PATH}"), "paths")
    return paths


@dataclass
class Manifest:
    """Leaves in their places, the tables of nodes above them, and the groups' paths to the root."""

    spark: SparkSession
    leaves: DataFrame  # sid, at, doc_id, leaf, changed, total
    blocks: DataFrame | None  # sid, block, subroot, path, root; None for an empty table

    def rows(self, digest: bool = True) -> DataFrame:
        """A row a leaf; with ``digest`` the proof as a hash, else as its siblings (l, r)."""
        columns = "doc_id long, source_rank long, at long, leaf string, subroot string, root string"
        columns += ", proof_sha256 string" if digest else f", proof {_PATH}"
        columns += ", folded_root string, verified boolean"
        if self.blocks is None:
            return self.spark.createDataFrame([], columns)

        def prove(key: tuple, group: pa.Table, above: pa.Table) -> pa.Table:
            rows, block = _slots(group), above.to_pylist()[0]
            upper = [(x["l"], x["r"]) for x in block["path"]]
            upper_text = "".join(a + b for a, b in upper)
            nodes = [x.hex() for x in group.column("leaf").to_pylist()]
            changed = [x if x is None else x.hex() for x in group.column("changed").to_pylist()]
            levels = levels_of([nodes[i] for i in rows], group.column("total")[0].as_py())
            at, ids = group.column("at").to_pylist(), group.column("doc_id").to_pylist()
            out = []
            for slot, i in enumerate(rows):
                own = siblings(levels, slot)
                if digest:
                    text = "".join(a + b for a, b in own) + upper_text
                    proof = hashlib.sha256(text.encode()).hexdigest()
                else:
                    proof = [{"l": a, "r": b} for a, b in own + upper]
                root = folded(folded(changed[i] or nodes[i], own), upper)
                out.append((ids[i], key[0].as_py(), at[i], nodes[i], block["subroot"], block["root"], proof, root, root == block["root"]))
            names = [f.name for f in schema]
            return pa.table(dict(zip(names, map(list, zip(*out)))), schema=schema)

        path = pa.list_(pa.struct([("l", pa.string()), ("r", pa.string())]))
        schema = pa.schema(
            [("doc_id", pa.int64()), ("source_rank", pa.int64()), ("at", pa.int64()), ("leaf", pa.string())]
            + [("subroot", pa.string()), ("root", pa.string())]
            + [("proof_sha256", pa.string()) if digest else ("proof", path)]
            + [("folded_root", pa.string()), ("verified", pa.bool_())]
        )
        leaves = self.leaves.withColumn("block", _block()).groupBy("sid", "block")
        return leaves.cogroup(self.blocks.groupBy("sid", "block")).applyInArrow(prove, columns)


def manifest(
    spark: SparkSession,
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    id: str = "doc_id",
    group: str = "source",
    altered: dict[str, Column] | None = None,
    where: Column | None = None,
) -> Manifest:
    """The manifest of ``docs``; ``altered`` are values that rows ``where`` would have if tampered with."""
    prepare(spark)
    tampered = leaf([(altered or {}).get(f, F.col(f)) for f in fields])
    leaves = docs.select(
        F.col(id).cast("long").alias("doc_id"),
        F.col(group).cast("string").alias("source"),
        leaf([F.col(f) for f in fields]).alias("leaf"),
        F.when(where if where is not None else F.lit(False), tampered).alias("changed"),
    )
    leaves = scratch(spark, leaves, "leaves")

    # Groups in the order of their bytes, null first: sid, and the rows of earlier groups.
    groups = leaves.groupBy("source").agg(F.count("*").alias("total"))
    groups = in_order(
        spark, groups, [F.col("source").asc_nulls_first()], {"sid": F.lit(1).cast("long"), "start": F.col("total")}
    )
    groups = scratch(spark, groups, "groups")
    size, n_groups, largest = groups.select(
        F.sum(F.coalesce(F.octet_length("source"), F.lit(0)) + 40), F.count("*"), F.max("total")
    ).first()
    if not n_groups:
        return Manifest(spark, leaves, None)
    sent = if_small(groups.withColumnRenamed("source", "own"), 1, size)
    rows = leaves.join(sent, F.col("source").eqNullSafe(F.col("own"))).select(
        "sid",
        F.coalesce(F.shiftright("doc_id", LOW_BITS), F.lit(NO_ID)).alias("high"),
        F.coalesce(F.col("doc_id").bitwiseAND((1 << LOW_BITS) - 1), F.lit(0)).alias("low"),
        "doc_id", "leaf", "changed", "total",
    )

    # Bitmaps, their sums in order, and the rank of every id that occurs once.
    key = ["sid", "high", "low"]
    ids = scratch(spark, rows.groupBy(*key).agg(F.count("*").alias("n")), "ids")
    made = in_order(spark, containers(ids), [F.col("sid"), F.col("high")], {"before": F.col("n")})
    starts = if_small(groups.select("sid", "start"), n_groups, 16)
    directory = made.join(starts, "sid").withColumn("base", F.col("before") - F.col("start"))
    directory = scratch(spark, directory.select("sid", "high", "payload", "base"), "directory")
    again = ids.filter("n > 1").select(*key)
    n_again = again.count()
    hint = if_small(again, n_again, 24)
    once = rows.join(hint, key, "left_anti") if n_again else rows
    placed = located(once, directory).select("sid", "at", "doc_id", "leaf", "changed")
    if n_again:
        copies = rows.join(hint, key, "left_semi").drop("total")
        order = [*map(F.col, key), F.col("leaf")]
        copies = scratch(spark, in_order(spark, copies, order, {"place": F.lit(1).cast("long")}), "copies")
        none = F.lit(None).cast("binary")
        first = located(again.withColumns({"doc_id": F.col("low"), "leaf": none, "changed": none}), directory)
        first = first.select(*key, "at").join(copies.groupBy(*key).agg(F.min("place").alias("first")), key)
        first = if_small(first, n_again, 40)
        at = (F.col("at") + F.col("place") - F.col("first")).alias("at")
        placed = placed.unionByName(copies.join(first, key).select("sid", at, "doc_id", "leaf", "changed"))
    totals = if_small(groups.select("sid", "total"), n_groups, 16)
    placed = scratch(spark, placed.join(totals, "sid"), "placed")

    # Up to the root, and down again with the siblings.
    nodes = placed.select("sid", "at", F.lower(F.hex("leaf")).alias("node"), "total")
    tables = climbed(spark, nodes, largest)
    subroots = tables[-1].select("sid", F.col("node").alias("subroot"))
    top = subroots.select(F.lit(0).cast("long").alias("sid"), F.col("sid").alias("at"), F.col("subroot").alias("node"))
    over = climbed(spark, top.withColumn("total", F.lit(n_groups).cast("long")), n_groups)
    root = over[-1].first().node
    none = F.array().cast(_PATH)
    paths = descended(spark, over, over[-1].select("sid", "at", none.alias("path")))
    paths = paths.select(F.col("at").alias("sid"), F.lit(0).cast("long").alias("at"), "path")
    # The nodes of blocks of leaves start at the second table; a table of lone leaves is its own top.
    blocks = descended(spark, tables[1:], paths) if len(tables) > 1 else paths
    blocks = blocks.withColumnRenamed("at", "block").join(if_small(subroots, n_groups, 80), "sid")
    return Manifest(spark, placed, blocks.withColumn("root", F.lit(root)))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    made = manifest(
        spark,
        documents(spark, sf_dir),
        altered={"text": F.translate("text", upper, lower)},
        where=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
    )
    return made.rows().drop("source_rank", "at")


#: Levels the SQL can climb within a source and over sources.
SQL_LEVELS, SQL_TOP = 5, 3


def _sql() -> str:
    def run(level: str, key: str) -> str:
        return f"SELECT {key}, pos // 16 AS up, list(node ORDER BY pos) AS run FROM {level} GROUP BY ALL"

    def field(name: str) -> str:
        return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen(CAST({name} AS VARCHAR)) || ':' || {name} END"

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    head = " || ".join(map(field, FIELDS[:-1]))
    bits = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, z: xor(x >> 1, (x & 1) * 3988292384))"
    digits = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ord(d) AS BIGINT))"
    crc = f"xor(list_reduce(list_prepend(4294967295, {digits}), lambda c, b: {bits}), 4294967295)"
    left, right = "array_to_string(run[: pos % 16], '')", "array_to_string(run[pos % 16 + 2 :], '')"
    text = f"""
WITH hashed AS MATERIALIZED (
    SELECT doc_id, source, sha256({head} || {field('text')}) AS leaf,
           CASE WHEN {crc} % 5 = 0 THEN sha256({head} || {field(lowered)}) END AS changed
    FROM documents
), sources AS (
    SELECT source, count(*) AS total, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS sid
    FROM hashed GROUP BY source
), docs0 AS MATERIALIZED (
    SELECT sid, doc_id, leaf, total, coalesce(changed, leaf) AS fold, '' AS proof,
           row_number() OVER (PARTITION BY sid ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
    FROM hashed JOIN sources ON hashed.source IS NOT DISTINCT FROM sources.source
), nodes0 AS (SELECT sid, pos, leaf AS node, total FROM docs0)"""
    for n in range(SQL_LEVELS):
        text += f""", runs{n} AS MATERIALIZED ({run(f'nodes{n}', 'sid, total')}
), nodes{n + 1} AS (
    SELECT sid, up AS pos, CASE WHEN total > 1 THEN sha256(array_to_string(run, '')) ELSE run[1] END AS node,
           (total + 15) // 16 AS total FROM runs{n}
), docs{n + 1} AS MATERIALIZED (
    SELECT d.sid, doc_id, leaf, pos // 16 AS pos, (d.total + 15) // 16 AS total,
           CASE WHEN d.total > 1 THEN sha256({left} || fold || {right}) ELSE fold END AS fold,
           CASE WHEN d.total > 1 THEN proof || {left} || {right} ELSE proof END AS proof
    FROM docs{n} d JOIN runs{n} r ON d.sid = r.sid AND d.pos // 16 = r.up
)"""
    text += f""", tops0 AS (
    SELECT sid AS pos, node, (SELECT count(*) FROM sources) AS total FROM nodes{SQL_LEVELS}
), up0 AS (
    SELECT doc_id, leaf, node AS subroot, fold, proof, d.sid AS pos, (SELECT count(*) FROM sources) AS total
    FROM docs{SQL_LEVELS} d JOIN nodes{SQL_LEVELS} n USING (sid)
)"""
    for n in range(SQL_TOP):
        text += f""", over{n} AS MATERIALIZED ({run(f'tops{n}', 'total')}
), tops{n + 1} AS (
    SELECT up AS pos, CASE WHEN total > 1 THEN sha256(array_to_string(run, '')) ELSE run[1] END AS node,
           (total + 15) // 16 AS total FROM over{n}
), up{n + 1} AS MATERIALIZED (
    SELECT doc_id, leaf, subroot, pos // 16 AS pos, (u.total + 15) // 16 AS total,
           CASE WHEN u.total > 1 THEN sha256({left} || fold || {right}) ELSE fold END AS fold,
           CASE WHEN u.total > 1 THEN proof || {left} || {right} ELSE proof END AS proof
    FROM up{n} u JOIN over{n} r ON u.pos // 16 = r.up
)"""
    return (
        text
        + f"""
SELECT doc_id, leaf, subroot, node AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = node AS verified
FROM up{SQL_TOP}, tops{SQL_TOP}
"""
    )


OP13_SQL = _sql()
