"""Scores of a log-bilinear language model.

Tokens are lower-cased words, then one end. The most frequent tokens are symbols of
their own; every other word is drawn in two steps, its class (a hash of its last two
bytes: endings tell languages and marks apart) as a symbol, then the word within the
class by its smoothed count. So the model normalises over symbols and is still a
distribution over all words, an unknown one for each class included. Shortlist and
classes grow with the cube root of the vocabulary (``sizes_of``), so the sequences that
can be learnt grow with the corpus, and the square of the symbols stays a table that a
task can hold.

The vector predicted for the next symbol is the sum of the two tokens before, each
weighted by its place; a symbol's score is its product with the symbol's vector plus
a bias, which starts as its log frequency. Vectors are trained by noise-contrastive
estimation from the counts of all three-symbol sequences of the training texts. The
counts are summed over the corpus first, so that training reads each sequence once a
round. In each round the sequences are learnt in parts, each from common parameters, and
the means over all parts are the next round's; only these parameters come to the driver.
As a context is a sum of two vectors, the exponential of a score is a product of
one factor for each token before, and the sums over all symbols for all pairs of tokens
before are one product of two matrices.

Counts of words beyond the ``common`` most frequent are joined to the texts' words.

Defined cases: null and empty texts are one end; the tokens before a text are ends; a
null id counts as an empty one in the split; without training texts all symbols are
equally likely; texts of any length are scored whole, each row on its own; an empty
table gives an empty result; other columns are not looked at.
"""

import zlib
from collections.abc import Iterator
from functools import lru_cache
from math import log10
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import arrow, documents, remainder, scratch, slices, words

END = b""  # no word is empty
#: Symbols of each kind for each unit of the vocabulary's cube root, the fewest of them,
#: and the length of their vectors.
SHORTLIST_GROWTH, CLASS_GROWTH, FEWEST, DIMENSIONS = 16, 4, 16, 32
ROUNDS, BATCH, NOISE, RATE = 3, 512, 64, 0.2
#: Sequences that are learnt from common parameters at once, the fewest steps of such a part
#: in a round (a small one is read again), parameters that are averaged together, the groups
#: of tasks that are summed first, and rows of a matrix that are multiplied at once.
SHARE, LEAST_STEPS, BLOCK, GROUPS, ROWS = 500_000, 150, 1024, 256, 1024
#: The sums of a block of parameters over the parts of some tasks, times the tokens seen.
SUMS = pa.schema([("block", pa.int64()), ("sums", pa.binary()), ("task", pa.int64()), ("seen", pa.float64())])
#: Words whose counts are sent to every task, and the longest of them in bytes.
COMMON, COMMON_BYTES = 100_000, 64
#: Distinct words, or sequences, that a task gathers before it passes them on, and the
#: sequences of the texts for each group in which they are summed.
GATHERED, IN_GROUP = 1_000_000, 250_000
#: Tokens that are scored at once; their vectors stay in a core's cache.
AT_ONCE = 4096
LN10 = float(np.log(10))


def sizes_of(distinct: int) -> tuple[int, int]:
    """Shortlist and classes for a vocabulary of ``distinct`` tokens."""
    root = distinct ** (1 / 3)
    return max(FEWEST, round(SHORTLIST_GROWTH * root)), max(FEWEST, round(CLASS_GROWTH * root))


def class_of(word: bytes, classes: int) -> int:
    return zlib.crc32(word[-2:]) % classes


@lru_cache(maxsize=2)
def classes_by_ending(classes: int) -> np.ndarray:
    """The class of each ending: 256 of one byte, then all of two."""
    endings = [*(bytes([x]) for x in range(256)), *(bytes([x, y]) for x in range(256) for y in range(256))]
    return np.array([class_of(x, classes) for x in endings])


def classes_of(listed: pa.Array, classes: int) -> np.ndarray:
    """The class of each word; none is empty."""
    if not len(listed):
        return np.zeros(0, np.int64)
    _, offsets, data = listed.buffers()
    at = np.frombuffer(offsets, np.int32)[listed.offset : listed.offset + len(listed) + 1].astype(np.int64)
    byte = np.frombuffer(data, np.uint8)
    last, before = byte[at[1:] - 1].astype(np.int64), byte[at[1:] - 2].astype(np.int64)
    return classes_by_ending(classes)[np.where(np.diff(at) > 1, 256 + 256 * before + last, last)]


def places_of(listed: pa.Array, among: pa.Array) -> np.ndarray:
    """Where each word is ``among`` others, -1 if nowhere."""
    return pc.index_in(listed, value_set=among).fill_null(-1).to_numpy().astype(np.int64)


class Symbols(NamedTuple):
    """The shortlist, most frequent first, and what the corpus counted."""

    shortlist: tuple[bytes, ...]
    classes: int
    counts: tuple[int, ...]  # tokens of each symbol
    class_words: tuple[int, ...]  # distinct words of each class
    tokens: int
    distinct: int

    @property
    def size(self) -> int:
        return len(self.shortlist) + self.classes

    def numbers(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate(self.shortlist)}

    def of(self, distinct: pa.Array) -> np.ndarray:
        own = places_of(distinct, pa.array(self.shortlist, pa.binary()))
        return np.where(own < 0, len(self.shortlist) + classes_of(distinct, self.classes), own)


class Parameters(NamedTuple):
    before: np.ndarray  # symbol x dimension, as a token before
    after: np.ndarray  # symbol x dimension, as the next
    place: np.ndarray  # 2 x dimension: one back, two back
    bias: np.ndarray

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self])

    @classmethod
    def of(cls, flat: np.ndarray, symbols: int, dimensions: int) -> "Parameters":
        n = symbols * dimensions
        return cls(
            flat[:n].reshape(symbols, dimensions),
            flat[n : 2 * n].reshape(symbols, dimensions),
            flat[2 * n : 2 * n + 2 * dimensions].reshape(2, dimensions),
            flat[2 * n + 2 * dimensions :],
        )


def noise_of(counts: tuple[int, ...]) -> np.ndarray:
    smooth = np.array(counts, np.float64) + 0.5
    return smooth / smooth.sum()


def first_parameters(symbols: Symbols, dimensions: int = DIMENSIONS) -> Parameters:
    rng = np.random.default_rng(0)
    small = lambda: rng.normal(0, 0.1, (symbols.size, dimensions)).astype(np.float32)
    place = np.array([[1.0], [0.5]], np.float32) * np.ones((2, dimensions), np.float32)
    return Parameters(small(), small(), place, np.log(noise_of(symbols.counts)).astype(np.float32))


# --- counting ---------------------------------------------------------------


class Tally:
    """Sums of counts by key, in Arrow; ``full`` when it should be passed on."""

    def __init__(self, kind: pa.DataType, limit: int = GATHERED):
        self.schema = pa.schema([("key", kind), ("n", pa.int64())])
        self.limit, self.parts, self.rows = limit, [], 0

    def add(self, keys, counts) -> None:
        self.parts.append(pa.table([pa.array(keys, self.schema[0].type), pa.array(counts)], schema=self.schema))
        self.rows += len(self.parts[-1])
        if self.rows > self.limit:
            self.parts = [self.sums()]
            self.rows = len(self.parts[0])
            pa.default_memory_pool().release_unused()

    def sums(self) -> pa.Table:
        every = pa.concat_tables(self.parts) if self.parts else self.schema.empty_table()
        found = every.group_by("key").aggregate([("n", "sum")])
        return pa.table([found["key"], found["n_sum"]], schema=self.schema)

    def full(self) -> bool:
        return 2 * self.rows > self.limit

    def out(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            yield from self.sums().to_batches(max_chunksize=50_000)
        self.parts, self.rows = [], 0


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all ``texts``, ends included."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Tally(pa.binary())
        for batch in slices(batches):
            _, word, distinct = words(batch.column("text"), lower=True)
            held.add(distinct, np.bincount(word, minlength=len(distinct)))
            held.add([END], [batch.num_rows])
            if held.full():
                yield from held.out()
        yield from held.out()

    found = texts.select("text").mapInArrow(count, "key binary, n long")
    return found.groupBy(F.col("key").alias("word")).agg(F.sum("n").alias("n"))


def sequence_of(doc: np.ndarray, word: np.ndarray, symbol: np.ndarray, n_docs: int):
    """Symbols of the texts one after the other, each with its end, and their texts."""
    at = np.arange(len(word)) + doc  # one end for each text before
    sizes = np.bincount(doc, minlength=n_docs) + 1
    out = np.zeros(int(sizes.sum()), np.int64)
    out[at] = symbol[word] if len(word) else 0
    ends = np.cumsum(sizes) - 1
    return out, ends, np.repeat(np.arange(n_docs), sizes)


def before_each(stream: np.ndarray, ends: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbols one and two back; before a text there are ends."""
    one = np.r_[end, stream[:-1]].astype(np.int64)
    two = np.r_[end, one[:-1]].astype(np.int64)
    starts = np.r_[0, ends[:-1] + 1] if len(ends) else ends
    two[starts] = end
    return one, two


def mixing_hash(keys: np.ndarray) -> np.ndarray:
    """A hash of each key, as Spark's ``xxhash64`` gives it; different keys have different ones."""
    one, two, three = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
    turn = lambda x, by: (x << np.uint64(by)) | (x >> np.uint64(64 - by))
    h = (turn(keys.astype(np.uint64) * two, 31) * one) ^ np.uint64(42 + 0x27D4EB2F165667C5 + 8)
    h = turn(h, 27) * one + np.uint64(0x85EBCA77C2B2AE63)
    h = (h ^ (h >> np.uint64(33))) * two
    h = (h ^ (h >> np.uint64(29))) * three
    return (h ^ (h >> np.uint64(32))).view(np.int64)


def sequences(texts: DataFrame, symbols: Symbols) -> DataFrame:
    """(key, n): how often each sequence of three symbols occurs.

    A group has a range of the keys' hashes, and its keys come in the order of the hash, so
    each stretch of them is a mixture. To the groups they travel as arrays, sorted and counted.
    """
    size, end = symbols.size, symbols.numbers()[END]
    groups = max(1, -(-symbols.tokens // IN_GROUP))

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        of = (((mixing_hash(keys) >> 32) + (1 << 31)) * groups) >> 32
        order = np.argsort(of, kind="stable")
        keys, counts = keys[order], counts[order]
        found, first = np.unique(of[order], return_index=True)
        cut = lambda x: [part.tobytes() for part in np.split(x, first[1:])]
        return pa.RecordBatch.from_arrays([pa.array(found), pa.array(cut(keys)), pa.array(cut(counts))], ["of", "keys", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in slices(batches):
            doc, word, distinct = words(batch.column("text"), lower=True)
            stream, ends, _ = sequence_of(doc, word, symbols.of(distinct), batch.num_rows)
            stream[ends] = end
            one, two = before_each(stream, ends, end)
            held.append((two * size + one) * size + stream)
            rows += len(stream)
            if rows > GATHERED:
                yield packed(held)
                held, rows = [], 0
        if rows:
            yield packed(held)

    def summed(rows: pa.Table) -> pa.Table:
        keys, counts = (np.frombuffer(b"".join(rows[x].to_pylist()), np.int64) for x in ("keys", "counts"))
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        keys, counts = keys[first], np.add.reduceat(counts, first)
        order = np.argsort(mixing_hash(keys))
        return pa.table({"key": keys[order], "n": counts[order]})

    found = texts.select("text").mapInArrow(count, "of long, keys binary, counts binary")
    return found.groupBy("of").applyInArrow(summed, "key long, n long")


# --- training ---------------------------------------------------------------


def _runs(at: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places in ``at`` (below ``most``), an order that puts equal ones together, and where each begins."""
    order = np.argsort(at.astype(np.uint16) if most <= 1 << 16 else at, kind="stable")  # short ones are sorted faster
    at = at.take(order)
    new = np.empty(len(at), bool)
    new[0] = True
    np.not_equal(at[1:], at[:-1], out=new[1:])
    first = np.flatnonzero(new)
    return at.take(first), order, first


def _sums(rows: np.ndarray, order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sum of the rows of each place; most have one row, which needs no sum."""
    sizes = np.diff(first, append=len(order))
    out, many = rows.take(order.take(first), axis=0), np.flatnonzero(sizes > 1)
    if len(many):
        sizes_of_many = sizes.take(many)
        starts = np.cumsum(sizes_of_many) - sizes_of_many
        out[many] = np.add.reduceat(rows.take(order[np.repeat(sizes > 1, sizes)], axis=0), starts, axis=0)
    return out


class Trainer:
    """Noise-contrastive steps with a rate for each parameter (Adagrad).

    A step touches only the rows of its tokens, so its cost doesn't grow with the symbols.
    """

    def __init__(self, start: Parameters, noise: np.ndarray, mean_count: float, rate: float, seed: list[int]):
        self.now = Parameters(*(x.copy() for x in start))
        self.squares = Parameters(*(np.full_like(x, 1e-2) for x in start))
        self.upto, self.rate, self.mean = np.cumsum(noise), rate, mean_count
        self.log_noise = (np.log(noise) + np.log(NOISE)).astype(np.float32)
        self.rng = np.random.default_rng(seed)

    def move(self, values: np.ndarray, squares: np.ndarray, at, slope: np.ndarray) -> None:
        squares[at] = square = squares[at] + slope * slope
        by = np.float32(self.rate) * slope
        by /= np.sqrt(square, out=square)
        values[at] += by

    def step(self, two: np.ndarray, one: np.ndarray, next: np.ndarray, count: np.ndarray) -> None:
        before, after, place, bias = self.now
        n = len(count)
        # Slopes are means over the sequences, times the root of their number.
        weight = (count / (self.mean * np.sqrt(n))).astype(np.float32)
        r1, r2 = before.take(one, axis=0), before.take(two, axis=0)
        predicted = r1 * place[0]
        predicted += r2 * place[1]
        drawn = np.searchsorted(self.upto, self.rng.random(NOISE) * self.upto[-1], side="right")
        drawn = np.minimum(drawn, len(self.upto) - 1)
        near, far = after.take(next, axis=0), after.take(drawn, axis=0)
        real = (predicted * near).sum(axis=1) + bias[next] - self.log_noise[next]
        up = weight / (1 + np.exp(np.minimum(real, 30)))
        down = predicted @ far.T  # becomes the slope of each noise symbol's score, in place
        down += bias[drawn]
        down -= self.log_noise[drawn]
        np.negative(np.maximum(down, -30, out=down), out=down)
        np.exp(down, out=down)
        down += 1
        np.divide(-weight[:, None], down, out=down)
        near *= up[:, None]
        to_predicted = down @ far
        to_predicted += near
        places = np.stack([(to_predicted * r1).sum(axis=0), (to_predicted * r2).sum(axis=0)])
        slopes, at = np.empty((n + NOISE, predicted.shape[1]), np.float32), np.concatenate([next, drawn])
        np.multiply(up[:, None], predicted, out=slopes[:n])
        np.matmul(down.T, predicted, out=slopes[n:])
        at, order, first = _runs(at, len(bias))
        self.move(after, self.squares.after, at, _sums(slopes, order, first))
        own = np.concatenate([up, down.sum(axis=0)])
        self.move(bias, self.squares.bias, at, np.add.reduceat(own.take(order), first))
        slopes = np.empty((2 * n, predicted.shape[1]), np.float32)
        np.multiply(to_predicted, place[0], out=slopes[:n])
        np.multiply(to_predicted, place[1], out=slopes[n:])
        at, order, first = _runs(np.concatenate([one, two]), len(bias))
        self.move(before, self.squares.before, at, _sums(slopes, order, first))
        self.move(place, self.squares.place, slice(None), places)


def parts_of(batches: Iterator[pa.RecordBatch], size: int = SHARE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys and counts of at least ``size`` sequences at a time, and of the rest."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= size:
            table = pa.Table.from_batches(held)
            yield table["key"].to_numpy(), table["n"].to_numpy()
            held, rows = [], 0
    if rows:
        table = pa.Table.from_batches(held)
        yield table["key"].to_numpy(), table["n"].to_numpy()


def train(
    spark: SparkSession, counted: DataFrame, symbols: Symbols, rounds: int = ROUNDS, dimensions: int = DIMENSIONS
) -> Parameters:
    """Parameters after ``rounds`` over the sequence counts, which come mixed (see ``sequences``)."""
    now, noise, size = first_parameters(symbols, dimensions), noise_of(symbols.counts), symbols.size
    counted = scratch(spark, counted.select("key", "n"), "sequences")
    n, total = counted.agg(F.count("*"), F.sum("n")).first()
    if not n:
        return now
    for round in range(rounds):
        start, rate = spark.sparkContext.broadcast(now), RATE / (1 + round)

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            value, seen = 0.0, 0.0
            for keys, counts in parts_of(batches):
                trainer = Trainer(start.value, noise, total / n, rate, [round, int(keys[0])])
                steps = 0
                while not steps or steps < LEAST_STEPS:
                    order = trainer.rng.permutation(len(keys))
                    for i in range(0, len(order), BATCH):
                        key, many = keys[order[i : i + BATCH]], counts[order[i : i + BATCH]]
                        trainer.step(key // (size * size), key // size % size, key % size, many)
                        steps += 1
                many = float(counts.sum())
                value, seen = value + trainer.now.flat().astype("<f8") * many, seen + many
            if seen:
                blocks = [value[i : i + BLOCK].tobytes() for i in range(0, len(value), BLOCK)]
                columns = {"block": range(len(blocks)), "sums": blocks}
                columns |= {"task": [TaskContext.get().partitionId()] * len(blocks), "seen": [seen] * len(blocks)}
                yield arrow(columns, SUMS)

        def added(of: tuple, rows: pa.Table) -> pa.Table:
            rows = rows.sort_by("task")  # so that sums come out the same every time
            sums = np.sum([np.frombuffer(x, "<f8") for x in rows.column("sums").to_pylist()], axis=0)
            seen = float(np.sum(rows.column("seen").to_numpy()))
            task = rows.column("task")[0].as_py() % GROUPS
            return pa.table([pa.array([x], f.type) for x, f in zip((of[0].as_py(), sums.tobytes(), task, seen), SUMS)], schema=SUMS)

        ddl = "block long, sums binary, task long, seen double"
        parts = counted.mapInArrow(learn, ddl)
        some = parts.groupBy("block", (F.col("task") % GROUPS).alias("of")).applyInArrow(added, ddl)
        found = some.groupBy("block").applyInArrow(added, ddl).collect()
        blocks = [np.frombuffer(r["sums"], "<f8") / r["seen"] for r in sorted(found, key=lambda r: r["block"])]
        now = Parameters.of(np.concatenate(blocks).astype(np.float32), size, dimensions)
    return now


# --- scoring ----------------------------------------------------------------


class Scorer:
    """Log10 probabilities of symbols after two others."""

    def __init__(self, parameters: Parameters):
        self.p = p = parameters
        self.size = len(p.bias)
        self.one_back, self.two_back = p.before * p.place[0], p.before * p.place[1]
        # exp(score) is a factor of one back times a factor of two back: all sums over the
        # next symbol are a product of matrices. Each factor is taken over its row's largest.
        far = self.two_back @ p.after.T
        far_top = far.max(axis=1)
        np.exp(np.subtract(far, far_top[:, None], out=far), out=far)
        self.sums = np.empty((self.size, self.size), np.float32)  # one back, two back
        for i in range(0, self.size, ROWS):
            near = self.one_back[i : i + ROWS] @ p.after.T + p.bias
            top = near.max(axis=1, keepdims=True)
            found = np.exp(near - top) @ far.T
            self.sums[i : i + ROWS] = np.log(np.maximum(found, 1e-30)) + top + far_top
            for one in np.flatnonzero(found.min(axis=1) < 1e-25):  # too far apart for a product
                two = np.flatnonzero(found[one] < 1e-25)
                scores = near[one] + self.two_back[two] @ p.after.T
                most = scores.max(axis=1, keepdims=True)
                self.sums[i + one, two] = np.log(np.exp(scores - most).sum(axis=1)) + most[:, 0]

    def log10(self, one: np.ndarray, two: np.ndarray, next: np.ndarray) -> np.ndarray:
        p, out = self.p, np.empty(len(next))
        for i in range(0, len(next), AT_ONCE):
            part = slice(i, i + AT_ONCE)
            scores = self.one_back.take(one[part], axis=0)
            scores += self.two_back.take(two[part], axis=0)
            scores *= p.after.take(next[part], axis=0)
            out[part] = scores.sum(axis=1) + p.bias[next[part]] - self.sums[one[part], two[part]]
        return out / LN10


class Model(NamedTuple):
    symbols: Symbols
    parameters: Parameters
    common: dict[bytes, int]  # the most frequent words and their counts


@lru_cache(maxsize=1)  # the tasks of a worker share its sums
def scorer_of(model) -> Scorer:
    return Scorer(model.value.parameters)


@lru_cache(maxsize=1)
def common_of(model) -> tuple[pa.Array, np.ndarray]:
    """The common words, and their counts with a -1 behind them."""
    common = model.value.common
    return pa.array(list(common), pa.binary()), np.array([*common.values(), -1], np.int64)


def scores(docs: DataFrame, counts: DataFrame, model, spark: SparkSession) -> DataFrame:
    """``docs`` (doc_id, held_out, text) with all the counts and scores.

    ``model`` is a broadcast Model; ``counts`` is the whole vocabulary.
    """
    kinds = {
        "row": pa.int64(),
        "doc_id": pa.int64(),
        "held_out": pa.bool_(),
        "n_tokens": pa.int64(),
        "n_known": pa.int64(),
        "base_score": pa.float64(),
        "score": pa.float64(),
        "rare": pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())])),
    }
    schema = pa.schema(list(kinds.items()))
    ddl = (
        "row long, doc_id long, held_out boolean, n_tokens long, n_known long, "
        "base_score double, score double, rare array<struct<word: binary, n: long>>"
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, _, common = model.value
        scorer, (common_words, common_counts) = scorer_of(model), common_of(model)
        end, first = symbols.numbers()[END], len(symbols.shortlist)
        # The share of a class's word is (count + 1) of all these.
        class_all = np.array(symbols.counts[first:]) + np.array(symbols.class_words) + 1
        base_all = log10(symbols.tokens + symbols.distinct + 1)
        end_count = common.get(END, 0)
        for batch in slices(batches):
            doc, word, distinct = words(batch.column("text"), lower=True)
            n, symbol = batch.num_rows, symbols.of(distinct)
            stream, ends, owner = sequence_of(doc, word, symbol, n)
            stream[ends] = end
            one, two = before_each(stream, ends, end)
            total = np.bincount(owner, scorer.log10(one, two, stream), minlength=n)
            # Within the class: a logarithm of the count now or by the join, less that of all.
            count = common_counts[places_of(distinct, common_words)]
            rare, listed_class = count < 0, symbol - first
            in_class = listed_class >= 0
            more = np.log10(np.maximum(count, 0) + 1.0)
            inner = np.where(in_class, more - np.log10(class_all[np.maximum(listed_class, 0)]), 0.0)
            weigh = lambda x: np.bincount(doc, x[word] if len(x) else None, minlength=n)
            n_tokens = np.bincount(doc, minlength=n) + 1
            known = weigh((count > 0).astype(np.float64)).astype(np.int64) + (end_count > 0)
            base = weigh(more) + log10(end_count + 1) - n_tokens * base_all
            # Each text's rare words, once each.
            late = rare[word] if len(distinct) else np.zeros(0, bool)
            pair, many = np.unique(doc[late] * max(1, len(distinct)) + word[late], return_counts=True)
            sizes = np.bincount(pair // max(1, len(distinct)), minlength=n)
            rare_words = pa.StructArray.from_arrays(
                [distinct.take(pa.array(pair % max(1, len(distinct)))), pa.array(many, pa.int64())],
                ["word", "n"],
            )
            offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
            columns = {
                "row": batch.column("row"),
                "doc_id": batch.column("doc_id"),
                "held_out": batch.column("held_out"),
                "n_tokens": pa.array(n_tokens),
                "n_known": pa.array(known),
                "base_score": pa.array(base),
                "score": pa.array(total + weigh(inner)),
                "rare": pa.ListArray.from_arrays(offsets, rare_words),
            }
            yield pa.RecordBatch.from_arrays(
                [columns[f.name].cast(f.type) for f in schema], schema=schema
            )

    numbered = docs.withColumn("row", F.monotonically_increasing_id())
    part = scratch(
        spark, numbered.select("row", "doc_id", "held_out", "text").mapInArrow(score, ddl), "lm-parts"
    )
    late = part.select("row", F.explode("rare").alias("of")).select("row", "of.word", F.col("of.n").alias("times"))
    found = (
        late.join(counts, "word")
        .groupBy("row")
        .agg(
            F.sum("times").alias("more_known"),
            F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more_score"),
        )
    )
    more = F.coalesce("more_score", F.lit(0.0))
    return part.drop("rare").join(found, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.value.symbols.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )


def symbols_of(counts: DataFrame, shortlist: int | None = None, classes: int | None = None, common: int = COMMON):
    """The symbols, and the ``common`` most frequent words with their counts."""
    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    by_size = sizes_of(distinct)
    shortlist, classes = shortlist or by_size[0], classes or by_size[1]
    short_words = counts.filter(F.octet_length("word").between(1, COMMON_BYTES))
    top = short_words.orderBy(F.desc("n"), "word").limit(shortlist - 1).collect()
    # Counts in steps of a tenth: the lowest step from which on no more than ``common`` words are.
    step = F.floor(F.log("n") / F.log(F.lit(1.1))).cast("int")
    steps = short_words.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()
    lowest, held = None, 0
    for row in steps:
        held += row["count"]
        if held > common:
            break
        lowest = row["step"]
    more = short_words.filter(step >= lowest).collect() if lowest is not None else []
    often = {bytes(r["word"]): int(r["n"]) for r in [*top, *more]}
    ends = int(counts.filter(F.octet_length("word") == 0).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    often[END] = ends
    short = [END, *[bytes(r["word"]) for r in top]]
    key = F.crc32(F.substring("word", -2, 2)) % classes
    of_class = {
        r["class"]: (int(r["n"]), r["words"])
        for r in counts.filter(F.octet_length("word") > 0)
        .groupBy(key.alias("class"))
        .agg(F.sum("n").alias("n"), F.count("*").alias("words"))
        .collect()
    }
    n, words_of = np.zeros(classes, np.int64), np.zeros(classes, np.int64)
    for c, (total, size) in of_class.items():
        n[c], words_of[c] = total, size
    for w in short[1:]:
        n[class_of(w, classes)] -= often[w]
        words_of[class_of(w, classes)] -= 1
    counts_of = (*[often[w] for w in short], *n.tolist())
    return Symbols(tuple(short), classes, counts_of, tuple(words_of.tolist()), int(tokens), int(distinct)), often


def scored(spark: SparkSession, docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``docs`` (doc_id, held_out, text), scored by a model of those not held out."""
    training = docs.filter(~F.col("held_out"))
    counts = scratch(spark, word_counts(training), "words")
    symbols, often = symbols_of(counts)
    parameters = train(spark, sequences(training, symbols), symbols, rounds)
    model = spark.sparkContext.broadcast(Model(symbols, parameters, often))
    return scores(docs, counts, model, spark)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", remainder("doc_id", 7) == 2)
    return scored(spark, docs)
