"""Mixing sources to target weights by weighted fair queueing.

Every document of a source gets a place in the source's shuffled order. A copy's
virtual finish time is the source's words up to and including it, divided by the
source's target. All copies are put in order of finish time, and the mix is what
comes before the total budget is used up: a source with twice the target moves
twice as fast, so all arrive at their targets together.

No sum is made in one place. Within a source the order is cut into ranges of the
shuffle key, as many as the square root of the rows; over all sources finish
times are cut into ranges likewise. Ranges are summed first, and only rows of one
range are ever ordered in one task. Only the range in which the budget ends is
looked at row by row.

Defined cases: null text has size 0 and is never taken; a null source is a source
of its own, last in order; a null id is shuffled as an empty one; equal rows may
swap places, which changes nothing; an empty table gives an empty result; other
columns pass through ``mix`` as long as they don't clash with those it adds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm.common import WORD, documents, fresh_name, if_small, numbered, scratch

WEIGHTS = (5, 2, 1)
EPOCHS = 3
SEED = "mix"


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, budget: int, weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """A target for each source (``nameless``, ``name``, ``source_size``).

    Sources share ``budget`` by weight; none gets over ``epochs`` times its size,
    and what it leaves goes to the others by weight. In order of size per weight
    the sources that reach their limit come first, so the common level is the
    highest that any source would see if all before it were at their limits.
    One row per source; sources are names, so their table is small.
    """
    in_order = Window.orderBy("nameless", "name")
    fill = Window.orderBy("ratio", "nameless", "name")
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]),
        ((F.row_number().over(in_order) - 1) % len(weights) + 1).cast("int"),
    )
    level = (F.lit(float(budget)) - F.coalesce("before", F.lit(0)).cast("double")) / F.col("left")
    return (
        sizes.withColumn("weight", weight)
        .withColumn("cap", epochs * F.col("source_size"))
        .withColumn("ratio", F.col("cap").cast("double") / F.col("weight"))
        .withColumn("before", F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn(
            "left", F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing))
        )
        .withColumn("level", F.max(level).over(Window.partitionBy()))
        .select(
            "nameless",
            "name",
            "source_size",
            F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target"),
        )
    )


def mix(
    spark: SparkSession,
    rows: DataFrame,
    share: float = 1.0,
    weights=WEIGHTS,
    epochs: int = EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """``rows`` (doc_id, source, size, …) with source_size, target, copies and taken."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    keyed = scratch(
        spark,
        rows.withColumn("nameless", F.col("source").isNull())
        .withColumn("name", F.coalesce("source", F.lit("")))
        .withColumn("place", key),
        "mix-rows",
    )
    n, total = keyed.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    budget, ranges = int(share * total), max(1, int((epochs * n) ** 0.5))

    by_source, by_range = ["nameless", "name"], ["nameless", "name", "range"]
    prefix = F.conv(F.substring("place", 1, 8), 16, 10).cast("long")
    ranged = keyed.withColumn("range", F.floor(prefix * ranges / F.lit(2**32)).cast("long"))
    range_sums = ranged.groupBy(*by_range).agg(F.sum("size").alias("range_size"))
    sources = targets(
        range_sums.groupBy(*by_source).agg(F.sum("range_size").alias("source_size")),
        budget,
        weights,
        epochs,
    )
    ahead = Window.partitionBy(*by_source).orderBy("range")
    starts = (
        range_sums.withColumn("start", F.sum("range_size").over(ahead) - F.col("range_size"))
        .join(sources, by_source)
        .drop("range_size")
    )
    in_range = Window.partitionBy(*by_range).orderBy("place", "doc_id", "size")
    timed = scratch(
        spark,
        ranged.withColumn(
            "upto", F.sum("size").over(in_range.rowsBetween(Window.unboundedPreceding, 0))
        )
        .join(starts, by_range)
        .withColumn("upto", F.col("upto") + F.col("start"))
        .drop("range", "start", "nameless", "name"),
        "mix-times",
    )

    # The order of copies: finish time, then the shuffle key.
    def finish(epoch: int | Column) -> Column:
        words = epoch * F.col("source_size") + F.col("upto")
        return F.when(F.col("size") > 0, words.cast("double") / F.col("target"))

    def cell(at: Column) -> Column:
        """Ranges of finish time; after the targets are met they widen by proportion."""
        late = ranges + F.floor(ranges * F.log2(F.greatest(at, F.lit(1.0))))
        return F.when(at <= 1, F.floor(at * ranges)).otherwise(late).cast("long")

    copies = (
        timed.filter("size > 0")
        .select("size", "place", "doc_id", "source_size", "target", "upto")
        .withColumn("epoch", F.explode(F.array(*[F.lit(e) for e in range(epochs)])))
        .withColumn("finish", finish(F.col("epoch")))
        .withColumn("cell", cell(F.col("finish")))
    )
    cells = copies.groupBy("cell").agg(F.sum("size").alias("words"))
    running = cells.withColumn("upto", F.sum("words").over(Window.orderBy("cell")))
    last = running.filter(F.col("upto") > budget).orderBy("cell").limit(1).collect()
    if not last:
        taken = [F.col("size") > 0] * epochs
    else:
        end, before = last[0]["cell"], last[0]["upto"] - last[0]["words"]
        order = ["finish", "place", "doc_id", "size", "epoch"]
        fits = (
            copies.filter(F.col("cell") == end)
            .withColumn("running", F.sum("size").over(Window.orderBy(*order)))
            .filter(F.col("running") + before <= budget)
        )
        cut = fits.agg(F.max(F.struct(*order)).alias("cut")).first()["cut"]

        def is_in(epoch: int) -> Column:
            at = finish(epoch)
            inside = F.lit(False)
            if cut is not None:
                mine = F.struct(at, "place", "doc_id", "size", F.lit(epoch))
                theirs = F.struct(
                    F.lit(cut["finish"]),
                    F.lit(cut["place"]),
                    F.lit(cut["doc_id"]).cast(dict(timed.dtypes)["doc_id"]),
                    F.lit(cut["size"]).cast("long"),
                    F.lit(cut["epoch"]),
                )
                inside = (cell(at) == end) & (mine <= theirs)
            return F.coalesce((cell(at) < end) | inside, F.lit(False))

        taken = [is_in(e) for e in range(epochs)]
    count = sum((t.cast("int") for t in taken), F.lit(0))
    return (
        timed.withColumn("copies", count)
        .withColumn("taken", F.col("size") * F.col("copies"))
        .drop("place", "upto")
    )


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rows = docs.select("doc_id", "source", word_count("text").alias("size"))
    return mix(spark, rows).select("doc_id", "size", "source_size", "target", "taken")


def mixed(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with their columns."""
    row = fresh_name(docs, "_row")
    kept = numbered(spark, docs, row)
    decided = mix(
        spark, kept.select(F.col(row).alias("row"), "doc_id", "source", word_count("text").alias("size"))
    )
    times = scratch(
        spark, decided.filter("copies > 0").select(F.col("row").alias(row), "copies"), "mix-copies"
    )
    copies = fresh_name(docs, "_copies")
    small = if_small(times.withColumnRenamed("copies", copies), times.count(), 16)
    return (
        kept.join(small, row)
        .withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies))))
        .select(*docs.columns)
    )


OP1_SQL = r"""
WITH sized AS (
    SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
    FROM documents
), sums AS (
    SELECT source, sum(size) AS source_size FROM sized GROUP BY source
), weighted AS (
    SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS INT)]
              AS weight
    FROM sums
), filled AS (
    SELECT *, (CAST((SELECT sum(size) FROM sized) AS DOUBLE)
               - CAST(coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight,
                               source IS NULL, source
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
              / CAST(sum(weight) OVER (ORDER BY 3 * source_size / weight, source IS NULL, source
                     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
    FROM weighted
), targets AS (
    SELECT source, source_size,
           least(CAST(3 * source_size AS DOUBLE), max(level) OVER () * weight) AS target
    FROM filled
), placed AS (
    SELECT doc_id, s.source, size, place, source_size, target,
           sum(size) OVER (PARTITION BY s.source ORDER BY place, doc_id, size
                           ROWS UNBOUNDED PRECEDING) AS upto
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), copies AS (
    SELECT *, CAST(epoch * source_size + upto AS DOUBLE) / target AS finish
    FROM placed, (VALUES (0), (1), (2)) AS e(epoch) WHERE size > 0
), running AS (
    SELECT *, sum(size) OVER (ORDER BY finish, place, doc_id, size, epoch) AS used FROM copies
), taken AS (
    SELECT doc_id, source, size, upto, count(*) AS copies
    FROM running WHERE used <= (SELECT sum(size) FROM sized) GROUP BY ALL
)
SELECT p.doc_id, p.size, CAST(p.source_size AS BIGINT) AS source_size, p.target,
       CAST(p.size * coalesce(t.copies, 0) AS BIGINT) AS taken
FROM placed p LEFT JOIN taken t
     ON p.doc_id IS NOT DISTINCT FROM t.doc_id AND p.source IS NOT DISTINCT FROM t.source
        AND p.size = t.size AND p.upto = t.upto
"""
