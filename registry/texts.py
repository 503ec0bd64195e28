"""Pages to text, text to chunks, and retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import inputs as I
from registry.core import ORACLES, query
from registry.marts import LIVE_SQL, live_section
from strandline.functions import text as T
from strandline.functions import vector
from strandline.operators import answers, chunks, retrieval, trained
from strandline.session import shared_dir
from strandline.sources.tables import spread

# The white space the operators know, spelled out for an engine without (?U).
_SPACE = (
    r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def _sql_text(html: str) -> str:
    text = (
        f"regexp_replace(regexp_replace({html}, "
        r"'(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]+>', ' ', 'g')"
    )
    for entity, plain in T.ENTITIES:
        text = f"replace({text}, '{entity}', '{plain.replace(chr(39), chr(39) * 2)}')"
    return f"trim(regexp_replace({text}, '{_SPACE}', ' ', 'g'), ' ')"


def page_texts(spark, sf):
    pages = spread(I.table(spark, sf, "pages").select("page_id", "url", "html"))
    return chunks.page_text(pages)


def documents(spark, sf):
    return spread(I.table(spark, sf, "documents").select("doc_id", "lang", "source", "text"))


@query("html_to_text", f"SELECT page_id, url, {_sql_text('html')} AS text FROM pages")
def html_to_text(spark, sf):
    return page_texts(spark, sf)


# Anchors for three languages; the fourth has none, and one lacks its end.
_ANCHORS = (("en", "the ", " and "), ("fr", "le ", " que "), ("de", "der ", None))


def _anchor_sql() -> str:
    rows = ", ".join(
        f"('{lang}', '{start}', {'NULL' if end is None else repr(end)})" for lang, start, end in _ANCHORS
    )
    return f"(VALUES {rows}) anchors(lang, start_anchor, end_anchor)"


def _anchors(spark):
    return spark.createDataFrame(list(_ANCHORS), "lang string, start_anchor string, end_anchor string")


_PLACED = f"""placed AS (
        SELECT doc_id, lang, text, coalesce(start_anchor, '') AS s, coalesce(end_anchor, '') AS e,
               CASE WHEN start_anchor IS NULL THEN 1 ELSE strpos(text, start_anchor) END AS p
        FROM documents LEFT JOIN {_anchor_sql()} USING (lang)),
    ended AS (
        SELECT *, CASE WHEN e = '' OR p = 0 THEN 0 ELSE strpos(substr(text, p), e) END AS q FROM placed)"""


@query(
    "extract_between_anchors",
    f"""WITH {_PLACED}
    SELECT doc_id, lang, CASE WHEN p = 0 THEN text
        WHEN q = 0 THEN substr(text, p) ELSE substr(text, p, q - 1) END AS text
    FROM ended""",
)
def extract_between_anchors(spark, sf):
    found = chunks.main_content(documents(spark, sf), _anchors(spark), source="lang")
    return found.select("doc_id", "lang", "text")


@query(
    "extract_between_anchors_limited",
    f"""WITH {_PLACED}
    SELECT doc_id, lang, CASE WHEN p = 0 THEN substr(text, 1, 8000)
        WHEN q = 0 THEN substr(text, p, 8000) ELSE substr(text, p, q - 1) END AS text
    FROM ended""",
)
def extract_between_anchors_limited(spark, sf):
    """The same with the source system's length for text whose extent is unknown."""
    found = chunks.main_content(
        documents(spark, sf), _anchors(spark), source="lang", unanchored_chars=T.UNANCHORED_CHARS
    )
    return found.select("doc_id", "lang", "text")


_CHUNKS = f"""tokens AS (
    SELECT doc_id, lang, source,
           list_filter(regexp_split_to_array(text, '{_SPACE}'), lambda w: w <> '') AS words
    FROM documents),
windows AS (
    SELECT doc_id, lang, source, start, array_to_string(words[start:start + 399], ' ') AS text
    FROM (SELECT *, unnest(generate_series(1, len(words), 320)) AS start FROM tokens)),
chunks AS (
    SELECT doc_id, lang, source, text,
           CAST(row_number() OVER (PARTITION BY doc_id ORDER BY start) - 1 AS INTEGER) AS chunk_index,
           CAST(count(*) OVER (PARTITION BY doc_id) AS INTEGER) AS total_chunks
    FROM windows WHERE length(text) > 100)"""


@query(
    "chunk_overlap",
    f"WITH {_CHUNKS} SELECT doc_id AS source_id, chunk_index, text FROM chunks",
)
def chunk_overlap(spark, sf):
    made = chunks.chunk_documents(documents(spark, sf), "doc_id")
    return made.select("source_id", "chunk_index", "text")


@query(
    "chunk_metadata",
    f"""WITH {_CHUNKS} SELECT doc_id || '_chunk_' || chunk_index AS id, doc_id AS source_id, lang,
        source, chunk_index, total_chunks, length(text) AS n_chars FROM chunks""",
)
def chunk_metadata(spark, sf):
    made = chunks.chunk_documents(documents(spark, sf), "doc_id", metadata=["lang", "source"])
    return made.select(
        "id",
        "source_id",
        "lang",
        "source",
        "chunk_index",
        "total_chunks",
        F.length("text").cast("bigint").alias("n_chars"),
    )


@query(
    "page_chunks",
    f"""WITH texts AS (SELECT page_id, url, {_sql_text('html')} AS text FROM pages),
    tokens AS (SELECT *, list_filter(string_split(text, ' '), lambda w: w <> '') AS words FROM texts),
    windows AS (
        SELECT page_id, url, start, array_to_string(words[start:start + 399], ' ') AS text
        FROM (SELECT *, unnest(generate_series(1, len(words), 320)) AS start FROM tokens))
    SELECT page_id AS source_id, url, text,
           CAST(row_number() OVER (PARTITION BY page_id ORDER BY start) - 1 AS INTEGER) AS chunk_index,
           CAST(count(*) OVER (PARTITION BY page_id) AS INTEGER) AS total_chunks
    FROM windows WHERE length(text) > 100""",
)
def page_chunks(spark, sf):
    """Page to text to chunks in one go, without a shuffle after the read."""
    made = chunks.chunk_documents(page_texts(spark, sf), "page_id", metadata=["url"])
    return made.select("source_id", "url", "text", "chunk_index", "total_chunks")


# --- vectors ------------------------------------------------------------------------


def vectors(spark, sf):
    return I.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("vector_id"), F.col("embedding").alias("vector"), "label"
    )


def questions(spark, sf):
    """Every vector whose id is divisible by 100, as a question to all of them."""
    asked = I.table(spark, sf, "embeddings").where("vec_id % 100 = 0")
    return asked.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))


_NEAREST = """WITH questions AS (
    SELECT vec_id AS query_id, embedding AS vector FROM embeddings WHERE vec_id % 100 = 0),
scored AS (
    SELECT query_id, vec_id AS vector_id,
           round(1 - list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST(vector AS DOUBLE[])), 12)
               AS distance
    FROM embeddings, questions),
nearest AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vector_id) AS INTEGER)
        AS rank FROM scored)"""


@query(
    "knn_cosine",
    f"""{_NEAREST} SELECT query_id, vector_id, rank, round(1 - distance, 3) + 0.0 AS similarity
    FROM nearest WHERE rank <= 3""",
)
def knn_cosine(spark, sf):
    found = retrieval.knn_cosine(spread(vectors(spark, sf)), questions(spark, sf))
    return found.drop("distance")


# Small cells, so that the small tables have some to choose from.
_PER_CELL, _DIMENSIONS, _MOST_BITS = 32, 64, 16


def _index(spark, sf):
    return retrieval.index_rebuild(vectors(spark, sf), shared_dir(spark, "vector-index"), _DIMENSIONS, _PER_CELL)


def _approximate(spark, sf, probes=None):
    return retrieval.knn_approx(_index(spark, sf), questions(spark, sf), probes=probes)


# The planes are fixed values; a table uses the first of them, by its size, and asks as many
# cells as their number asks for.
_PROBES_BY_BITS = ", ".join(
    f"({bits}, {retrieval.probes_for(bits, _DIMENSIONS, _PER_CELL)})" for bits in range(1, _MOST_BITS + 1)
)
_PLANES = ", ".join(
    f"({bit}, {plane!r})" for bit, plane in enumerate(retrieval.hyperplanes(_DIMENSIONS, _MOST_BITS).tolist())
)
_APPROXIMATE = f"""{_NEAREST},
size AS (SELECT greatest(1, CAST(ceil(log2(count(*) / {_PER_CELL}.0)) AS INTEGER)) AS bits FROM embeddings),
planes AS (SELECT bit, CAST(plane AS DOUBLE[]) AS plane FROM (VALUES {_PLANES}) p(bit, plane), size
           WHERE bit < bits),
cells AS (
    SELECT vec_id AS vector_id,
           sum(CASE WHEN list_dot_product(CAST(embedding AS DOUBLE[]), plane) > 0 THEN 1 << bit ELSE 0 END)
               AS cell
    FROM embeddings, planes GROUP BY vec_id),
margins AS (
    SELECT query_id, bit, list_dot_product(CAST(vector AS DOUBLE[]), plane)
        / sqrt(list_dot_product(CAST(vector AS DOUBLE[]), CAST(vector AS DOUBLE[]))) AS margin
    FROM questions, planes),
costs AS (
    SELECT query_id, c.cell, round(sum(CASE WHEN ((c.cell >> bit) & 1 = 1) <> (margin > 0)
                                       THEN margin * margin ELSE 0 END), 12) AS cost
    FROM margins, (SELECT unnest(range(1 << bits)) AS cell FROM size) c GROUP BY query_id, c.cell),
probed AS (
    SELECT query_id, cell FROM costs
    QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY cost, cell)
        <= (SELECT probes FROM (VALUES {_PROBES_BY_BITS}) b(bits, probes) JOIN size USING (bits))),
approximate AS (
    SELECT s.query_id, s.vector_id, distance,
           CAST(row_number() OVER (PARTITION BY s.query_id ORDER BY distance, s.vector_id) AS INTEGER) AS rank
    FROM scored s JOIN cells c ON s.vector_id = c.vector_id
    JOIN probed p ON s.query_id = p.query_id AND c.cell = p.cell)"""


@query(
    "index_rebuild",
    "SELECT count(*) AS vectors, count(DISTINCT vec_id) AS distinct_ids FROM embeddings",
)
def index_rebuild(spark, sf):
    return _index(spark, sf).rows.agg(
        F.count("*").alias("vectors"), F.count_distinct("vector_id").alias("distinct_ids")
    )


@query(
    "knn_approx",
    f"""{_APPROXIMATE} SELECT query_id, vector_id, rank, round(1 - distance, 3) + 0.0 AS similarity
    FROM approximate WHERE rank <= 3""",
)
def knn_approx(spark, sf):
    return _approximate(spark, sf).drop("distance")


@query(
    "knn_approx_all_cells",
    f"""{_NEAREST} SELECT query_id, vector_id, rank, round(1 - distance, 3) + 0.0 AS similarity
    FROM nearest WHERE rank <= 3""",
)
def knn_approx_all_cells(spark, sf):
    """With every cell probed the approximate search is the exact one."""
    return _approximate(spark, sf, "all").drop("distance")


@query(
    "knn_approx_recall",
    f"""{_APPROXIMATE} SELECT count(*) AS neighbours, count(a.vector_id) AS found,
        count(a.vector_id) / CAST(count(*) AS DOUBLE) AS recall
    FROM (SELECT * FROM nearest WHERE rank <= 3) n
    LEFT JOIN (SELECT * FROM approximate WHERE rank <= 3) a
         ON n.query_id = a.query_id AND n.vector_id = a.vector_id""",
)
def knn_approx_recall(spark, sf):
    exact = retrieval.knn_cosine(vectors(spark, sf), questions(spark, sf))
    return retrieval.recall(_approximate(spark, sf), exact)


def _grown(spark, sf):
    """An index built from the even ids, with the others added to its cells."""
    path, every = shared_dir(spark, "grown-index"), vectors(spark, sf)
    retrieval.index_rebuild(every.where("vector_id % 2 = 0"), path, _DIMENSIONS, _PER_CELL)
    retrieval.index_add(path, every.where("vector_id % 2 <> 0"))
    return retrieval.open_index(spark, path)


@query(
    "knn_approx_grown",
    f"""{_NEAREST} SELECT query_id, vector_id, rank, round(1 - distance, 3) + 0.0 AS similarity
    FROM nearest WHERE rank <= 3""",
)
def knn_approx_grown(spark, sf):
    """An index that rows were added to is searched by the planes it was built with."""
    found = retrieval.knn_approx(_grown(spark, sf), questions(spark, sf), probes="all")
    return found.drop("distance")


def _trained(spark, sf):
    return trained.build(spread(vectors(spark, sf)), shared_dir(spark, "trained-index"), _PER_CELL)


@query("knn_trained")
def knn_trained(spark, sf):
    """Trained cells, codes and candidates; no SQL, as the cells come out of training."""
    return trained.search(_trained(spark, sf), questions(spark, sf)).drop("distance")


@query(
    "knn_trained_recall",
    f"{_NEAREST} SELECT count(*) AS neighbours, TRUE AS enough FROM nearest WHERE rank <= 3",
)
def knn_trained_recall(spark, sf):
    """At least 0.9 of the exact neighbours are found."""
    exact = retrieval.knn_cosine(spread(vectors(spark, sf)), questions(spark, sf))
    found = retrieval.recall(knn_trained(spark, sf), exact)
    return found.select("neighbours", (F.col("recall") >= 0.9).alias("enough"))


@query(
    "trained_index",
    "SELECT count(*) AS vectors, count(DISTINCT vec_id) AS distinct_ids, CAST(sum(vec_id) AS BIGINT) AS ids FROM embeddings",
)
def trained_index(spark, sf):
    """Every vector lies in one trained cell, with its code."""
    rows = _trained(spark, sf).rows.where("octet_length(code) = 16")
    return rows.agg(
        F.count("*").alias("vectors"), F.count_distinct("vector_id").alias("distinct_ids"), F.sum("vector_id").alias("ids")
    )


# The name these had while others asked a fixed number of cells.
@query("knn_approx_sized", ORACLES["knn_approx"])
def knn_approx_sized(spark, sf):
    return knn_approx(spark, sf)


@query("knn_approx_sized_recall", ORACLES["knn_approx_recall"])
def knn_approx_sized_recall(spark, sf):
    return knn_approx_recall(spark, sf)


@query(
    "retrieve_chunks",
    f"""{_NEAREST} SELECT query_id, rank, round(1 - distance, 3) + 0.0 AS similarity, doc_id AS chunk_id,
        text, source, 'Document ' || doc_id AS title, url, DATE '2025-01-01' + CAST(doc_id % 365 AS INTEGER)
        AS date
    FROM nearest JOIN documents ON vector_id = doc_id LEFT JOIN pages ON page_id = doc_id WHERE rank <= 3""",
)
def retrieve_chunks(spark, sf):
    """The neighbours of each question, joined to the texts they stand for."""
    pages = I.table(spark, sf, "pages").select(F.col("page_id").alias("chunk_id"), "url")
    texts = I.table(spark, sf, "documents").select(
        F.col("doc_id").alias("chunk_id"),
        "text",
        "source",
        F.concat(F.lit("Document "), "doc_id").alias("title"),
        F.date_add(F.expr("DATE '2025-01-01'"), (F.col("doc_id") % 365).cast("int")).alias("date"),
    )
    found = retrieval.knn_cosine(spread(vectors(spark, sf)), questions(spark, sf))
    return retrieval.retrieve_chunks(found, texts.join(pages, "chunk_id", "left"), "chunk_id").drop("distance")


@query(
    "similarity_round",
    """WITH questions AS (
        SELECT label, arg_min(embedding, vec_id) AS vector FROM embeddings GROUP BY label)
    SELECT vec_id AS vector_id, e.label, round(1 - round(
        1 - list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST(vector AS DOUBLE[])), 12), 3)
        + 0.0 AS similarity
    FROM embeddings e JOIN questions q ON e.label = q.label""",
)
def similarity_round(spark, sf):
    """Every vector against its own label's first."""
    asked = vectors(spark, sf).groupBy("label").agg(F.min_by("vector", "vector_id").alias("question"))
    distance = F.round(vector.cosine_distance(F.col("vector"), F.col("question")), 12)
    return (
        vectors(spark, sf)
        .join(asked, "label")
        .select("vector_id", "label", retrieval.similarity(distance).alias("similarity"))
    )


# --- answers --------------------------------------------------------------------------

# A conversation stands for a question: its turns are ranked chunks, the role
# is the source, and the length of the text gives a score.
_TURNS = """turns AS (
    SELECT conv_id AS question_id, CAST(turn + 1 AS INTEGER) AS rank, role AS source, text,
           DATE '2025-01-01' + CAST(turn AS INTEGER) AS date,
           CAST(length(text) AS DECIMAL(12,0)) * 0.012345 AS entailment
    FROM conversations)"""


def turns(spark, sf):
    return I.table(spark, sf, "conversations").select(
        F.col("conv_id").alias("question_id"),
        (F.col("turn") + 1).cast("int").alias("rank"),
        F.col("role").alias("source"),
        "text",
        F.date_add(F.expr("DATE '2025-01-01'"), F.col("turn").cast("int")).alias("date"),
        (F.length("text").cast("decimal(12,0)") * F.expr("0.012345BD")).alias("entailment"),
    )


@query(
    "faithfulness_gate",
    f"""WITH {_TURNS} SELECT question_id,
        CAST(round(max(entailment), 4) AS DECIMAL(18,4)) AS max_entailment_score,
        arg_max(source, entailment * 1000000000 - rank) AS best_supporting_chunk,
        max(entailment) < 2.0 AS flagged,
        string_agg(CAST(CAST(round(entailment, 4) AS DECIMAL(18,4)) AS VARCHAR), ' ' ORDER BY rank)
            AS all_scores
    FROM turns GROUP BY question_id""",
)
def faithfulness_gate(spark, sf):
    gated = answers.faithfulness_gate(turns(spark, sf), all_scores=True)
    scores = F.transform("all_scores", lambda score: score.cast("decimal(18,4)").cast("string"))
    return gated.withColumns(
        {
            "max_entailment_score": F.col("max_entailment_score").cast("decimal(18,4)"),
            "all_scores": F.array_join(scores, " "),
        }
    )


@query(
    "answer_scores",
    f"""WITH {_TURNS} SELECT question_id, rank,
        CAST(round(entailment, 4) AS DECIMAL(18,4)) AS score FROM turns""",
)
def answer_scores(spark, sf):
    scores = answers.answer_scores(turns(spark, sf))
    return scores.withColumn("score", F.col("score").cast("decimal(18,4)"))


@query(
    "context_rows",
    f"""WITH {_TURNS} SELECT question_id, rank,
        '[Source ' || rank || ': ' || source || ', ' || date || ']' || chr(10) || text AS block
    FROM turns""",
)
def context_rows(spark, sf):
    return answers.context_rows(turns(spark, sf))


@query(
    "context_assembly",
    f"""WITH {_TURNS} SELECT question_id, string_agg(
        '[Source ' || rank || ': ' || source || ', ' || date || ']' || chr(10) || text,
        chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS context
    FROM turns GROUP BY question_id""",
)
def context_assembly(spark, sf):
    return answers.context_assembly(turns(spark, sf))


@query(
    "prompt_with_live_data",
    f"""WITH {LIVE_SQL}, {_TURNS}, contexts AS (
        SELECT question_id, string_agg(
            '[Source ' || rank || ': ' || source || ', ' || date || ']' || chr(10) || text,
            chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS context,
            count(*) AS turn_count
        FROM turns GROUP BY question_id)
    SELECT question_id, 'Use the context.' || chr(10) || chr(10)
        || 'REGULATORY CONTEXT (retrieved from public sources):' || chr(10) || context || chr(10)
        || CASE WHEN question_id % 2 = 0
                THEN chr(10) || 'LIVE PIPELINE DATA:' || chr(10) || (SELECT live_data FROM live) || chr(10)
                ELSE '' END
        || chr(10) || 'QUESTION: q' || question_id || chr(10) || chr(10) || 'Name the sources.' AS prompt
    FROM contexts""",
)
def prompt_with_live_data(spark, sf):
    contexts = answers.context_assembly(turns(spark, sf))
    asked = contexts.withColumn("question", F.concat(F.lit("q"), F.col("question_id").cast("string")))
    # One text for all prompts, so it goes into the plan as a single value.
    live = F.when(F.col("question_id") % 2 == 0, live_section(spark, sf).scalar())
    prompts = answers.build_prompt(asked, "question", "Use the context.", "Name the sources.", live)
    return prompts.select("question_id", "prompt")


@query(
    "sources_distinct_ordered",
    f"""WITH {_TURNS} SELECT question_id, source, min(rank) AS first_rank FROM turns
    GROUP BY question_id, source ORDER BY question_id, first_rank""",
)
def sources_distinct_ordered(spark, sf):
    used = answers.sources_used(turns(spark, sf), ["question_id"], url="source")
    return used.orderBy("question_id", "first_rank")
