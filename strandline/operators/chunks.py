"""From web pages to chunks ready for embedding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions import text as T


def page_text(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    return pages.withColumn(out, T.html_to_text(F.col(html))).drop(html)


def main_content(
    pages: DataFrame,
    anchors: DataFrame,
    source: str = "source_id",
    text: str = "text",
    unanchored_chars: int | None = None,
) -> DataFrame:
    """Cut each text to the part between its source's anchors.

    ``anchors`` has ``source``, ``start_anchor`` and ``end_anchor``, one row
    per source. The join is left to the planner: a short list is broadcast by
    its size, a long one is shuffled, and a crowded source is split by the
    adaptive skew join.
    """
    content = T.between_anchors(
        F.col(text), F.col("start_anchor"), F.col("end_anchor"), unanchored_chars
    )
    return (
        pages.join(anchors.select(source, "start_anchor", "end_anchor"), source, "left")
        .withColumn(text, content)
        .drop("start_anchor", "end_anchor")
    )


def chunk_documents(
    documents: DataFrame,
    source_id: str,
    text: str = "text",
    metadata: Sequence[str] = (),
    size: int = T.CHUNK_WORDS,
    overlap: int = T.CHUNK_OVERLAP_WORDS,
    min_chars: int = T.MIN_CHUNK_CHARS,
) -> DataFrame:
    """One row per chunk with its id, position, total and the document's metadata.

    Positions and totals count kept chunks only. Both come from the document's
    own array, so there is neither a shuffle nor a window.
    """
    chunks = documents.select(
        F.col(source_id).alias("source_id"),
        *metadata,
        T.overlapping_chunks(F.col(text), size, overlap, min_chars).alias("chunks"),
    )
    # The outer form, as the plain one would have the planner cut the text up
    # twice: once more to filter out documents without chunks before the explode.
    numbered = chunks.select(
        "source_id",
        *metadata,
        F.size("chunks").alias("total_chunks"),
        F.posexplode_outer("chunks").alias("chunk_index", "text"),
    ).where(F.col("chunk_index").isNotNull())
    return numbered.select(
        F.format_string("%s_chunk_%d", F.col("source_id").cast("string"), "chunk_index").alias("id"),
        "text",
        "source_id",
        *metadata,
        "chunk_index",
        "total_chunks",
    )
