"""Text preparation as column expressions; every one works on whole texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as markup, the entities decoded (in this order, so
# that "&amp;lt;" ends as "<"), and the chunk geometry.
SCRIPT_OR_STYLE_BLOCK = r"(?is)<(script|style)[^>]*>.*?</(script|style)>"
TAG = r"<[^>]+>"
ENTITIES = (
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&nbsp;", " "),
    ("&#x27;", "'"),
    ("&quot;", '"'),
    ("&#8220;", '"'),
    ("&#8221;", '"'),
    ("&#8216;", "'"),
    ("&#8217;", "'"),
)
# Unicode white space, and the four information separators Java leaves out.
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"
CHUNK_WORDS = 400
CHUNK_OVERLAP_WORDS = 80
MIN_CHUNK_CHARS = 100
# What a caller may give as the length of text whose extent is unknown.
UNANCHORED_CHARS = 8000


def collapse_whitespace(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, WHITESPACE_RUN, " "))


def html_to_text(html: Column) -> Column:
    text = F.regexp_replace(html, SCRIPT_OR_STYLE_BLOCK, " ")
    text = F.regexp_replace(text, TAG, " ")
    for entity, plain in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return collapse_whitespace(text)


def between_anchors(
    text: Column, start_anchor: Column, end_anchor: Column, unanchored_chars: int | None = None
) -> Column:
    """The part of ``text`` from one anchor up to the next occurrence of another.

    An absent (NULL) start anchor means the beginning of the text. Where an
    anchor is not found the extent is unknown: the text to its end is taken, or
    the first ``unanchored_chars`` of it if given. A found pair of anchors may be
    any distance apart.
    """
    limit = F.length(text) if unanchored_chars is None else F.lit(unanchored_chars)
    given_start = F.coalesce(start_anchor, F.lit(""))
    given_end = F.coalesce(end_anchor, F.lit(""))
    start = F.when(given_start == "", F.lit(1)).otherwise(F.position(given_start, text))  # 0: missing
    end = F.when(given_end == "", F.lit(0)).otherwise(F.position(given_end, text, start))
    return (
        F.when(start == 0, F.substring(text, F.lit(1), limit))
        .when(end == 0, F.substring(text, start, limit))
        .otherwise(F.substring(text, start, end - start))
    )


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, WHITESPACE_RUN), "")


def overlapping_chunks(
    text: Column,
    size: int = CHUNK_WORDS,
    overlap: int = CHUNK_OVERLAP_WORDS,
    min_chars: int = MIN_CHUNK_CHARS,
) -> Column:
    """All windows of ``size`` words, each starting ``size - overlap`` after the last.

    Windows of at most ``min_chars`` characters are left out. A tail that lies
    inside the previous overlap is a window of its own.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and less than size")
    step = size - overlap

    def windows(tokens: Column) -> Column:
        starts = F.when(F.size(tokens) > 0, F.sequence(F.lit(1), F.size(tokens), F.lit(step)))
        chunks = F.transform(starts, lambda at: F.array_join(F.slice(tokens, at, size), " "))
        return F.filter(chunks, lambda chunk: F.length(chunk) > min_chars)

    # Binding the words to a lambda variable splits the text once, not once per window.
    chunks = F.transform(F.array(words(text)), windows)[0]
    return F.coalesce(chunks, F.array().cast("array<string>"))
