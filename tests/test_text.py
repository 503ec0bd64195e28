import re

import pytest
from pyspark.sql import functions as F

from strandline.functions import text as T
from strandline.operators import answers, chunks


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<p>a</p><p>b</p>", "a b"),
        ("x<script>var t='</p><b>';</script>y", "x y"),
        ("x<STYLE type='a'>p{}\n</STYLE>y", "x y"),
        ("a &amp;lt; b", "a < b"),
        ("&amp;nbsp;x&nbsp;y", "x y"),
        ("&lt;b&gt; &#x27;q&#x27; &quot;w&quot;", "<b> 'q' \"w\""),
        ("&#8220;a&#8221; &#8216;b&#8217;", "\"a\" 'b'"),
        ("a <b unclosed", "a <b unclosed"),
        (" \t a\x0b\x1cb 　c \n", "a b c"),
        ("", ""),
    ],
)
def test_html_to_text(spark, html, expected):
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(T.html_to_text(F.col("html"))).first()[0] == expected


@pytest.mark.parametrize(
    "text, start, end, expected",
    [
        ("..S mid E..", "S", "E", "S mid "),
        ("E..S mid E", "S", "E", "S mid "),  # the next end, not the first
        ("no anchors " * 3, "S", "E", "no anchors no anch"),
        ("..S to the end of it all", "S", "E", "S to the end of it"),
        ("unknown source, no anchors", None, None, "unknown source, no"),
        ("S" + "x" * 50 + "E", "S", "E", "S" + "x" * 50),  # found ones may be far apart
    ],
)
def test_between_anchors(spark, text, start, end, expected):
    df = spark.createDataFrame([(text, start, end)], "t string, s string, e string")
    column = T.between_anchors(F.col("t"), F.col("s"), F.col("e"), unanchored_chars=18)
    assert df.select(column).first()[0] == expected


def expected_chunks(text, size=400, overlap=80, least=100):
    words = [w for w in re.split(r"\s+", text) if w]
    made = [" ".join(words[i : i + size]) for i in range(0, len(words), size - overlap)]
    return [c for c in made if len(c) > least]


@pytest.mark.parametrize("count", [0, 1, 320, 321, 400, 401, 720, 721, 2000])
def test_chunk_boundaries(spark, count):
    text = " ".join(f"word{i}" for i in range(count))
    df = spark.createDataFrame([(5, text, "u")], "id long, text string, url string")
    rows = chunks.chunk_documents(df, "id", metadata=["url"]).orderBy("chunk_index").collect()
    want = expected_chunks(text)
    assert [r.text for r in rows] == want
    assert [r.id for r in rows] == [f"5_chunk_{i}" for i in range(len(want))]
    assert all(r.total_chunks == len(want) and r.url == "u" for r in rows)


@pytest.mark.parametrize("length, kept", [(100, 0), (101, 1)])
def test_short_chunks_are_left_out(spark, length, kept):
    df = spark.createDataFrame([(1, "x" * length)], "id long, text string")
    assert chunks.chunk_documents(df, "id").count() == kept


def test_positions_count_kept_chunks_only(spark):
    # The middle window is short words only, so it is too short to keep.
    words = ["long" * 10] * 4 + ["a"] * 4 + ["wide" * 10] * 4
    df = spark.createDataFrame([(1, " ".join(words))], "id long, text string")
    rows = chunks.chunk_documents(df, "id", size=4, overlap=0).orderBy("chunk_index").collect()
    assert [(r.chunk_index, r.total_chunks) for r in rows] == [(0, 2), (1, 2)]
    assert rows[1].text.startswith("wide")


def test_main_content_per_source(spark):
    pages = spark.createDataFrame(
        [("a", "xx START body END yy"), ("b", "whole text")], "source_id string, text string"
    )
    anchors = spark.createDataFrame(
        [("a", "START", "END")], "source_id string, start_anchor string, end_anchor string"
    )
    got = {r.source_id: r.text for r in chunks.main_content(pages, anchors).collect()}
    assert got == {"a": "START body ", "b": "whole text"}


# --- around an answer --------------------------------------------------------------


def scored(spark, rows):
    return spark.createDataFrame(
        rows, "question_id long, rank int, source string, entailment double"
    )


def test_gate_takes_the_first_of_equals_and_the_threshold_itself(spark):
    df = scored(
        spark,
        [(1, 1, "a", 0.5), (1, 2, "b", 2.0), (1, 3, "c", 2.0), (2, 1, "x", 1.99999), (2, 2, "y", -3.0)],
    )
    rows = {r.question_id: r for r in answers.faithfulness_gate(df).collect()}
    assert (rows[1].best_supporting_chunk, rows[1].flagged) == ("b", False)
    listed = {r.question_id: r.all_scores for r in answers.faithfulness_gate(df, all_scores=True).collect()}
    assert listed[1] == [0.5, 2.0, 2.0]
    assert (rows[2].best_supporting_chunk, rows[2].flagged) == ("x", True)
    assert rows[2].max_entailment_score == 2.0  # rounded for display, judged unrounded


def test_gate_without_the_list_takes_any_number_of_chunks(spark):
    df = spark.range(1, 5001).selectExpr(
        "1 AS question_id", "CAST(id AS INT) AS rank", "CAST(id AS STRING) AS source",
        "CAST(id AS DOUBLE) / 1000 AS entailment",
    )
    row = answers.faithfulness_gate(df, all_scores=True).first()
    assert (row.best_supporting_chunk, row.flagged, len(row.all_scores)) == ("5000", False, 5000)
    assert answers.answer_scores(df).count() == 5000


def test_context_of_many_chunks(spark):
    df = spark.range(1, 1102).selectExpr(
        "id % 2 AS question_id", "CAST(id AS INT) AS rank", "'s' AS source", "'d' AS date", "'t' || id AS text"
    ).unionByName(spark.range(1, 1102).selectExpr(
        "2L AS question_id", "CAST(id AS INT) AS rank", "'s' AS source", "'d' AS date", "'t' || id AS text"))
    assert answers.context_rows(df).count() == 2202
    context = answers.context_assembly(df).where("question_id = 2").first().context
    assert context.count("[Source ") == 1101 and context.endswith("t1101")


def test_context_and_prompt(spark):
    df = spark.createDataFrame(
        [(1, 2, "B", "2025-02-02", "second"), (1, 1, "A", "2025-01-01", "first")],
        "question_id long, rank int, source string, date string, text string",
    )
    context = answers.context_assembly(df)
    expected = "[Source 1: A, 2025-01-01]\nfirst\n\n---\n\n[Source 2: B, 2025-02-02]\nsecond"
    assert context.first().context == expected
    asked = context.withColumn("question", F.lit("why?"))
    plain = answers.build_prompt(asked, "question", "Do.", "End.").first().prompt
    assert "LIVE PIPELINE DATA" not in plain and plain.endswith("QUESTION: why?\n\nEnd.")
    live = answers.build_prompt(asked, "question", "Do.", "End.", F.lit("rows")).first().prompt
    assert "\nLIVE PIPELINE DATA:\nrows\n" in live


def test_row_to_text(spark):
    df = spark.createDataFrame(
        [("F", "S", "AT_RISK", "1234567.5", "0", "9", "7", False)],
        "facility_name string, sector string, compliance_status string, total_subsidy_eur string, "
        "confirmed_investment_eur string, reinvestment_obligation_eur string, compliance_pct string, "
        "flexibility_bonus_eligible boolean",
    )
    money = ("total_subsidy_eur", "confirmed_investment_eur", "reinvestment_obligation_eur")
    for name in money:
        df = df.withColumn(name, F.col(name).cast("decimal(18,2)"))
    df = df.withColumn("compliance_pct", F.col("compliance_pct").cast("decimal(18,1)"))
    assert answers.row_to_text(df).first().line == (
        "  - F (S): status=AT_RISK, subsidy=EUR 1,234,567.50, invested=EUR 0.00, "
        "obligation=EUR 9.00, compliance=7.0%, flexibility_bonus_eligible=False"
    )


def test_live_section(spark):
    rows = [("b", 5, "line b"), ("a", 5, "line a"), ("c", 1, "line c")]
    df = spark.createDataFrame(rows, "facility_name string, compliance_pct int, line string")
    text = answers.live_section(df).first().live_data
    assert text.split("\n") == [answers.LINES_HEADING, "line c", "line a", "line b"]
    many = spark.range(5000).selectExpr(
        "'f' || id AS facility_name", "CAST(id AS INT) AS compliance_pct", "'line ' || id AS line"
    )
    lines = answers.live_section(many).first().live_data.split("\n")
    assert lines[1:] == [f"line {i}" for i in range(5000)]


def test_sources_in_first_seen_order(spark):
    df = spark.createDataFrame([("u2", 1), ("u1", 2), ("u2", 3)], "url string, rank int")
    rows = answers.sources_used(df).orderBy("first_rank").collect()
    assert [(r.url, r.first_rank) for r in rows] == [("u2", 1), ("u1", 2)]
