import os
import sys

import duckdb
import pytest
from conftest import words_of

from strandline.llm import mixing

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from compare import normal_rows, run_sql  # noqa: E402


def filled(sizes, budget):
    """Targets by giving the excess of capped sources to the others, again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    capped, left = set(), budget
    while True:
        free = [s for s in order if s not in capped]
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > 3 * sizes[s] + 1e-9]
        if not over:
            return {s: 3 * sizes[s] if s in capped else left * weight[s] / total for s in order}
        for s in over:
            capped.add(s)
            left -= 3 * sizes[s]


def test_targets_and_taken(spark, odd, odd_rows, folder):
    where = folder(documents=odd)
    got = [r.asDict() for r in mixing.op1(spark, where).collect()]
    assert len(got) == len(odd_rows)
    sizes = {}
    for _, text, _, source, _ in odd_rows:
        sizes[source] = sizes.get(source, 0) + len(words_of(text))
    want = filled(sizes, sum(sizes.values()))
    by_id = {}
    for doc_id, text, _, source, _ in odd_rows:
        by_id.setdefault(doc_id, []).append((len(words_of(text)), sizes[source], want[source]))
    for row in got:
        assert any(
            row["size"] == s and row["source_size"] == z and row["target"] == pytest.approx(t)
            for s, z, t in by_id[row["doc_id"]]
        )
        assert row["taken"] in (0, row["size"], 2 * row["size"], 3 * row["size"])
    assert sum(r["taken"] for r in got) <= sum(sizes.values())

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{where}/documents.parquet/*.parquet'")
    columns, _, rows = run_sql(con, mixing.OP1_SQL)
    names = list(got[0])
    assert normal_rows(names, [tuple(r.values()) for r in got]) == normal_rows(columns, rows)


def test_a_source_near_its_target_when_rows_are_many(spark):
    rows = spark.range(6000).selectExpr(
        "id AS doc_id",
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN 'small' ELSE 'rest' END AS source",
        "CAST(1 + id % 11 AS long) AS size",
    )
    got = mixing.mix(spark, rows).groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    for r in got:
        assert abs(r["sum(taken)"] - r["max(target)"]) <= 30
    assert mixing.mix(spark, rows).exceptAll(mixing.mix(spark, rows)).count() == 0


def test_mixed_documents_keep_their_columns(spark, clashing):
    got = mixing.mixed(spark, clashing)
    assert got.schema == clashing.schema
    assert got.select("doc_id", "text").distinct().exceptAll(clashing.select("doc_id", "text").distinct()).count() == 0


def test_empty(spark, empty, folder):
    assert mixing.op1(spark, folder(documents=empty)).collect() == []
    assert mixing.mixed(spark, empty).collect() == []


def test_only_empty_texts(spark, folder):
    docs = spark.createDataFrame([(1, None, None, "a", 0), (2, "", None, None, 0)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(tuple(r) for r in mixing.op1(spark, folder(documents=docs)).collect()) == [
        (1, 0, 0, 0.0, 0),
        (2, 0, 0, 0.0, 0),
    ]
