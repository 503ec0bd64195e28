import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.operators import retrieval, trained


def frame(spark, matrix, name="vector_id"):
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{name} long, vector array<float>")


def by_100(table):
    return table.where("vector_id % 100 = 0").select(F.col("vector_id").alias("query_id"), "vector")


def clustered(n, dimensions=64):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((40, dimensions))
    return centres[rng.integers(0, 40, n)] + 0.4 * rng.standard_normal((n, dimensions))


def random(n, dimensions=64):
    return np.random.default_rng(6).standard_normal((n, dimensions))


def rows_of(df):
    return sorted((r.query_id, r["rank"], r.vector_id, r.similarity) for r in df.collect())


@pytest.mark.parametrize("make", [clustered, random])
def test_recall_on_ids_by_100(spark, tmp_path, make):
    table = frame(spark, make(6_000)).repartition(6)
    index = trained.build(table, str(tmp_path / "index"), per_cell=100)
    assert index.cells == 60 and index.rows.count() == 6_000
    exact = retrieval.knn_cosine(table, by_100(table))
    assert retrieval.recall(trained.search(index, by_100(table)), exact).first().recall >= 0.9
    assert index.candidates < 600
    if make is clustered:
        assert index.probes < 20


def test_all_cells_and_candidates_are_exact(spark, tmp_path, monkeypatch):
    vectors = random(700, 16)
    vectors[200:450] = vectors[7]  # a third are copies of one vector
    vectors[3] = 0
    table = frame(spark, vectors)
    index = trained.build(table, str(tmp_path / "index"), per_cell=50)
    asked = by_100(table)
    want = rows_of(retrieval.knn_cosine(table, asked))
    every = {"probes": index.cells, "candidates": 700}
    assert rows_of(trained.search(index, asked, **every)) == want
    monkeypatch.setattr(retrieval, "QUESTIONS_PER_GROUP", 3)
    monkeypatch.setattr(retrieval, "VECTORS_PER_GROUP", 100)
    assert rows_of(trained.search(index, asked, **every)) == want


def test_ties_go_to_the_smaller_id(spark, tmp_path):
    vectors = np.repeat(random(3, 8), 50, axis=0)
    index = trained.build(frame(spark, vectors), str(tmp_path / "index"), per_cell=50)
    found = rows_of(trained.search(index, by_100(frame(spark, vectors))))
    assert [(q, v) for q, _, v, _ in found] == [(0, 0), (0, 1), (0, 2), (100, 100), (100, 101), (100, 102)]


def test_what_is_no_vector_is_left_out(spark, tmp_path):
    good = [(i, [float(x) for x in row]) for i, row in enumerate(random(40, 8))]
    odd = [(50, None), (51, [None] + [1.0] * 7), (52, [float("nan")] + [1.0] * 7), (53, [float("inf")] * 8), (54, [])]
    table = spark.createDataFrame(good + odd, "vector_id long, vector array<float>")
    index = trained.build(table, str(tmp_path / "index"), per_cell=20)
    assert index.rows.count() == 40
    asked = table.select(F.col("vector_id").alias("query_id"), "vector")
    assert trained.search(index, asked).select("query_id").distinct().count() == 40
    assert trained.search(index, asked.where("false")).count() == 0
    with pytest.raises(ValueError):
        trained.build(table.where("vector_id >= 50"), str(tmp_path / "none"))


def test_training_is_bounded_and_the_index_is_not(spark, tmp_path):
    table = frame(spark, clustered(4_000, 16))
    index = trained.build(table, str(tmp_path / "index"), per_cell=20, sample=640)
    assert index.cells == 40 and index.rows.count() == 4_000
    exact = retrieval.knn_cosine(table, by_100(table))
    assert retrieval.recall(trained.search(index, by_100(table)), exact).first().recall >= 0.9


def test_added_vectors_are_found_and_measured_again(spark, tmp_path):
    table, path = frame(spark, clustered(3_000, 16)), str(tmp_path / "index")
    first = trained.build(table.where("vector_id < 1500"), path, per_cell=50)
    trained.add(spark, path, table.where("vector_id >= 1500"))
    sample = table.where("vector_id % 20 = 0")
    index = trained.measure(spark, path, sample)
    assert index.rows.count() == 3_000 and index.cells == first.cells
    assert (trained.open_index(spark, path).probes, trained.open_index(spark, path).candidates) == (
        index.probes,
        index.candidates,
    )
    exact = retrieval.knn_cosine(table, by_100(table))
    assert retrieval.recall(trained.search(index, by_100(table)), exact).first().recall >= 0.9


def test_codes_are_scanned_without_vectors(spark, tmp_path):
    table = frame(spark, clustered(600, 16))
    index = trained.build(table, str(tmp_path / "index"), per_cell=50)
    plan = trained.search(index, by_100(table))._jdf.queryExecution().optimizedPlan().toString()
    assert "CartesianProduct" not in plan and "Join Inner," in plan
    executed = trained.search(index, by_100(table))._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in executed.splitlines() if "ReadSchema" in line and "code:binary" in line]
    assert scans and all("vector:array" not in line for line in scans)
