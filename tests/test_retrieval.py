import numpy as np
import pytest

from strandline.operators import retrieval


def frame(spark, matrix, name):
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{name} long, vector array<float>")


def brute_force(vectors, questions, k):
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    distances = np.round(1 - unit(questions.astype(float)) @ unit(vectors.astype(float)).T, 12)
    found = {}
    for q, row in enumerate(distances):
        order = sorted(range(len(row)), key=lambda i: (row[i], i))[:k]
        found[q] = [(i, round(1 - row[i], 3)) for i in order]
    return found


def collected(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.vector_id, r.similarity))
    return found


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((700, 16)).astype(np.float32)
    vectors[200:450] = vectors[7]  # a third are copies of one vector
    vectors[3] = 0
    return vectors, np.vstack([vectors[:8], rng.standard_normal((4, 16))]).astype(np.float32)


def test_exact_search_against_brute_force(spark, data):
    vectors, questions = data
    questions = np.delete(questions, 3, axis=0)
    nonzero = np.where(np.linalg.norm(vectors, axis=1) > 0)[0]
    assert len(nonzero) == 699
    found = retrieval.knn_cosine(
        frame(spark, vectors, "vector_id").repartition(5), frame(spark, questions, "query_id"), 4
    )
    safe = vectors.astype(float)
    safe[3] = 1e-3  # stands for the zero vector, which is near nothing
    want = brute_force(safe, questions, 4)
    got = collected(found)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], atol=2e-3)


def test_crowded_sides_are_cut_into_groups(spark, data, monkeypatch):
    vectors, questions = data
    questions = np.delete(questions, 3, axis=0)
    table, asked = frame(spark, vectors, "vector_id"), frame(spark, questions, "query_id")
    whole = collected(retrieval.knn_cosine(table, asked))
    monkeypatch.setattr(retrieval, "QUESTIONS_PER_GROUP", 3)
    monkeypatch.setattr(retrieval, "VECTORS_PER_GROUP", 100)
    assert collected(retrieval.knn_cosine(table, asked)) == whole


def test_no_questions_no_neighbours(spark, data):
    table = frame(spark, data[0], "vector_id")
    asked = frame(spark, data[1], "query_id").where("false")
    assert retrieval.knn_cosine(table, asked).count() == 0


def test_index_holds_everything_and_all_probes_are_exact(spark, data, tmp_path):
    vectors, questions = data
    questions = np.delete(questions, 3, axis=0)
    table, asked = frame(spark, vectors, "vector_id"), frame(spark, questions, "query_id")
    index = retrieval.index_rebuild(table, str(tmp_path / "index"), 16, per_cell=100)
    assert index.rows.count() == 700 and retrieval.bits_for(700, 100) == 3
    exact = retrieval.knn_cosine(table, asked)
    every = retrieval.knn_approx(index, asked, probes="all")
    assert collected(every) == collected(exact)
    some = retrieval.knn_approx(index, asked, probes=5)
    share = retrieval.recall(some, exact).first().recall
    assert 0.5 <= share <= 1.0


def test_only_probed_cells_are_compared(spark, data, tmp_path):
    vectors, questions = data
    index = retrieval.index_rebuild(frame(spark, vectors, "vector_id"), str(tmp_path / "one"), 16, per_cell=100)
    asked = frame(spark, questions[:1], "query_id")
    found = retrieval.knn_approx(index, asked, k=700, probes=1)
    cells = {r.cell for r in found.join(index.rows, "vector_id").select("cell").distinct().collect()}
    assert len(cells) == 1
    cell = cells.pop()
    assert found.count() == index.rows.where(f"cell = {cell}").count()


def test_cells_double_with_the_collection():
    assert [retrieval.bits_for(n, 100) for n in (0, 100, 200, 201, 400, 10**6)] == [1, 1, 1, 2, 2, 14]


def test_chunks_come_with_their_neighbours(spark):
    found = spark.createDataFrame([(1, 7, 1, 0.9)], "query_id long, vector_id long, rank int, similarity double")
    chunks = spark.createDataFrame([(7, "t", "u"), (8, "x", "y")], "vector_id long, text string, url string")
    row = retrieval.retrieve_chunks(found, chunks).first()
    assert (row.query_id, row.rank, row.text, row.url) == (1, 1, "t", "u")


@pytest.mark.parametrize("n", [500, 6_000])
def test_recall_holds_as_cells_double(spark, tmp_path, n):
    rng = np.random.default_rng(11)
    vectors, questions = rng.standard_normal((n, 64)), rng.standard_normal((60, 64))
    table, asked = frame(spark, vectors, "vector_id"), frame(spark, questions, "query_id")
    index = retrieval.index_rebuild(table, str(tmp_path / "index"), 64, per_cell=32)
    found = retrieval.knn_approx(index, asked)
    assert retrieval.recall(found, retrieval.knn_cosine(table, asked)).first().recall >= 0.9
    bits = retrieval.bits_for(n, 32)
    assert retrieval.probes_for(bits, 64, 32) < 1 << bits


def test_a_table_is_searched_for_its_own_rows(spark, data, tmp_path):
    vectors = np.delete(data[0], 3, axis=0)
    table = frame(spark, vectors, "vector_id")
    own = table.where("vector_id % 100 = 0").select(table.vector_id.alias("query_id"), "vector")
    want = brute_force(vectors, vectors[::100], 3)
    got = collected(retrieval.knn_cosine(table, own))
    assert {q // 100: [i for i, _ in rows] for q, rows in got.items()} == {q: [i for i, _ in r] for q, r in want.items()}
    index = retrieval.index_rebuild(table, str(tmp_path / "own"), 16, per_cell=100)
    own = index.rows.where("vector_id % 100 = 0").select(index.rows.vector_id.alias("query_id"), "vector")
    assert collected(retrieval.knn_approx(index, own, probes="all")) == got


def test_an_index_keeps_its_planes(spark, tmp_path):
    rng = np.random.default_rng(12)
    vectors = rng.standard_normal((3000, 32))
    table, path = frame(spark, vectors, "vector_id"), str(tmp_path / "index")
    assert retrieval.index_rebuild(table.where("vector_id < 1000"), path, 32, per_cell=50).cells == 32
    retrieval.index_add(path, table.where("vector_id >= 1000"))
    index = retrieval.open_index(spark, path)
    assert index.cells == 32 and index.rows.count() == 3000
    own = table.where("vector_id % 100 = 0").select(table.vector_id.alias("query_id"), "vector")
    exact = retrieval.knn_cosine(table, own)
    assert retrieval.recall(retrieval.knn_approx(index, own), exact).first().recall >= 0.9
    assert collected(retrieval.knn_approx(index, own, probes="all")) == collected(exact)


def test_neighbours_are_searched_once(spark, data):
    from pyspark.sql import functions as F

    vectors = np.delete(data[0], 3, axis=0)
    table = frame(spark, vectors, "vector_id")
    own = table.where("vector_id % 100 = 0").select(table.vector_id.alias("query_id"), "vector")
    chunks = table.select("vector_id", F.lit("text").alias("text"))
    df = retrieval.retrieve_chunks(retrieval.knn_cosine(table, own), chunks)
    assert df.count() == 21
    assert "CoGroups" not in df._jdf.queryExecution().executedPlan().toString()
