"""What keeps the work of a query in proportion: shuffles, decodes and batches that plans and helpers make."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from registry import changes as RC
from registry import inputs as I
from registry import timelines as RT
from strandline.operators import kept, retrieval
from strandline.sources.tables import spread

SMALL = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _pieces(tmp_path, rows: int, per_group: int) -> str:
    rng = np.random.default_rng(3)
    pq.write_table(pa.table({"x": rng.integers(0, 1 << 62, rows)}), f"{tmp_path}/t.parquet", row_group_size=per_group)
    return f"{tmp_path}/t.parquet"


def test_a_file_whose_pieces_fill_the_cores_is_not_shuffled(spark, tmp_path):
    # 64 MB and more, so that the scan has a task of 4 MB or more for each core
    table = spark.read.parquet(_pieces(tmp_path, 6_000_000, 100_000))
    assert spread(table).count() == 6_000_000
    assert "Exchange" not in _plan(spread(table))


def test_a_file_of_one_piece_is_dealt_over_the_cores(spark, tmp_path):
    table = spread(spark.read.parquet(_pieces(tmp_path, 1_000, 1_000)))
    assert table.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert table.count() == 1_000


def test_message_keys_are_what_the_formatter_made(spark):
    rows = spark.createDataFrame([(1,), (-7,), (None,)], "id long")
    made = [r[0] for r in rows.select(I._message_key("reading_id", rows.id)).collect()]
    assert made == ['{"reading_id":1}', '{"reading_id":-7}', '{"reading_id":null}']


def test_a_batch_is_folded_and_written_in_one_shuffle(spark, tmp_path, monkeypatch):
    changes = spark.sql(
        "SELECT id % 50 AS k, timestamp_seconds(id) AS cdc_timestamp, 0 AS bronze_partition, id AS bronze_offset, "
        "'u' AS operation FROM range(400)"
    )
    plans, real = [], kept.staged

    def seen(rows, *args, **options):
        plans.append(_plan(rows))
        return real(rows, *args, **options)

    monkeypatch.setattr(kept, "staged", seen)
    kept.apply_batch(changes, str(tmp_path), "k", buckets=4)
    assert plans[0].count("Exchange") == 1 and "rangepartitioning" in plans[0]
    assert kept.kept_history(spark, str(tmp_path)).where("is_current").count() == 50


def test_the_same_change_in_a_batch_and_between_batches_counts_once(spark, tmp_path):
    rows = "SELECT {} AS k, timestamp_seconds({}) AS cdc_timestamp, 0 AS bronze_partition, {} AS bronze_offset, 'u' AS operation"
    once = [("1", "1", "1"), ("1", "2", "2"), ("CAST(NULL AS INT)", "1", "1"), ("CAST(NULL AS INT)", "2", "2"), ("2", "1", "1")]
    batch = spark.sql(" UNION ALL ".join(rows.format(*r) for r in [*once, *once]))
    for _ in range(2):
        kept.apply_batch(batch, str(tmp_path), "k", buckets=4)
    found = kept.kept_history(spark, str(tmp_path)).selectExpr("k", "bronze_offset", "is_current").collect()
    assert sorted(map(tuple, found), key=repr) == sorted(
        [(1, 1, False), (1, 2, True), (2, 1, True), (None, 1, True), (None, 2, True)], key=repr
    )


@pytest.mark.parametrize("query", [RT.audit_readings, RC.scd2_history_sliced])
def test_the_log_is_decoded_once(spark, query):
    assert "from_json" not in _plan(query(spark, SMALL))


def test_asked_cells_leave_in_bounded_batches():
    planes, questions = retrieval.hyperplanes(8, 12), 30
    vectors = pa.FixedSizeListArray.from_arrays(np.random.default_rng(1).standard_normal(8 * questions), 8)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(questions), pa.int64()), vectors.cast(pa.list_(pa.float64()))], names=["query_id", "vector"]
    )
    made = list(retrieval._probed(planes, 1 << 12)(iter([batch])))
    assert max(b.num_rows for b in made) <= retrieval._ASKED_AT_ONCE
    pairs = {(q, c) for b in made for q, c in zip(b["query_id"].to_pylist(), b["cell"].to_pylist(), strict=True)}
    assert sum(b.num_rows for b in made) == len(pairs) == questions << 12


def test_a_page_of_texts_is_measured_after_each_row(spark):
    settings = ("parquet.page.size.row.check.min", "parquet.page.size.check.estimate")
    assert [spark.conf.get(s) for s in settings] == ["1", "false"]


def test_a_short_first_row_does_not_put_off_the_end_of_a_row_group(spark, tmp_path):
    texts = spark.range(0, 600, 1, 1).selectExpr(
        "id", "IF(id = 0, 'x', array_join(transform(sequence(1, 300), n -> sha2(concat(id, '-', n), 256)), '')) AS text"
    )
    texts.write.option("parquet.block.size", str(1 << 20)).parquet(f"{tmp_path}/t")
    (file,) = tmp_path.glob("t/*.parquet")
    groups = pq.ParquetFile(file).metadata
    assert max(groups.row_group(i).total_byte_size for i in range(groups.num_row_groups)) < 2 << 20
    assert spark.read.parquet(f"{tmp_path}/t").where("length(text) = 19200").count() == 599
