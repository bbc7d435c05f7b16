import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from docsim.functions.rows import head_rows
from docsim.operators.dataset_pairs import compare_dataset_pairs, newest_two
from docsim.sources import corpus as C
from docsim.sources import ingest


def docs(spark, rows):
    return spark.createDataFrame(
        rows, "id bigint, filename string, raw_text string, processed_text string, source_type string, pair_group string, expected_label int"
    ).withColumn("uploaded_at", F.timestamp_seconds(F.col("id")))


def test_table_life(spark, tmp_path):
    table = C.CorpusTable(spark, str(tmp_path / "corpus"))
    assert table.read().count() == 0
    table.save(spark.createDataFrame([(1, "a.pdf", "x" * 6000, "y" * 6000)], "id bigint, filename string, raw_text string, processed_text string"))
    row = table.get(1).first()
    assert (len(row["raw_text"]), len(row["processed_text"])) == (6000, 6000)
    cut = C.corpus_rows(table.get(1), raw_length=5000).first()
    assert (len(cut["raw_text"]), len(cut["processed_text"])) == (5000, 6000)
    assert (row["language"], row["source_type"], row["expected_label"]) == ("unknown", "upload", None)
    assert row["uploaded_at"] is not None
    table.save(docs(spark, [(2, "b", "t", "t", "dataset", "g", 1), (3, "c", "t", "t", "dataset", "g", 0)]))
    assert tuple(table.counts().first()) == (3, 2)
    ids = spark.createDataFrame([(3,), (99,)], "id bigint")
    assert table.delete(ids) == 1
    assert table.delete(ids) == 0
    assert table.get(3).count() == 0
    assert table.clear_dataset() == 1
    assert [r["id"] for r in C.newest_first(table.read()).collect()] == [1]
    assert table.clear() == 1
    assert tuple(table.counts().first()) == (0, 0)
    table.save(docs(spark, [(5, "d", "t", "t", "upload", None, None)]))
    assert table.read().count() == 1


def test_groups_take_the_newest_two(spark):
    corpus = docs(
        spark,
        [
            (1, "old", "", "alpha beta", "dataset", "g1", 0),
            (2, "mid", "", "alpha beta", "dataset", "g1", 0),
            (3, "new", "", "alpha beta", "dataset", "g1", 1),
            (4, "single", "", "alpha beta", "dataset", "g2", 1),
            (5, "nogroup", "", "alpha beta", "dataset", "", 1),
            (6, "upload", "", "alpha beta", "upload", "g2", 1),
        ],
    )
    (row,) = compare_dataset_pairs(corpus).collect()
    assert (row["pair_group"], row["doc_a_name"], row["doc_b_name"]) == ("g1", "new", "mid")
    assert (row["similarity_score"], row["expected_label"], row["prediction_matches_dataset"]) == (1.0, 1, True)


def test_hot_groups_are_cut_before_the_shuffle(spark):
    corpus = docs(spark, [(1, "a", "", "x", "dataset", "g", 0)])
    plan = io.StringIO()
    with redirect_stdout(plan):
        newest_two(corpus).explain()
    assert "WindowGroupLimit" in plan.getvalue() and "Partial" in plan.getvalue()


def test_ingest_names_and_numbers(spark):
    pairs = spark.createDataFrame(
        [(0, "uno dos tres", "cuatro cinco seis", 1), (1, "x", "cuatro cinco", 0), (1233, "alfa beta", "gama delta", None)],
        "row_idx bigint, text_a string, text_b string, label int",
    )
    rows = ingest.ingest_pairs(pairs).orderBy("id").collect()
    assert [r["filename"] for r in rows] == ["dataset_001_A.txt", "dataset_001_B.txt", "dataset_1234_A.txt", "dataset_1234_B.txt"]
    assert [r["pair_group"] for r in rows] == ["dataset_pair_001"] * 2 + ["dataset_pair_1234"] * 2
    summary = ingest.ingest_summary(pairs, 2000).first()
    assert (summary["saved_documents"], summary["skipped_rows"]) == (4, 1)


def test_pages_in_order(spark):
    pages = spark.createDataFrame([(1, 10, "z"), (1, 2, " a"), (1, 3, None), (2, 1, "\n")], "doc_id int, page_no int, text string")
    got = {r["doc_id"]: r["raw_text"] for r in ingest.assemble_pages(pages).collect()}
    assert got == {1: "a\n\nz", 2: ""}


def test_limits_and_windows(spark):
    starts = {ingest.window_start(seed, 3) for seed in range(100)}
    assert starts == {0, 1, 2, 3}
    rows = spark.range(20).withColumnRenamed("id", "row_idx").withColumn("x", F.col("row_idx"))
    with pytest.raises(ValueError):
        head_rows(rows, 0)
    with pytest.raises(ValueError):
        ingest.window_rows(rows, -1, 3)
    assert [tuple(r) for r in ingest.window_rows(rows, 5, 2).orderBy("row_idx").collect()] == [(0, 5), (1, 6)]
    assert head_rows(rows, 3).count() == 3


def test_row_index_over_several_files(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(0, 1000, 1, 5).write.parquet(path)
    indexed = ingest.with_row_index(spark.read.parquet(path))
    assert sorted(r["row_idx"] for r in indexed.collect()) == list(range(1000))
