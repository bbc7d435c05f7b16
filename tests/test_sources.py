"""Stored corpus, windows over files, page assembly, stream with rejects, split and vectors at the level of files and plans."""

import io
import os
import random
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from docsim.operators import classifier, evaluation, splitting
from docsim.plans import inputs
from docsim.sources import corpus as C
from docsim.sources import ingest
from docsim.streaming import ingest as streaming


def plan_of(df, mode="formatted"):
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


def files_under(folder):
    return {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.startswith("part-")}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    table = C.CorpusTable(spark, str(tmp_path_factory.mktemp("corpus") / "documents"), 8)
    rows = spark.range(400).selectExpr("id", "concat('f', id) AS filename", "'t' AS raw_text", "IF(id < 300, 'upload', 'dataset') AS source_type", "'p' AS processed_text")
    table.save(rows)
    return table


def test_a_delete_leaves_other_partitions_alone(spark, stored):
    before = files_under(stored.folder)
    bucket = stored._stored().where("id = 7").select(stored.bucket_col).first()[0]
    assert stored.delete(spark.createDataFrame([(7,), (None,), (12345,)], "id bigint")) == 1
    after = files_under(stored.folder)
    touched = f"source_type=upload/{stored.bucket_col}={bucket}/"
    assert all(touched in f for f in before ^ after) and before ^ after
    assert sorted(r["id"] for r in stored.read().select("id").collect()) == sorted(set(range(400)) - {7})


def test_an_emptied_partition_stays_empty(spark, stored):
    bucket = stored._stored().where("id = 20").select(stored.bucket_col).first()[0]
    inside = stored._stored().where((F.col(stored.bucket_col) == bucket) & (F.col("source_type") == "upload") & F.col("id").isNotNull()).select("id")
    ids = [r["id"] for r in inside.collect()]
    assert stored.delete(spark.createDataFrame([(i,) for i in ids], "id bigint")) == len(ids) > 1
    assert stored.read().where(F.col("id").isin(ids)).isEmpty() and stored.get(20).isEmpty()
    left = stored.read().count()
    uploads = {f for f in files_under(stored.folder) if "source_type=upload" in f}
    assert stored.clear_dataset() == 100
    assert stored.read().count() == left - 100
    assert uploads <= files_under(stored.folder)


def test_a_lookup_reads_one_bucket_with_a_bloom_filter(spark, stored):
    found = stored.get(41)
    assert [r["id"] for r in found.collect()] == [41]
    plan = plan_of(found)
    (bucket,) = re.findall(rf"PartitionFilters: .*{stored.bucket_col}#\d+ = (\d)", plan)
    assert "EqualTo(id,41)" in plan
    (file,) = [f for f in files_under(stored.folder) if f"source_type=upload/{stored.bucket_col}={bucket}/" in f][:1]
    reader = spark._jvm.org.apache.parquet.hadoop.ParquetFileReader.open(
        spark._jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(spark._jvm.org.apache.hadoop.fs.Path(file), spark._jsc.hadoopConfiguration())
    )
    columns = reader.getFooter().getBlocks().get(0).getColumns()
    offsets = {columns.get(k).getPath().toDotString(): columns.get(k).getBloomFilterOffset() for k in range(columns.size())}
    reader.close()
    assert offsets["id"] > 0 > offsets["filename"]


def test_texts_are_stored_without_being_moved(spark, tmp_path):
    table = C.CorpusTable(spark, str(tmp_path / "corpus"), 4)
    rows = spark.range(0, 200, 1, 3).selectExpr("id", "concat('f', id) AS filename", "repeat('t ', 500) AS raw_text", "'p' AS processed_text")
    assert "Exchange" not in plan_of(table._placed(C.corpus_rows(rows)))
    table.save(rows)
    files = files_under(table.folder)
    assert len(files) == 12 and all(f.endswith(".zstd.parquet") for f in files)
    assert table.delete(spark.createDataFrame([(k,) for k in range(0, 200, 3)], "id bigint")) == 67
    assert sorted(r["id"] for r in table.read().select("id").collect()) == [k for k in range(200) if k % 3]


def test_pairs_move_no_text_that_they_do_not_show(spark, sf_dir):
    plan = inputs.labelled_pairs(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"THEN null ELSE next_text#\d+ END AS next_text", plan[plan.index("RepartitionByExpression") :]), plan


def test_another_number_of_buckets_is_an_error(spark, stored):
    with pytest.raises(ValueError):
        C.CorpusTable(spark, stored.folder, 4).read()


@pytest.fixture(scope="module")
def rows_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("rows") / "table")
    spark.range(0, 1000, 1, 10).selectExpr("id", "id * 2 AS x").write.parquet(path)
    return path


def test_a_window_reads_only_its_files(spark, rows_path):
    for start, limit in ((0, 5), (95, 10), (250, 100), (990, 50), (1000, 5), (0, 1000)):
        got = ingest.read_window(spark, rows_path, start, limit)
        assert sorted(tuple(r) for r in got.collect()) == [(k, 2 * k, k - start) for k in range(start, min(1000, start + limit))]
        if start < 1000:
            last = min(999, start + limit - 1)
            assert len(got.inputFiles()) == last // 100 - start // 100 + 1
    with pytest.raises(ValueError):
        ingest.read_window(spark, rows_path, 0, 0)


def test_a_head_asks_the_first_file_only(spark, rows_path, monkeypatch):
    asked, usual = [], ingest._rows_of_files
    monkeypatch.setattr(ingest, "_rows_of_files", lambda s, files: asked.extend(files) or usual(s, files))
    assert ingest.read_window(spark, rows_path, 0, 40).count() == 40
    assert len(asked) == 1


def test_pages_of_many_batches_keep_their_order(spark):
    rng = random.Random(2)
    rows = [(doc, page, f"p{page}") for doc, n in ((1, 12_000), (2, 1), (3, 0), (4, 700)) for page in range(n)] + [(None, 2, "b"), (None, 1, None)]
    rng.shuffle(rows)
    pages = spark.createDataFrame(rows, "doc_id int, page_no int, text string")
    got = {r["doc_id"]: r["raw_text"] for r in ingest.assemble_pages(pages).collect()}
    assert got == {d: "\n".join(f"p{k}" for k in range(n)) for d, n in ((1, 12_000), (2, 1), (4, 700))} | {None: "b"}
    assert "collect_list" not in plan_of(ingest.assemble_pages(pages))
    assert ingest.assemble_pages(pages.where("doc_id = 9")).isEmpty()


GOOD = " ".join(f"inhalt{k} wort{k}" for k in range(8))


def test_the_stream_keeps_the_valid_row_of_an_id(spark, tmp_path):
    schema = "id bigint, filename string, raw_text string"
    first = [(1, "a.txt", GOOD), (1, "a.pdf", GOOD), (2, "z.pdf", GOOD), (2, "b.pdf", GOOD), (3, "c.pdf", "kurz"), (None, "d.pdf", GOOD), (None, "e.pdf", None), (4, None, GOOD), (9, "old.pdf", GOOD)]
    second = [(1, "late.pdf", GOOD), (3, "c.pdf", GOOD), (5, "f.pdf", GOOD)]
    table = C.CorpusTable(spark, str(tmp_path / "corpus"), 4)
    table.save(spark.createDataFrame([(9, "there.pdf", "t", "t")], "id bigint, filename string, raw_text string, processed_text string"))
    for rows in (first, second):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        streaming.stream_into_corpus(stream, table, str(tmp_path / "progress")).awaitTermination()
    assert {(r["id"], r["filename"]) for r in table.read().collect()} == {(1, "a.pdf"), (2, "b.pdf"), (3, "c.pdf"), (5, "f.pdf"), (9, "there.pdf")}
    folder = f"{table.folder}-rejects"
    got = sorted((r["id"] or 0, r["filename"] or "", r["reason"], r["rows"]) for r in streaming.rejected(spark, folder).collect())
    assert got == sorted([
        (1, "a.txt", "name", 1), (1, "late.pdf", "duplicate", 1), (2, "z.pdf", "duplicate", 1), (3, "c.pdf", "content", 1),
        (0, "d.pdf", "no id", 1), (0, "e.pdf", "no id", 1), (4, "", "name", 1), (9, "old.pdf", "stored", 1),
    ])
    read = sum(r["rows"] for r in streaming.rows_read(spark, folder).collect())
    assert read == len(first) + len(second) == table.read().count() - 1 + sum(row[3] for row in got)


def test_a_batch_that_is_tried_again_counts_once(spark, tmp_path):
    table, rejects = C.CorpusTable(spark, str(tmp_path / "corpus"), 4), str(tmp_path / "rejects")
    rows = [(1, "a.pdf", GOOD), (2, "b.txt", GOOD)]
    batch = streaming.with_reason(spark.createDataFrame(rows, "id bigint, filename string, raw_text string"))
    none = table.read().select("id")
    streaming._count_rejects(batch, 0, none, rejects)
    table.save(ingest.ingest_documents(batch.where("reason IS NULL")))
    streaming._count_rejects(batch, 0, table.read().select("id"), rejects)
    assert [(r["id"], r["reason"]) for r in streaming.rejected(spark, rejects).collect()] == [(2, "name")]


def test_the_stream_calls_nothing_per_id_and_remembers_what_it_accepted(spark, tmp_path):
    schema = "id bigint, filename string, raw_text string"
    table, folder = C.CorpusTable(spark, str(tmp_path / "corpus"), 4), str(tmp_path / "corpus-rejects")
    rounds = [[(1, "a.pdf", GOOD)] * 3 + [(2, "b.pdf", GOOD + " drei"), (2, "b.pdf", GOOD), (None, None, None)], [(1, "0.pdf", GOOD), (3, "c.pdf", GOOD)]]
    for rows in rounds:
        spark.createDataFrame(rows, schema).repartition(4).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        query = streaming.stream_into_corpus(stream, table, str(tmp_path / "progress"))
        query.awaitTermination()
        assert not query.lastProgress["stateOperators"]
        assert table.read().where("id = 1").count() == (1 if rows is rounds[0] else 0)
        table.delete(spark.createDataFrame([(1,)], "id bigint"))
    got = sorted((r["id"] or 0, r["reason"], r["rows"], r["batch"]) for r in streaming.rejected(spark, folder).collect())
    assert got == [(0, "no id", 1, 0), (1, "duplicate", 1, 1), (1, "duplicate", 2, 0), (2, "duplicate", 1, 0)]
    assert sorted(r["id"] for r in table.read().collect()) == [2, 3]


@pytest.mark.parametrize("ranked", [1, 7, 100_000])
def test_the_cut_is_refined_to_any_size(spark, monkeypatch, ranked):
    rows = spark.range(900).select(F.col("id").alias("pair_id"), F.when(F.col("id") % 5 == 0, 1).when(F.col("id") % 211 == 3, None).otherwise(0).alias("label"))
    # digests that clash: a short one, followed by zeros
    usual = F.md5
    monkeypatch.setattr(splitting.F, "md5", lambda c: F.rpad(F.substring(usual(c), 1, 2), 32, "0"))
    got = {r["pair_id"] for r in splitting.stratified_split(rows, ranked=ranked).where("is_test").collect()}
    keyed = rows.withColumn("d", F.substring(usual(F.concat(F.col("pair_id").cast("string"), F.lit("|42"))), 1, 2)).collect()
    wanted = set()
    for label in (0, 1):
        own = sorted((r["d"], r["pair_id"]) for r in keyed if r["label"] == label)
        wanted |= {p for _, p in own[: int(len(own) * 0.2 + 0.5)]}
    assert got == wanted


def test_training_uses_no_row_function_and_no_shuffle_of_terms(spark, sf_dir):
    rows = spark.createDataFrame([(1, 1.0, [0, 3], [0.5, 2.0]), (0, 2.0, [], [])], "label int, weight double, indices array<int>, values array<double>")
    vectors = classifier.with_vectors(rows, 5)
    assert "Python" not in plan_of(vectors)
    got = {r["label"]: r["features"] for r in vectors.collect()}
    assert (got[1].size, got[1].indices.tolist(), got[1].values.tolist(), got[0].numNonzeros()) == (5, [0, 3], [0.5, 2.0], 0)
    vocabulary = spark.createDataFrame([("aaa", 0, 1.0, 2.0, 3.0)], "term string, idx int, idf double, difference_coef double, product_coef double")
    model = classifier.PairModel(vocabulary, 0.25, dict.fromkeys(("cosine", "jaccard", "containment", "length_ratio"), 1.0))
    plan = plan_of(classifier.predict_pairs(inputs.table(spark, sf_dir, "documents").selectExpr("doc_id AS pair_id", "text AS text_a", "text AS text_b"), model))
    assert "Exchange" not in plan and "BatchEvalPython" not in plan


def test_texts_of_pairs_are_prepared_once(spark):
    pairs = spark.createDataFrame([(0, "uno dos tres", "cuatro cinco", 1)], "row_idx bigint, text_a string, text_b string, label int")
    for df in (ingest.ingest_pairs(pairs), classifier.training_pairs(pairs)):
        plan = plan_of(df, "extended").split("== Physical Plan ==")[1]
        assert plan.count("regexp_replace(regexp_replace(") <= 2 * plan.count("Generate")


def test_examples_look_at_the_first_window_only(spark, monkeypatch):
    asked, usual = [], evaluation.head_rows
    monkeypatch.setattr(evaluation, "head_rows", lambda rows, limit, col: asked.append(limit) or usual(rows, limit, col))
    texts = ["id AS row_idx", "concat('alpha beta gamma ', id) AS text_a", "'alpha beta gamma' AS text_b", "1 AS label"]
    many = evaluation.evaluation_examples(spark.range(5000).selectExpr(*texts))
    assert [r["row"] for r in many.collect()] == list(range(1, 11)) and asked == [40]
    asked.clear()
    few = spark.range(5000).selectExpr("id AS row_idx", "'alpha beta gamma' AS text_a", "'alpha beta gamma' AS text_b", "IF(id % 100 = 0, 1, NULL) AS label")
    assert [r["row"] for r in evaluation.evaluation_examples(few).collect()] == [100 * k + 1 for k in range(10)]
    assert asked == [40, 160, 640, 2560]
    assert evaluation.evaluation_examples(few.where("row_idx < 0")).isEmpty()
