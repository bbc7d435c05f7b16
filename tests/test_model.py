import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from docsim.operators import classifier as K
from docsim.operators import features as X
from docsim.operators.splitting import stratified_split
from docsim.plans import inputs
from docsim.sources import model_store


def test_split_equals_ranking_whole_labels(spark):
    rows = spark.range(5000).select(F.col("id").alias("pair_id"), (F.col("id") % 7 == 0).cast("int").alias("label"))
    got = stratified_split(rows).where("is_test").select("pair_id")
    rows.createOrReplaceTempView("split_rows")
    wanted = spark.sql(
        "select pair_id from (select *, row_number() over (partition by label order by md5(concat(pair_id, '|42')), pair_id) rn,"
        " count(*) over (partition by label) n from split_rows) where rn <= floor(0.2 * n + 0.5)"
    )
    assert got.exceptAll(wanted).isEmpty() and wanted.exceptAll(got).isEmpty()
    assert got.count() == math.floor(0.2 * 715 + 0.5) + math.floor(0.2 * 4285 + 0.5)


def test_vocabulary_and_weights_by_hand(spark):
    docs = spark.createDataFrame([(1, "aaa bbb aaa"), (2, "bbb ccc"), (3, "")], "id int, p string")
    vocabulary = X.fit_vocabulary(docs, "p", 4)
    rows = {r["term"]: r for r in vocabulary.collect()}
    assert {t: (r["total"], r["df"], r["idx"]) for t, r in rows.items()} == {
        "aaa": (2, 1, 0), "aaa bbb": (1, 1, 1), "bbb": (2, 2, 2), "bbb aaa": (1, 1, 3),
    }
    assert rows["bbb"]["idf"] == pytest.approx(math.log(4 / 3) + 1)
    weights = {(r["id"], r["term"]): r["weight"] for r in X.tfidf_weights(docs, vocabulary, "id", "p").collect()}
    assert weights[(2, "bbb")] == pytest.approx(1.0)
    assert sum(w * w for (d, _), w in weights.items() if d == 1) == pytest.approx(1.0)


def test_train_save_load_predict(spark, sf_dir, tmp_path):
    pairs = inputs.labelled_pairs(spark, sf_dir)
    model, metrics = K.train_model(pairs, "test", size=2000)
    row = metrics.first()
    assert row["train_examples"] + row["test_examples"] == row["total_examples"]
    assert sum(row["confusion_matrix"]) == row["test_examples"]
    assert row["accuracy"] > 0.9
    assert 0 < model.iterations < 300
    model_store.save_model(model, str(tmp_path / "model"))
    model_store.save_metrics(metrics, str(tmp_path / "metrics"))
    assert model_store.load_metrics(spark, str(tmp_path / "metrics")).first() == row
    loaded = model_store.load_model(spark, str(tmp_path / "model"))
    some = pairs.where("pair_id < 40")
    first = K.predict_pairs(some, model).orderBy("pair_id").collect()
    assert first == K.predict_pairs(some, loaded).orderBy("pair_id").collect()
    assert len(first) == some.where("trim(text_b) <> ''").count()
    assert all(0.5 <= r["confidence"] <= 1.0 for r in first)
    # the long form of the prediction equals coefficients times the feature row
    prepared = K.training_pairs(pairs)
    width = 2 * 2000 + 4
    beta = np.zeros(width)
    for term in model.vocabulary.collect():
        beta[term["idx"]], beta[2000 + term["idx"]] = term["difference_coef"], term["product_coef"]
    beta[4000:] = [model.numeric_coefs[f] for f in X.NUMERIC_FEATURES]
    vectors = {r["pair_id"]: r for r in X.feature_rows(prepared, model.vocabulary, 2000).collect()}
    for r in K.decision_values(prepared, model).collect():
        v = vectors[r["pair_id"]]
        z = model.intercept + sum(beta[i] * x for i, x in zip(v["indices"], v["values"]))
        assert r["decision"] == pytest.approx(z, abs=1e-9)


def test_prediction_without_known_terms_is_numeric_part_only(spark):
    vocabulary = spark.createDataFrame([("aaa", 0, 1.0, 2.0, 3.0)], "term string, idx int, idf double, difference_coef double, product_coef double")
    model = K.PairModel(vocabulary, 0.25, dict.fromkeys(X.NUMERIC_FEATURES, 0.0))
    pairs = spark.createDataFrame([(1, "el la", "de"), (2, "aaa", "aaa"), (3, "aaa", "zzz")], "pair_id int, text_a string, text_b string")
    got = {r["pair_id"]: r["confidence"] for r in K.predict_pairs(pairs, model).collect()}
    assert got == {k: round(1 / (1 + math.exp(-z)), 4) for k, z in {1: 0.25, 2: 3.25, 3: 2.25}.items()}


def test_too_little_data_and_missing_files(spark, tmp_path):
    pairs = spark.createDataFrame([(1, "uno dos tres", "uno dos tres", 1)], "pair_id int, text_a string, text_b string, label int")
    with pytest.raises(ValueError):
        K.train_model(pairs)
    with pytest.raises(FileNotFoundError):
        model_store.load_model(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        model_store.load_metrics(spark, str(tmp_path / "none"))
