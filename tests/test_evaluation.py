import pytest

from docsim.operators import evaluation as E
from docsim.operators import pairs as P
from docsim.plans import inputs


def test_sweep_values_stop_before_the_end():
    values = E.sweep_values()
    assert (len(values), values[0], values[-1]) == (50, (0.1, 10.0), (0.59, 59.0))


def test_counts_add_up_and_sweep_agrees(spark, sf_dir):
    pairs = inputs.labelled_pairs(spark, sf_dir)
    sweep = {r["threshold"]: r for r in E.sweep_thresholds(pairs).collect()}
    assert len(sweep) == 50
    result = E.evaluate_threshold(pairs, 0.3).first()
    assert result["evaluated_count"] + result["skipped_rows"] == pairs.count()
    assert sum(result["confusion_matrix"]) == result["evaluated_count"]
    assert sweep[0.3]["accuracy_percentage"] == result["accuracy_percentage"]
    assert sweep[0.3]["plagio_f1"] == round(result["classes"]["plagio"]["f1_score"] * 100, 2)


def test_best_takes_the_lowest_threshold_in_a_tie(spark):
    rows = [(0.2, 20.0, 90.0, 1.0, 1.0, 50.0, 1.0), (0.1, 10.0, 90.0, 1.0, 1.0, 40.0, 1.0), (0.3, 30.0, 80.0, 1.0, 1.0, 50.0, 1.0)]
    sweep = spark.createDataFrame(
        rows,
        "threshold double, threshold_percentage double, accuracy_percentage double, plagio_precision double, "
        "plagio_recall double, plagio_f1 double, no_plagio_f1 double",
    )
    got = {r["criterion"]: r["threshold"] for r in E.best_thresholds(sweep).collect()}
    assert got == {"accuracy": 0.1, "plagio_f1": 0.2}
    assert [r["threshold"] for r in E.top_thresholds(sweep, 2).collect()] == [0.1, 0.2]


def test_nothing_to_evaluate(spark):
    pairs = spark.createDataFrame([(0, "a", "b", 1)], "row_idx int, text_a string, text_b string, label int")
    result = E.evaluate_threshold(pairs).first()
    assert (result["message"], result["evaluated_count"], result["skipped_rows"]) == (E.NOTHING_TO_EVALUATE, 0, 1)
    assert result["accuracy"] is None
    assert E.best_thresholds(E.sweep_thresholds(pairs)).count() == 0


def test_report_of_one_class(spark):
    counts = spark.createDataFrame([(3, 1, 0, 0)], "true_negative bigint, false_positive bigint, false_negative bigint, true_positive bigint")
    report = {r["name"]: r for r in E.classification_report(counts).collect()}
    assert report["No plagio"]["precision"] == 1.0 and report["No plagio"]["recall"] == 0.75
    assert report["Plagio"]["f1_score"] == 0.0 and report["Plagio"]["support"] == 0
    assert report["weighted avg"]["recall"] == 0.75 and report["macro avg"]["recall"] == 0.375


def test_sweep_values_are_whole_hundredths():
    assert E.sweep_values(0.0, 1.0, 0.25) == [(0.0, 0.0), (0.25, 25.0), (0.5, 50.0), (0.75, 75.0)]
    assert E.sweep_values(0.3, 0.3) == []
    for wrong in ((0.1, 0.6, 0.005), (0.1, 0.6, 0.0), (0.1, 0.6, -0.01), (0.6, 0.1, 0.01), (-0.1, 0.6, 0.01), (0.1, 1.1, 0.01)):
        with pytest.raises(ValueError):
            E.sweep_values(*wrong)


def test_a_sweep_keeps_prepared_texts_in_one_worker(spark):
    texts = ["Él la casa http://x.y verde", "casa verde casa grande", "", None, "árbol verde uno dos", "  "]
    rows = [(k, a, b, (k + j) % 2) for k, a in enumerate(texts) for j, b in enumerate(texts)]
    pairs = spark.createDataFrame(rows, "row_idx bigint, text_a string, text_b string, label int")
    scored = E.scored_examples(pairs)
    assert scored._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    prepared = P.with_scores(P.with_prepared(pairs), min_words=P.MIN_PAIR_WORDS)
    columns = ["row_idx", "text_a", "text_b", "label", "similarity_score", "status"]
    assert sorted(map(str, scored.select(columns).collect())) == sorted(map(str, prepared.select(columns).collect()))
    assert scored.count() == 9
