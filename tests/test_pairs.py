import pytest
from plain import cosine, prepare
from pyspark.sql import functions as F

from docsim.functions import similarity as S
from docsim.functions import text as T
from docsim.operators import pairs as P
from docsim.plans import inputs

GOLDEN = [
    ("El sistema permite detectar similitud entre documentos académicos.",
     "El sistema detecta coincidencias textuales entre documentos escolares.",
     0.2020, 20.20, 0.7980, "Similitud baja"),
    ("alpha beta gamma", "alpha beta gamma", 1.0, 100.0, 0.0, "Plagio"),
    ("alpha beta", "gamma delta", 0.0, 0.0, 1.0, "Similitud baja"),
    ("alpha alpha beta gamma", "alpha beta beta delta", 0.5734, 57.34, 0.4266, "Similitud sospechosa"),
    ("", "anything", 0.0, 0.0, 1.0, "Texto insuficiente"),
    (None, None, 0.0, 0.0, 1.0, "Texto insuficiente"),
]


def test_golden_scores(spark):
    rows = spark.createDataFrame(
        [(k, g[0], g[1]) for k, g in enumerate(GOLDEN)], "k int, text_a string, text_b string"
    )
    got = P.compare_texts(rows).orderBy("k").collect()
    for row, (a, b, score, percent, distance, status) in zip(got, GOLDEN):
        assert (row["similarity_score"], row["similarity_percentage"]) == (score, percent)
        assert (row["cosine_distance"], row["status"]) == (distance, status)
        assert (row["text_a_length"], row["text_b_length"]) == (len(a or ""), len(b or ""))


def test_closed_form_equals_definition_and_is_symmetric(spark, sf_dir):
    pairs = P.with_prepared(inputs.labelled_pairs(spark, sf_dir))
    swapped = P.with_overlap(P.with_overlap(pairs).withColumnRenamed("overlap", "forth"), "processed_b", "processed_a")
    rows = swapped.select(
        "text_a", "text_b",
        S.pair_cosine(F.col("forth")).alias("forth"), S.pair_cosine(F.col("overlap")).alias("back"),
    ).collect()
    assert len(rows) > 100
    for row in rows:
        assert row["forth"] == row["back"]
        assert 0.0 <= row["forth"] <= 1.0
        assert abs(row["forth"] - cosine(prepare(row["text_a"]), prepare(row["text_b"]))) < 1e-12


def test_set_measures_two_ways(spark, sf_dir):
    pairs = P.with_set_measures(P.with_prepared(inputs.labelled_pairs(spark, sf_dir)))
    a, b = T.prepared_tokens(F.col("processed_a")), T.prepared_tokens(F.col("processed_b"))
    wrong = pairs.where(
        (S.jaccard(a, b) != F.col("jaccard"))
        | (S.containment(a, b) != F.col("containment"))
        | (S.length_ratio(a, b) != F.col("length_ratio"))
    )
    assert wrong.count() == 0


@pytest.mark.parametrize(
    "score, status", [(0.7, "Plagio"), (0.6999, "Similitud sospechosa"), (0.4, "Similitud sospechosa"), (0.39999, "Similitud baja")]
)
def test_bands(spark, score, status):
    assert spark.range(1).select(S.similarity_status(F.lit(score))).first()[0] == status


def test_labels(spark):
    rows = spark.createDataFrame([(1, 0.7), (0, 0.7), (0, 0.6999), (None, 0.9), (2, 0.9)], "label int, s double")
    got = rows.select(
        S.label_meaning(F.col("label")), S.label_display(F.col("label")), S.matches_label(F.col("s"), F.col("label"))
    ).collect()
    assert [r[2] for r in got] == [True, False, True, None, False]
    assert [r[1] for r in got] == ["Plagio", "No plagio", "No plagio", "Sin etiqueta", "Sin etiqueta"]
    assert got[0][0].startswith("Par positivo") and got[3][0] == "Sin etiqueta"
