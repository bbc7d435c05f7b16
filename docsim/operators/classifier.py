"""Training a pair classifier and predicting pairs with it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from docsim.functions.rounding import round_even
from docsim.functions.text import is_blank
from docsim.operators import features as X
from docsim.operators import term_weights as W
from docsim.operators.evaluation import confusion_counts, rounded_class, with_class_metrics
from docsim.operators.pairs import evaluable, with_prepared, with_set_measures
from docsim.operators.splitting import stratified_split
from docsim.session import new_path, written

# Names, texts and limits.
MODEL_NAME = "TF-IDF + Logistic Regression con características de comparación"
PREDICTED_POSITIVE = "Plagio / similar"
PREDICTED_NEGATIVE = "No plagio / no similar"
MIN_TRAINING_PAIRS = 100
MAX_ITERATIONS = 1500
NOT_ENOUGH_DATA = "No hay suficientes datos para entrenar el modelo."


@dataclass(frozen=True)
class PairModel:
    """A fitted classifier: one row per vocabulary term, and a handful of numbers."""

    vocabulary: DataFrame  # term, idx, idf, difference_coef, product_coef
    intercept: float
    numeric_coefs: dict[str, float]
    name: str = MODEL_NAME
    iterations: int | None = None  # of the fit; not saved


def training_pairs(pairs: DataFrame) -> DataFrame:
    """Cleaned pairs with prepared texts and a usable label."""
    return evaluable(with_prepared(pairs)).drop("text_a", "text_b")


def with_vectors(rows: DataFrame, width: int) -> DataFrame:
    """``label``, ``weight`` and the sparse rows as vectors of Spark ML, written once.

    A vector is stored as a struct of plain columns, so a table written with these is read as vectors and no
    Python worker builds them.
    """
    spark, path = rows.sparkSession, new_path(rows.sparkSession, "vectors")
    sparse = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(width).alias("size"), F.col("indices"), F.col("values")
    )
    rows.select("label", "weight", sparse.alias("features")).write.parquet(path)
    schema = StructType([StructField("label", DoubleType()), StructField("weight", DoubleType()), StructField("features", VectorUDT())])
    return spark.read.schema(schema).parquet(path)


def fit_classifier(
    rows: DataFrame, vocabulary: DataFrame, size: int, name: str = MODEL_NAME
) -> PairModel:
    """Logistic regression with C = 1 and balanced class weights n / (2 n_class).

    Spark ML fits it. Features are standardised, so the penalty is on coefficients of scaled
    features: without that, the fit had not converged after 300 iterations. Fitted numbers hence
    differ somewhat from a fit with the penalty on unscaled coefficients.
    """
    spark = rows.sparkSession
    totals = {
        row["label"]: row["n"]
        for row in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    n = sum(totals.values())
    weight = F.lit(None).cast("double")
    for label, count in totals.items():
        weight = F.when(F.col("label") == label, F.lit(n / (2.0 * count))).otherwise(weight)
    weighted = rows.select(F.col("label").cast("double").alias("label"), weight.alias("weight"), "indices", "values")
    solver = LogisticRegression(
        maxIter=MAX_ITERATIONS, regParam=1.0 / n, weightCol="weight", standardization=True
    )
    fitted = solver.fit(with_vectors(weighted, 2 * size + len(X.NUMERIC_FEATURES)))
    coefs = fitted.coefficients.toArray()
    # the coefficients are as many as the fixed vocabulary size allows
    table = spark.createDataFrame(
        [(k, float(coefs[k]), float(coefs[size + k])) for k in range(size)],
        "idx int, difference_coef double, product_coef double",
    )
    with_coefs = vocabulary.select("term", "idx", "idf").join(F.broadcast(table), "idx")
    return PairModel(
        vocabulary=written(with_coefs, "model"),
        intercept=float(fitted.intercept),
        numeric_coefs={
            feature: float(coefs[2 * size + k]) for k, feature in enumerate(X.NUMERIC_FEATURES)
        },
        name=name,
        iterations=fitted.summary.totalIterations,
    )


def decision_values(prepared: DataFrame, model: PairModel) -> DataFrame:
    """The pairs with ``decision``: intercept plus coefficients times features.

    Nothing leaves the row: its terms meet their coefficients in the vocabulary that goes with the function.
    """
    sums = W.linear_sums(W.TermTable.of(model.vocabulary), "processed_a", "processed_b")
    measured = with_set_measures(prepared.select("*", sums.alias("sums"))).withColumn("cosine", F.col("sums.cosine"))
    decision = F.lit(model.intercept) + F.col("sums.term_sum")
    for feature in X.NUMERIC_FEATURES:
        decision = decision + F.col(feature) * F.lit(model.numeric_coefs[feature])
    return measured.select(*prepared.columns, decision.alias("decision"))


def prediction_columns(decision: Column, name: str) -> list[Column]:
    """Class, text and confidence of a decision value."""
    positive = F.lit(1.0) / (F.lit(1.0) + F.exp(-decision))
    confidence = F.when(decision > 0, positive).otherwise(F.lit(1.0) - positive)
    return [
        F.lit(name).alias("model"),
        (decision > 0).cast("int").alias("prediction"),
        F.when(decision > 0, F.lit(PREDICTED_POSITIVE))
        .otherwise(F.lit(PREDICTED_NEGATIVE))
        .alias("prediction_text"),
        round_even(confidence, 4).alias("confidence"),
        round_even(confidence * 100, 2).alias("confidence_percentage"),
    ]


def predict_pairs(pairs: DataFrame, model: PairModel, id_col: str = "pair_id") -> DataFrame:
    """Predictions for raw text pairs; pairs with a blank side are left out."""
    given = pairs.where(~is_blank(F.col("text_a")) & ~is_blank(F.col("text_b")))
    prepared = with_prepared(given).select(id_col, "processed_a", "processed_b")
    return decision_values(prepared, model).select(
        id_col,
        *prediction_columns(F.col("decision"), model.name),
        F.col("processed_a").alias("processed_text_a"),
        F.col("processed_b").alias("processed_text_b"),
    )


def test_metrics(
    tested: DataFrame, train_examples: int, test_examples: int, dataset_name: str, name: str
) -> DataFrame:
    """One row: sizes, accuracy, class metrics and confusion matrix of predictions."""
    counts = tested.agg(
        *confusion_counts(F.col("label"), (F.col("decision") > 0).cast("int"))
    )

    def class_struct(number: int) -> Column:
        return rounded_class(number).dropFields("label")

    return with_class_metrics(counts).select(
        F.lit(dataset_name).alias("dataset_name"),
        F.lit(train_examples + test_examples).cast("bigint").alias("total_examples"),
        F.lit(train_examples).cast("bigint").alias("train_examples"),
        F.lit(test_examples).cast("bigint").alias("test_examples"),
        F.lit(name).alias("model"),
        round_even(F.col("accuracy"), 4).alias("accuracy"),
        round_even(F.col("accuracy") * 100, 2).alias("accuracy_percentage"),
        F.struct(class_struct(0).alias("no_plagio"), class_struct(1).alias("plagio")).alias("classes"),
        F.struct("true_negative", "false_positive", "false_negative", "true_positive").alias(
            "confusion_matrix"
        ),
    )


def train_model(
    pairs: DataFrame,
    dataset_name: str = "",
    size: int = X.VOCABULARY_SIZE,
    id_col: str = "pair_id",
) -> tuple[PairModel, DataFrame]:
    """Clean, split, fit vocabulary and classifier, test. Returns the model and its metrics."""
    cleaned = written(training_pairs(pairs), "training")
    if cleaned.count() < MIN_TRAINING_PAIRS:
        raise ValueError(NOT_ENOUGH_DATA)
    split = written(stratified_split(cleaned, id_col=id_col), "split")
    train = split.where(~F.col("is_test")).drop("is_test")
    test = split.where("is_test").drop("is_test")
    vocabulary = X.written_vocabulary(X.pair_texts(train), "processed", size)
    model = fit_classifier(X.feature_rows(train, vocabulary, size), vocabulary, size)
    metrics = test_metrics(
        decision_values(test, model), train.count(), test.count(), dataset_name, model.name
    )
    return model, metrics
