"""Saving and loading models and metrics."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as Ty

from docsim.operators.classifier import PairModel
from docsim.operators.features import NUMERIC_FEATURES

# Messages.
NO_MODEL = "No se encontró el modelo entrenado."
NO_METRICS = "No se encontró el archivo de métricas."

_CLASS = "struct<precision:double,recall:double,f1_score:double,support:bigint>"
METRICS_SCHEMA = (
    "dataset_name string, total_examples bigint, train_examples bigint, test_examples bigint, "
    "model string, accuracy double, accuracy_percentage double, "
    f"classes struct<no_plagio:{_CLASS},plagio:{_CLASS}>, "
    "confusion_matrix struct<true_negative:bigint,false_positive:bigint,"
    "false_negative:bigint,true_positive:bigint>"
)


def save_model(model: PairModel, path: str) -> None:
    """A table of terms with their coefficients, and a one-row table of numbers."""
    spark = model.vocabulary.sparkSession
    numbers = [model.name, model.intercept, *[model.numeric_coefs[f] for f in NUMERIC_FEATURES]]
    schema = Ty.StructType(
        [Ty.StructField("name", Ty.StringType()), Ty.StructField("intercept", Ty.DoubleType())]
        + [Ty.StructField(feature, Ty.DoubleType()) for feature in NUMERIC_FEATURES]
    )
    model.vocabulary.write.mode("overwrite").parquet(f"{path}/terms")
    spark.createDataFrame([tuple(numbers)], schema).write.mode("overwrite").parquet(f"{path}/numbers")


def load_model(spark: SparkSession, path: str) -> PairModel:
    """The saved model; FileNotFoundError when there is none."""
    try:
        numbers = spark.read.parquet(f"{path}/numbers").first()
        terms = spark.read.parquet(f"{path}/terms")
    except AnalysisException as error:
        raise FileNotFoundError(NO_MODEL) from error
    return PairModel(
        vocabulary=terms,
        intercept=numbers["intercept"],
        numeric_coefs={feature: numbers[feature] for feature in NUMERIC_FEATURES},
        name=numbers["name"],
    )


def save_metrics(metrics: DataFrame, path: str) -> None:
    """One JSON record."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def load_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The saved metrics, also from an indented JSON file; FileNotFoundError when missing."""
    try:
        return spark.read.schema(METRICS_SCHEMA).option("multiLine", True).json(path)
    except AnalysisException as error:
        raise FileNotFoundError(NO_METRICS) from error
