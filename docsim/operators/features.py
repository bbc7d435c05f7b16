"""TF-IDF over words and word pairs, and the features of a text pair."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docsim.functions import similarity as S
from docsim.functions import text as T
from docsim.operators import term_weights as W
from docsim.operators.frequent_terms import CAPACITY, counts_of, frequent_terms
from docsim.operators.pairs import with_set_measures
from docsim.session import written

# Fixed value: size of the vocabulary.
VOCABULARY_SIZE = 10_000
NUMERIC_FEATURES = ("cosine", "jaccard", "containment", "length_ratio")


def grams(prepared: Column) -> Column:
    """Words and pairs of neighbouring words of a prepared text."""

    def with_pairs(words: Column) -> Column:
        fewer = F.greatest(F.size(words) - 1, F.lit(0))
        pairs = F.zip_with(
            F.slice(words, F.lit(1), fewer),
            F.slice(words, F.lit(2), fewer),
            lambda first, second: F.concat(first, F.lit(" "), second),
        )
        return F.concat(words, pairs)

    return T.bind(T.prepared_tokens(prepared), with_pairs)


def _terms(docs: DataFrame, keys: list[str], bag: Column) -> DataFrame:
    """``keys`` and the fields of every element of a bag.

    The outer form is used because the inner one makes Spark build the bag a second time, for
    a filter on its size.
    """
    return docs.select(*keys, F.inline_outer(bag)).where(F.col("term").isNotNull())


def term_frequency(docs: DataFrame, id_col: str, prepared_col: str) -> DataFrame:
    """``id_col, term, tf`` of prepared texts; counted inside the row."""
    return _terms(docs, [id_col], S.term_bag(T.prepared_tokens(F.col(prepared_col))))


def document_frequency(docs: DataFrame, prepared_col: str) -> DataFrame:
    """``term, df, idf`` with the smooth idf ln((1 + n) / (1 + df)) + 1."""
    counts = (
        docs.select(
            F.explode_outer(F.array_distinct(T.prepared_tokens(F.col(prepared_col)))).alias("term")
        )
        .where(F.col("term").isNotNull())
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
    )
    n = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.withColumn("idf", F.log((n + 1) / (F.col("df") + 1)) + 1)


def fit_vocabulary(
    texts: DataFrame, prepared_col: str, size: int = VOCABULARY_SIZE, capacity: int = CAPACITY
) -> DataFrame:
    """``term, idx, total, df, idf``: the most frequent terms, numbered in alphabetical order.

    The alphabet decides between equal counts. Tasks propose terms, and only proposed terms are counted
    over all texts (:mod:`docsim.operators.frequent_terms`).
    """

    def all_terms() -> DataFrame:
        return _terms(texts, [], S.term_bag(grams(F.col(prepared_col))))

    def some_terms(candidates: pa.Array) -> DataFrame:
        return counts_of(texts, prepared_col, candidates)

    counts = frequent_terms(texts, prepared_col, size, all_terms, capacity, some_terms)
    top = counts.orderBy(F.desc("total"), "term").limit(size)
    n = texts.agg(F.count(F.lit(1)).alias("n")).scalar()
    # at most ``size`` rows are left, so one window numbers them
    return top.select(
        "term",
        (F.row_number().over(Window.orderBy("term")) - 1).alias("idx"),
        "total",
        "df",
        (F.log((n + 1) / (F.col("df") + 1)) + 1).alias("idf"),
    )


def pair_texts(prepared: DataFrame) -> DataFrame:
    """Both texts of every pair as rows of one column ``processed``."""
    return prepared.select(F.explode(F.array("processed_a", "processed_b")).alias("processed"))


def tfidf_weights(docs: DataFrame, vocabulary: DataFrame, id_col: str, prepared_col: str) -> DataFrame:
    """``id_col, idx, term, weight``: L2-normalised TF-IDF; unknown terms are dropped."""
    weights = W.text_weights(W.TermTable.of(vocabulary), prepared_col)
    return docs.select(id_col, F.inline_outer(weights)).where("idx IS NOT NULL")


def pair_term_features(
    prepared: DataFrame, vocabulary: DataFrame, id_col: str = "pair_id"
) -> DataFrame:
    """Per pair and known term: ``difference`` |a - b| and ``product`` a * b of the weights."""
    kind = prepared.schema[id_col].dataType.simpleString()
    rows = W.pair_term_rows(W.TermTable.of(vocabulary))
    return prepared.select(id_col, "processed_a", "processed_b").mapInArrow(
        rows, f"`{id_col}` {kind}, idx int, difference double, product double"
    )


def feature_rows(
    prepared: DataFrame,
    vocabulary: DataFrame,
    size: int = VOCABULARY_SIZE,
) -> DataFrame:
    """The pairs with their features as a sparse row, ``indices`` and ``values``.

    The feature space is 2 * size + 4 wide: differences, products, then the four numbers. Everything is
    computed in the row.
    """
    weights = W.pair_weights(W.TermTable.of(vocabulary), "processed_a", "processed_b")
    weighed = prepared.select("*", weights.alias("terms")).withColumn(
        "cosine", F.aggregate("terms.product", F.lit(0.0), lambda total, x: total + x)
    )
    shared = F.filter("terms", lambda x: x["product"] != 0)
    different = F.filter("terms", lambda x: x["difference"] != 0)
    numbers = F.array(*[F.col(name) for name in NUMERIC_FEATURES])
    places = F.array(*[F.lit(2 * size + k) for k in range(len(NUMERIC_FEATURES))])
    return with_set_measures(weighed).select(
        *prepared.columns,
        *NUMERIC_FEATURES,
        F.concat(
            F.transform(different, lambda x: x["idx"]),
            F.transform(shared, lambda x: x["idx"] + size),
            places,
        ).alias("indices"),
        F.concat(
            F.transform(different, lambda x: x["difference"]),
            F.transform(shared, lambda x: x["product"]),
            numbers,
        ).alias("values"),
    )


def written_vocabulary(texts: DataFrame, prepared_col: str, size: int = VOCABULARY_SIZE) -> DataFrame:
    """The fitted vocabulary as a written table, for repeated use."""
    return written(fit_vocabulary(texts, prepared_col, size), "vocabulary")
