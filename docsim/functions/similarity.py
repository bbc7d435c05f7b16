"""Similarity column functions over two token arrays of the same row."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from docsim.functions.rounding import round_even
from docsim.functions.text import bind

# Bands, thresholds and texts.
PLAGIARISM_THRESHOLD = 0.70
SUSPICIOUS_THRESHOLD = 0.40
STATUS_PLAGIARISM = "Plagio"
STATUS_SUSPICIOUS = "Similitud sospechosa"
STATUS_LOW = "Similitud baja"
STATUS_NO_TEXT = "Texto insuficiente"
MEANING_POSITIVE = "Par positivo según dataset"
MEANING_NEGATIVE = "Par negativo según dataset"
NO_LABEL = "Sin etiqueta"
DISPLAY_POSITIVE = "Plagio"
DISPLAY_NEGATIVE = "No plagio"

# Smooth idf over two texts: a shared term weighs 1, an unshared one ln(3/2) + 1.
UNSHARED_IDF_SQUARED = (math.log(3.0 / 2.0) + 1.0) ** 2


def term_bag(tokens: Column) -> Column:
    """``array<struct<term, tf>>`` sorted by term, from a token array of the same row.

    Sorting and cutting at the changes of value keeps the counting inside the row, so no
    shuffle is needed to get term frequencies.
    """
    empty = F.array().cast("array<struct<term:string,tf:int>>")

    def cut(words: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(words) - 1),
            lambda i: (i == 0) | (F.get(words, i) != F.get(words, i - 1)),
        )
        return bind(
            starts,
            lambda start: F.transform(
                start,
                lambda i, n: F.struct(
                    F.get(words, i).alias("term"),
                    (F.coalesce(F.get(start, n + 1), F.size(words)) - i).alias("tf"),
                ),
            ),
        )

    return bind(
        F.sort_array(tokens), lambda words: F.when(F.size(words) > 0, cut(words)).otherwise(empty)
    )


def bag_mass(bag: Column) -> Column:
    """Sum of the squared term frequencies of a bag."""
    return F.aggregate(bag, F.lit(0).cast("bigint"), lambda total, x: total + x["tf"].cast("bigint") * x["tf"])


def cosine_from_sums(
    dot: Column, shared_a: Column, shared_b: Column, total_a: Column, total_b: Column
) -> Column:
    """TF-IDF cosine of two texts when the idf is fitted on just these two texts.

    Exact integers go in; the closed form replaces fitting a vectoriser per pair.
    """
    k2 = F.lit(UNSHARED_IDF_SQUARED)
    norm_a = F.sqrt(shared_a + k2 * (total_a - shared_a))
    norm_b = F.sqrt(shared_b + k2 * (total_b - shared_b))
    return F.when(dot > 0, F.least(F.lit(1.0), dot / (norm_a * norm_b))).otherwise(F.lit(0.0))


def pair_cosine(sums: Column) -> Column:
    """The cosine of a struct made by ``overlap_sums``."""
    return cosine_from_sums(
        sums["dot"], sums["shared_a"], sums["shared_b"], sums["total_a"], sums["total_b"]
    )


def similarity_status(
    score: Column,
    has_text: Column | None = None,
    plagiarism: float = PLAGIARISM_THRESHOLD,
    suspicious: float = SUSPICIOUS_THRESHOLD,
) -> Column:
    """Band of the unrounded score; without text on either side a band of its own."""
    band = (
        F.when(score >= plagiarism, F.lit(STATUS_PLAGIARISM))
        .when(score >= suspicious, F.lit(STATUS_SUSPICIOUS))
        .otherwise(F.lit(STATUS_LOW))
    )
    if has_text is None:
        return band
    return F.when(~has_text, F.lit(STATUS_NO_TEXT)).otherwise(band)


def score_columns(
    score: Column,
    has_text: Column,
    plagiarism: float = PLAGIARISM_THRESHOLD,
    suspicious: float = SUSPICIOUS_THRESHOLD,
) -> list[Column]:
    """The five output columns of a comparison."""
    distance = F.lit(1.0) - score
    return [
        round_even(score, 4).alias("similarity_score"),
        round_even(score * 100, 2).alias("similarity_percentage"),
        round_even(distance, 4).alias("cosine_distance"),
        round_even(distance * 100, 2).alias("distance_percentage"),
        similarity_status(score, has_text, plagiarism, suspicious).alias("status"),
    ]


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def jaccard(tokens_a: Column, tokens_b: Column) -> Column:
    """Shared distinct tokens over all distinct tokens; 0 when either side is empty."""
    either_empty = (F.size(tokens_a) == 0) | (F.size(tokens_b) == 0)
    return F.when(either_empty, F.lit(0.0)).otherwise(
        _ratio(F.size(F.array_intersect(tokens_a, tokens_b)), F.size(F.array_union(tokens_a, tokens_b)))
    )


def containment(tokens_a: Column, tokens_b: Column) -> Column:
    """Shared distinct tokens over the smaller set of distinct tokens."""
    return _ratio(
        F.size(F.array_intersect(tokens_a, tokens_b)),
        F.least(F.size(F.array_distinct(tokens_a)), F.size(F.array_distinct(tokens_b))),
    )


def length_ratio(tokens_a: Column, tokens_b: Column) -> Column:
    """Shorter token list over the longer one, repeats counted."""
    return _ratio(
        F.least(F.size(tokens_a), F.size(tokens_b)), F.greatest(F.size(tokens_a), F.size(tokens_b))
    )


def jaccard_from_sums(sums: Column) -> Column:
    """Same value as :func:`jaccard`, from the sums of ``overlap_sums``."""
    either_empty = (sums["distinct_a"] == 0) | (sums["distinct_b"] == 0)
    return F.when(either_empty, F.lit(0.0)).otherwise(
        _ratio(sums["common"], sums["distinct_a"] + sums["distinct_b"] - sums["common"])
    )


def containment_from_sums(sums: Column) -> Column:
    """Same value as :func:`containment`, from the sums of ``overlap_sums``."""
    return _ratio(sums["common"], F.least(sums["distinct_a"], sums["distinct_b"]))


def length_ratio_from_sums(sums: Column) -> Column:
    """Same value as :func:`length_ratio`, from the sums of ``overlap_sums``."""
    return _ratio(
        F.least(sums["length_a"], sums["length_b"]), F.greatest(sums["length_a"], sums["length_b"])
    )


def label_meaning(label: Column) -> Column:
    """What a dataset label says about its pair."""
    return (
        F.when(label == 1, F.lit(MEANING_POSITIVE))
        .when(label == 0, F.lit(MEANING_NEGATIVE))
        .otherwise(F.lit(NO_LABEL))
    )


def label_display(label: Column) -> Column:
    """Short label text of the result table."""
    return (
        F.when(label == 1, F.lit(DISPLAY_POSITIVE))
        .when(label == 0, F.lit(DISPLAY_NEGATIVE))
        .otherwise(F.lit(NO_LABEL))
    )


def matches_label(
    similarity_score: Column, label: Column, threshold: float = PLAGIARISM_THRESHOLD
) -> Column:
    """Whether the rounded score at the threshold predicts the label; null without a label."""
    return F.when(label.isNotNull(), (similarity_score >= threshold).cast("int") == label)
