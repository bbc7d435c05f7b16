"""Operators over tables of text pairs: preparing, filtering, scoring.

A pair table has ``text_a`` and ``text_b``; any other columns (an id, a label) pass through.
All work stays inside the row, so no operator here shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsim.functions import similarity as S
from docsim.functions import text as T
from docsim.functions.overlap import overlap_sums

# Fixed value: least number of prepared words on each side.
MIN_PAIR_WORDS = 2


def with_prepared(pairs: DataFrame, languages: bool = False) -> DataFrame:
    """Add ``processed_a``/``processed_b``, and ``language_a``/``language_b`` if asked.

    They come out of a generator, which Spark does not copy into the filters that read them: each text is
    prepared once, and sent to a worker once.
    """
    made = {"processed_a": T.prepare_text(F.col("text_a")), "processed_b": T.prepare_text(F.col("text_b"))}
    if languages:
        made |= {"language_a": T.detect_language(F.col("text_a")), "language_b": T.detect_language(F.col("text_b"))}
    kept = [c for c in pairs.columns if c not in made]
    return pairs.select(*kept, F.inline_outer(F.array(F.struct(*[value.alias(name) for name, value in made.items()]))))


def both_long_enough() -> Column:
    """Both prepared texts have two words or more. Blank texts have none, so they fail too."""
    return (T.word_count(F.col("processed_a")) >= MIN_PAIR_WORDS) & (
        T.word_count(F.col("processed_b")) >= MIN_PAIR_WORDS
    )


def long_enough_overlap(min_words: int = MIN_PAIR_WORDS) -> Column:
    """The same condition on the counts of the struct ``overlap``."""
    return (F.col("overlap.length_a") >= min_words) & (F.col("overlap.length_b") >= min_words)


def usable_label() -> Column:
    """The label is 0 or 1; null is not usable."""
    return F.coalesce(F.col("label").isin(0, 1), F.lit(False))


def ingestible(prepared: DataFrame) -> DataFrame:
    """Filter for loading pairs as documents: enough words, any label."""
    return prepared.where(both_long_enough())


def evaluable(prepared: DataFrame) -> DataFrame:
    """Filter for evaluation and for training: enough words and a usable label."""
    return prepared.where(usable_label() & both_long_enough())


def with_overlap(prepared: DataFrame, processed_a: str = "processed_a", processed_b: str = "processed_b") -> DataFrame:
    """Add the struct ``overlap`` of integer sums over two prepared texts."""
    return prepared.withColumn("overlap", overlap_sums(F.col(processed_a), F.col(processed_b)))


def with_raw_overlap(pairs: DataFrame) -> DataFrame:
    """Add the struct ``overlap`` of the prepared ``text_a`` and ``text_b``, which stay in the worker that makes them."""
    return pairs.withColumn("overlap", T.content_overlap(F.col("text_a"), F.col("text_b")))


def with_scores(
    prepared: DataFrame,
    processed_a: str = "processed_a",
    processed_b: str = "processed_b",
    plagiarism: float = S.PLAGIARISM_THRESHOLD,
    suspicious: float = S.SUSPICIOUS_THRESHOLD,
    min_words: int = 0,
) -> DataFrame:
    """Add score, percentage, distance and status columns for two prepared texts.

    With ``min_words``, pairs with fewer words on a side are left out. The overlap has counted
    the words, so preparing the texts is not repeated for the filter.
    """
    overlapped = with_overlap(prepared, processed_a, processed_b)
    return overlap_scores(overlapped, plagiarism, suspicious, min_words)


def overlap_scores(
    overlapped: DataFrame,
    plagiarism: float = S.PLAGIARISM_THRESHOLD,
    suspicious: float = S.SUSPICIOUS_THRESHOLD,
    min_words: int = 0,
) -> DataFrame:
    """Rows with the struct ``overlap``, with the columns of :func:`with_scores` in its place."""
    if min_words:
        overlapped = overlapped.where(long_enough_overlap(min_words))
    scored = overlapped.withColumn("raw_score", S.pair_cosine(F.col("overlap")))
    has_text = (F.col("overlap.length_a") > 0) & (F.col("overlap.length_b") > 0)
    return scored.select(
        *[c for c in overlapped.columns if c != "overlap"], *S.score_columns(F.col("raw_score"), has_text, plagiarism, suspicious)
    )


def compare_texts(pairs: DataFrame) -> DataFrame:
    """Direct comparison of supplied raw texts, with their lengths as given."""
    return with_scores(with_prepared(pairs)).withColumns(
        {
            "text_a_length": T.text_length(F.col("text_a")),
            "text_b_length": T.text_length(F.col("text_b")),
        }
    )


def with_set_measures(prepared: DataFrame) -> DataFrame:
    """Add Jaccard, containment and length ratio of the two prepared texts."""
    overlap = F.col("overlap")
    return with_overlap(prepared).withColumns(
        {
            "jaccard": S.jaccard_from_sums(overlap),
            "containment": S.containment_from_sums(overlap),
            "length_ratio": S.length_ratio_from_sums(overlap),
        }
    )
