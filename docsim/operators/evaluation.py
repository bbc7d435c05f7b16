"""Quality of a score threshold or of a classifier against labels.

Everything is derived from four counts (or one small histogram), so the table is read once and
only a handful of numbers is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsim.functions.rounding import round_even
from docsim.functions.rows import head_rows
from docsim.functions.similarity import pair_cosine
from docsim.operators.pairs import (
    MIN_PAIR_WORDS, evaluable, long_enough_overlap, overlap_scores, usable_label, with_prepared,
    with_raw_overlap, with_scores,
)

# Default threshold, sweep, list lengths, class names and messages.
DEFAULT_THRESHOLD = 0.45
SWEEP_START, SWEEP_END, SWEEP_STEP = 0.10, 0.60, 0.01
EXAMPLE_ROWS = 10
# Rows that are looked at first for the examples.
WINDOW_ROWS = 40
TOP_THRESHOLDS = 10
CLASS_NAMES = ("No plagio", "Plagio")
DONE = "Evaluación completada correctamente"
NOTHING_TO_EVALUATE = "No se pudieron evaluar ejemplos válidos."


def confusion_counts(label: Column, prediction: Column, weight: Column | None = None) -> list[Column]:
    """The four cells of the confusion matrix as aggregates; ``weight`` counts a row many times."""

    def cell(y: int, p: int) -> Column:
        hit = (label == y) & (prediction == p)
        if weight is None:
            return F.count_if(hit)
        return F.coalesce(F.sum(F.when(hit, weight)), F.lit(0)).cast("bigint")

    return [
        cell(0, 0).alias("true_negative"),
        cell(0, 1).alias("false_positive"),
        cell(1, 0).alias("false_negative"),
        cell(1, 1).alias("true_positive"),
    ]


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def with_class_metrics(counts: DataFrame) -> DataFrame:
    """Add accuracy and, per class 0 and 1, precision, recall, F1 and support; 0/0 counts as 0."""
    tn, fp = F.col("true_negative"), F.col("false_positive")
    fn, tp = F.col("false_negative"), F.col("true_positive")
    return counts.withColumns(
        {
            "evaluated_count": tn + fp + fn + tp,
            "accuracy": _ratio(tn + tp, tn + fp + fn + tp),
            "precision_0": _ratio(tn, tn + fn),
            "recall_0": _ratio(tn, tn + fp),
            "f1_0": _ratio(tn * 2, tn * 2 + fn + fp),
            "support_0": tn + fp,
            "precision_1": _ratio(tp, tp + fp),
            "recall_1": _ratio(tp, tp + fn),
            "f1_1": _ratio(tp * 2, tp * 2 + fp + fn),
            "support_1": fn + tp,
        }
    )


def rounded_class(number: int) -> Column:
    """Metrics of one class, rounded to four digits."""
    return F.struct(
        F.lit(number).alias("label"),
        *[
            round_even(F.col(f"{name}_{number}"), 4).alias(alias)
            for name, alias in (("precision", "precision"), ("recall", "recall"), ("f1", "f1_score"))
        ],
        F.col(f"support_{number}").alias("support"),
    )


def classification_report(counts: DataFrame) -> DataFrame:
    """Rows of the usual report: both classes, accuracy, macro and weighted averages."""
    measured = with_class_metrics(counts)
    total = F.col("support_0") + F.col("support_1")

    def averaged(name: str, weighted: bool) -> Column:
        zero, one = F.col(f"{name}_0"), F.col(f"{name}_1")
        if not weighted:
            return (zero + one) / 2
        return _ratio(zero * F.col("support_0") + one * F.col("support_1"), total)

    def row(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("name"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1_score"),
            support.cast("bigint").alias("support"),
        )

    names = ("precision", "recall", "f1")
    rows = [
        row(CLASS_NAMES[k], *[F.col(f"{name}_{k}") for name in names], F.col(f"support_{k}"))
        for k in (0, 1)
    ]
    rows.append(row("accuracy", *[F.col("accuracy")] * 3, total))
    rows.append(row("macro avg", *[averaged(name, False) for name in names], total))
    rows.append(row("weighted avg", *[averaged(name, True) for name in names], total))
    return measured.select(F.inline(F.array(*rows)))


def scored_examples(pairs: DataFrame) -> DataFrame:
    """Usable pairs with their scores; prepared texts are not kept."""
    return overlap_scores(with_raw_overlap(pairs.where(usable_label())), min_words=MIN_PAIR_WORDS)


def evaluation_counts(pairs: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """One row: the confusion matrix at the threshold and the number of skipped rows.

    One pass over the pairs, so evaluated and skipped rows come from the same read.
    """
    overlapped = with_raw_overlap(pairs).select("label", "overlap")
    used = F.when(usable_label() & long_enough_overlap(), F.col("label"))
    score = round_even(pair_cosine(F.col("overlap")), 4)
    judged = overlapped.select(
        used.alias("used_label"), (score >= threshold).cast("int").alias("prediction")
    )
    return judged.agg(
        *confusion_counts(F.col("used_label"), F.col("prediction")),
        F.count_if(F.col("used_label").isNull()).alias("skipped_rows"),
    )


def evaluate_threshold(
    pairs: DataFrame,
    threshold: float = DEFAULT_THRESHOLD,
    limit: int | None = None,
    dataset_name: str = "",
    index_col: str = "row_idx",
) -> DataFrame:
    """One row with the whole evaluation; metrics are null when nothing could be evaluated.

    With ``limit``, only the first rows by ``index_col`` are read.
    """
    pairs = head_rows(pairs, limit, index_col) if limit is not None else pairs
    measured = with_class_metrics(evaluation_counts(pairs, threshold))
    some = F.col("evaluated_count") > 0
    return measured.select(
        F.when(some, F.lit(DONE)).otherwise(F.lit(NOTHING_TO_EVALUATE)).alias("message"),
        F.lit(dataset_name).alias("dataset_name"),
        F.lit(limit).cast("bigint").alias("limit_requested"),
        "evaluated_count",
        "skipped_rows",
        F.lit(threshold).alias("threshold"),
        F.lit(threshold * 100).alias("threshold_percentage"),
        F.when(some, round_even(F.col("accuracy"), 4)).alias("accuracy"),
        F.when(some, round_even(F.col("accuracy") * 100, 2)).alias("accuracy_percentage"),
        F.when(
            some, F.struct(rounded_class(0).alias("no_plagio"), rounded_class(1).alias("plagio"))
        ).alias("classes"),
        F.when(
            some, F.struct("true_negative", "false_positive", "false_negative", "true_positive")
        ).alias("confusion_matrix"),
    )


def evaluation_examples(
    pairs: DataFrame, threshold: float = DEFAULT_THRESHOLD, index_col: str = "row_idx"
) -> DataFrame:
    """The first ten evaluated rows, in row order, with prediction and status.

    Rows are prepared window by window, each four times as long as the last, until ten are usable; the filter
    on the index reaches the scan.
    """
    last = pairs.agg(F.max(index_col)).first()[0]
    limit = WINDOW_ROWS
    while True:
        usable = evaluable(with_prepared(head_rows(pairs, limit, index_col)))
        if last is None or limit > last or usable.limit(EXAMPLE_ROWS).count() == EXAMPLE_ROWS:
            break
        limit *= 4
    first = usable.orderBy(index_col).limit(EXAMPLE_ROWS)
    return with_scores(first).select(
        (F.col(index_col) + 1).cast("bigint").alias("row"),
        "text_a",
        "text_b",
        F.col("label").alias("expected_label"),
        (F.col("similarity_score") >= threshold).cast("int").alias("predicted_label"),
        "similarity_percentage",
        "status",
    )


def sweep_values(
    start: float = SWEEP_START, end: float = SWEEP_END, step: float = SWEEP_STEP
) -> list[tuple[float, float]]:
    """Thresholds and percentages of a sweep: whole hundredths from ``start`` on, without ``end``.

    Start, end and step must be whole hundredths between 0 and 1, the step at least one.
    """
    first, last, by = (round(100 * value) for value in (start, end, step))
    if any(abs(100 * value - whole) > 1e-6 for value, whole in ((start, first), (end, last), (step, by))):
        raise ValueError("start, end and step must be whole hundredths")
    if by < 1 or not 0 <= first <= last <= 100:
        raise ValueError("start and end must lie between 0 and 1, in this order, and step must be 0.01 or more")
    return [(percent / 100, float(percent)) for percent in range(first, last, by)]


def sweep_thresholds(
    pairs: DataFrame,
    start: float = SWEEP_START,
    end: float = SWEEP_END,
    step: float = SWEEP_STEP,
    limit: int | None = None,
    index_col: str = "row_idx",
) -> DataFrame:
    """One row of metrics per threshold; with ``limit``, of the first rows by ``index_col``.

    Pairs are scored once and counted by score and label: scores have four digits, so at most
    20,002 rows remain, and only these meet the thresholds.
    """
    pairs = head_rows(pairs, limit, index_col) if limit is not None else pairs
    histogram = (
        scored_examples(pairs)
        .groupBy("similarity_score", "label")
        .agg(F.count(F.lit(1)).alias("pairs"))
    )
    thresholds = F.array(
        *[
            F.struct(F.lit(value).alias("threshold"), F.lit(percent).alias("threshold_percentage"))
            for value, percent in sweep_values(start, end, step)
        ]
    )
    counted = (
        histogram.select("similarity_score", "label", "pairs", F.inline(thresholds))
        .groupBy("threshold", "threshold_percentage")
        .agg(
            *confusion_counts(
                F.col("label"),
                (F.col("similarity_score") >= F.col("threshold")).cast("int"),
                F.col("pairs"),
            )
        )
    )

    def percent(name: str) -> Column:
        return round_even(round_even(F.col(name), 4) * 100, 2)

    return with_class_metrics(counted).select(
        "threshold",
        "threshold_percentage",
        round_even(F.col("accuracy") * 100, 2).alias("accuracy_percentage"),
        percent("precision_1").alias("plagio_precision"),
        percent("recall_1").alias("plagio_recall"),
        percent("f1_1").alias("plagio_f1"),
        percent("f1_0").alias("no_plagio_f1"),
    )


def best_thresholds(sweep: DataFrame) -> DataFrame:
    """Two rows: best by accuracy and best by F1 of the positive class; the lowest wins a tie."""
    whole = F.struct(*sweep.columns)

    def best(criterion: str, metric: str) -> Column:
        order = F.struct(F.col(metric), -F.col("threshold"))
        return F.max_by(whole, order).alias(criterion)

    picked = sweep.agg(best("accuracy", "accuracy_percentage"), best("plagio_f1", "plagio_f1"))
    rows = F.array(
        *[
            F.struct(
                F.lit(criterion).alias("criterion"),
                *[F.col(f"{criterion}.{name}").alias(name) for name in sweep.columns],
            )
            for criterion in ("accuracy", "plagio_f1")
        ]
    )
    return picked.where(F.col("accuracy").isNotNull()).select(F.inline(rows))


def top_thresholds(sweep: DataFrame, n: int = TOP_THRESHOLDS) -> DataFrame:
    """The thresholds of the highest accuracy; the lower one first in a tie."""
    return sweep.orderBy(F.desc("accuracy_percentage"), "threshold").limit(n)
