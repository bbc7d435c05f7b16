"""Labelled pair rows of several layouts -> ``text_a, text_b, label``.

A source may name its two texts in different ways, or hold everything in one ``text`` cell:
tab-separated, with keys, on two lines, or as one long line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from docsim.functions.text import SPACE_CLASS, bind, collapse_spaces, strip_spaces

# Accepted column names, in order of preference.
FIRST_TEXT_COLUMNS = ("sentence1", "text1", "premise", "source", "original")
SECOND_TEXT_COLUMNS = ("sentence2", "text2", "hypothesis", "target", "suspicious")

# Fixed value: least number of words of a cell that is cut into halves.
MIN_WORDS_TO_HALVE = 12

_WS = rf"[{SPACE_CLASS}]*"
_FLAGS = "(?ius)"
_LABEL_MARK = rf"label{_WS}[:=]{_WS}"
_LABEL_TAIL = rf"(?:{_WS}{_LABEL_MARK}[01])?$"

# The keyed layouts, in the order in which they are tried.
KEY_PAIRS = (
    ("sentence1", "sentence2"),
    (rf"sentence{_WS}1", rf"sentence{_WS}2"),
    ("text1", "text2"),
    ("original", "suspicious"),
)
KEYED_PATTERNS = tuple(
    rf"{_FLAGS}{first}{_WS}[:=]{_WS}(.*?){_WS}{second}{_WS}[:=]{_WS}(.*?){_LABEL_TAIL}"
    for first, second in KEY_PAIRS
)

# Marks removed from an extracted text, in order.
MARKS = (
    rf"{_LABEL_MARK}[01]",
    rf"sentence{_WS}1{_WS}[:=]",
    rf"sentence{_WS}2{_WS}[:=]",
    rf"text1{_WS}[:=]",
    rf"text2{_WS}[:=]",
)
LINE_BREAKS = r"\r\n|[\n\x0b\f\r\x1c-\x1e\x85\x{2028}\x{2029}]"

PAIR_TYPE = "struct<text_a:string,text_b:string,label:int>"


def parse_integer(value: Column, data_type: Ty.DataType = Ty.StringType()) -> Column:
    """Integer or null: text with spaces around, a sign and single underscores is accepted."""
    if isinstance(data_type, Ty.StringType):
        value = F.regexp_replace(strip_spaces(value), r"(?<=\d)_(?=\d)", "")
    return value.try_cast("int")


def label_in_text(text: Column) -> Column:
    """0 or 1 after the first ``label:`` or ``label=`` mark, else null."""
    digit = F.regexp_extract(text, rf"{_FLAGS}{_LABEL_MARK}([01])", 1)
    return F.nullif(digit, F.lit("")).try_cast("int")


def clean_marks(text: Column) -> Column:
    """Remove label, sentence and text marks; collapse and trim white space."""
    for mark in MARKS:
        text = F.regexp_replace(text, f"{_FLAGS}{mark}", " ")
    return collapse_spaces(text)


def _pair(text_a: Column, text_b: Column, label: Column) -> Column:
    return F.struct(
        text_a.alias("text_a"), text_b.alias("text_b"), label.cast("int").alias("label")
    )


def parse_cell(text: Column) -> Column:
    """One text cell -> ``struct<text_a, text_b, label>``; two empty texts when nothing fits."""
    nothing = F.lit(None)

    def parse(cell: Column) -> Column:
        label = label_in_text(cell)
        whole = F.lit(0)
        parts = F.filter(F.transform(F.split(cell, "\t"), strip_spaces), lambda part: part != "")
        lines = F.filter(F.transform(F.split(cell, LINE_BREAKS), clean_marks), lambda x: x != "")
        words = F.split(cell, rf"[{SPACE_CLASS}]+")

        def halves(word: Column) -> Column:
            middle = F.floor(F.size(word) / 2).cast("int")
            first = F.array_join(F.slice(word, F.lit(1), middle), " ")
            second = F.array_join(F.slice(word, middle + 1, F.size(word)), " ")
            return F.when(
                F.size(word) >= MIN_WORDS_TO_HALVE, _pair(first, second, label)
            ).otherwise(_pair(F.lit(""), F.lit(""), label))

        def by_lines(line: Column) -> Column:
            return F.when(
                F.size(line) >= 2, _pair(F.get(line, F.lit(0)), F.get(line, F.lit(1)), label)
            ).otherwise(bind(words, halves))

        keyed = F.when(F.lit(False), _pair(F.lit(""), F.lit(""), nothing))
        for pattern in KEYED_PATTERNS:
            keyed = keyed.when(
                F.regexp_extract(cell, pattern, 0) != "",
                _pair(
                    clean_marks(F.regexp_extract(cell, pattern, 1)),
                    clean_marks(F.regexp_extract(cell, pattern, 2)),
                    label,
                ),
            )
        without_tabs = keyed.otherwise(bind(lines, by_lines))

        def by_tabs(part: Column) -> Column:
            first, second, third = (F.get(part, whole + i) for i in range(3))
            return (
                F.when(F.size(part) >= 3, _pair(first, second, parse_integer(third)))
                .when(F.size(part) == 2, _pair(first, second, nothing))
                .otherwise(without_tabs)
            )

        return bind(parts, by_tabs)

    return bind(strip_spaces(F.coalesce(text, F.lit(""))), parse)


def first_present(rows: DataFrame, names: tuple[str, ...]) -> Column:
    """First non-null column among ``names`` as text; empty text when there is none."""
    present = [F.col(name).cast("string") for name in names if name in rows.columns]
    return F.coalesce(*present, F.lit(""))


def row_label(rows: DataFrame) -> Column:
    """``label``, else ``labels``, as an integer or null."""
    types = {field.name: field.dataType for field in rows.schema.fields}
    no_label = F.lit(None).cast("int")
    label = parse_integer(F.col("label"), types["label"]) if "label" in types else no_label
    labels = parse_integer(F.col("labels"), types["labels"]) if "labels" in types else no_label
    if "label" not in types:
        return labels
    return F.when(F.col("label").isNull(), labels).otherwise(label)


def extract_pairs(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of any accepted layout -> ``keep`` columns plus ``text_a, text_b, label``.

    Named columns count only when both texts are there; otherwise the ``text`` cell is parsed
    and its label, when it has one, replaces the column label.
    """
    named = rows.select(
        *keep,
        first_present(rows, FIRST_TEXT_COLUMNS).alias("first_text"),
        first_present(rows, SECOND_TEXT_COLUMNS).alias("second_text"),
        row_label(rows).alias("column_label"),
        (F.col("text").cast("string") if "text" in rows.columns else F.lit("")).alias("cell"),
    )
    both = (F.col("first_text") != "") & (F.col("second_text") != "")
    pair = F.when(
        both, _pair(F.col("first_text"), F.col("second_text"), F.col("column_label"))
    ).otherwise(
        bind(
            parse_cell(F.col("cell")),
            lambda parsed: _pair(
                parsed["text_a"],
                parsed["text_b"],
                F.coalesce(parsed["label"], F.col("column_label")),
            ),
        )
    )
    return named.select(*keep, pair.alias("pair")).select(*keep, "pair.*")
