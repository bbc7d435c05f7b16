import pytest
from plain import prepare
from pyspark.sql import functions as F

from docsim.functions import text as T
from docsim.functions.rounding import round_even

NORMALISED = [
    ("Ñandú año http://x.com/a b wwwfoo. xhttpz q", "nandu ano b x q"),
    ("Café İstanbul Kelvin ß œuvre", "cafe istanbul kelvin uvre"),
    ("http a b", "http a b"),
    ("ẛ̣ ﬁne ①", "ne"),
    ("WWW.A.b c", "c"),
    ("한글 abc", "abc"),
    (" \t\n", ""),
    (None, ""),
    ("", ""),
]


def column(spark, values, expression):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string")
    return [r[0] for r in rows.orderBy("k").select(expression(F.col("v"))).collect()]


def test_normalize(spark):
    got = column(spark, [a for a, _ in NORMALISED], T.normalize_text)
    assert got == [b for _, b in NORMALISED]


def test_prepare_matches_plain_python_on_documents(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "text", T.prepare_text(F.col("text")).alias("p"), T.word_count(T.prepare_text(F.col("text"))).alias("n")
    )
    for row in rows.collect():
        assert row["p"] == prepare(row["text"])
        assert row["n"] == len(row["p"].split())


def test_stopwords_and_short_words(spark):
    assert len(set(T.STOPWORDS)) == 91
    assert column(spark, ["El sistema de la casa y THE house ab"], T.prepare_text) == ["sistema casa house"]


def test_language(spark):
    # a word that touches punctuation does not count, and a repeated one counts once
    texts = ["el sistema para la", "the system and for", "la the", "la, the", "el el el the and", None]
    assert column(spark, texts, T.detect_language) == [
        "spanish", "english", "unknown", "english", "english", "unknown",
    ]


def test_names_lengths_and_previews(spark):
    assert column(spark, ["a b.PDF", "a.txt"], T.is_pdf_name) == [True, False]
    assert column(spark, ["a b c.pdf"], T.safe_filename) == ["a_b_c.pdf"]
    assert column(spark, ["añb", None], T.text_length) == [3, 0]
    assert column(spark, ["abcdef", None], lambda c: T.preview(c, 4)) == ["abcd", ""]
    assert column(spark, ["  \n", "x", None, ""], T.is_blank) == [True, False, True, True]
    assert column(spark, ["uno dos tres cuatro cinco seis siete ocho nueve diez once",
                          "alfa beta gama delta eta zeta iota kapa lambda omega"], T.is_valid_document) == [True, True]


@pytest.mark.parametrize("digits", [2, 4])
def test_round_even_equals_python_round(spark, digits):
    values = [0.03125, 0.09375, 0.15625, 0.00015, 0.72515, 1.0, 0.0, 2.675, 0.125, 0.375, 33.335]
    values += [k / 997 for k in range(997)] + [k / 160 for k in range(160)] + [100 * k / 640 for k in range(640)]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    for row in rows.select("v", round_even(F.col("v"), digits).alias("r")).collect():
        assert row["r"] == round(row["v"], digits)
