import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from docsim.functions import content_words as C
from docsim.functions import text as T


def plain_words(text):
    words = "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in text).split()
    return " ".join(w for w in words if len(w) >= 3 and w not in T.STOPWORDS)


def test_words_of_whole_batches_are_those_of_each_text():
    rng = random.Random(5)
    pieces = [*T.STOPWORDS, "thesis", "antes", "documento", "12345678", "withoutx", "é", "한", " ", "  ", "-", "\n", "ab", "x", ""]
    texts = ["".join(rng.choice(pieces) + rng.choice(["", " ", "."]) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    texts += ["the", "", "abc", "def", "ab", "c", " ", "without", "withouts"]
    dropped = C.packed(T.STOPWORDS)
    wanted = [plain_words(t) for t in texts]
    assert C.content_words(pa.array(texts), dropped, 3).to_pylist() == wanted
    assert C.content_words(pa.array(texts).slice(7, 50), dropped, 3).to_pylist() == wanted[7:57]
    assert C.content_words(pa.array([], pa.string()), dropped, 3).to_pylist() == []
    assert C.content_words(pa.array(["", "-"]), dropped, 3).to_pylist() == ["", ""]
    assert C.content_words(pa.array(["abc de"]), np.zeros(0, np.uint64), 1).to_pylist() == ["abc de"]


def test_texts_are_prepared_without_a_lambda_per_word(spark):
    df = spark.createDataFrame([("Él the árbol",)], "text string")
    plan = df.select(T.prepare_text(df["text"]).alias("p"))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "filter(" not in plan


def test_texts_are_prepared_from_raw_ones_as_by_columns(spark):
    marks = ["http", "www", "HTTP", "w\u0301ww", "ht\u0301tp://", " ", "\u00a0", "\x85", "\x1c", "\t", "\u2028", "\ufeff", "\x00", ".", "é", "\u0130", "ß", "K", "\u0345", "abc", "the", "x", "\U0001d165", "😀", "ﬁ"]
    rng = random.Random(8)
    texts = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 14))) for _ in range(2000)] + [None, "", "www", "http", "abchttpx yes"]
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    # every code point inside a word, at its edges and inside a link
    texts += [" ".join(f"qq{chr(c)}zz9 www{chr(c)}yyy {chr(c)}" for c in points[k : k + 400]) for k in range(0, len(points), 400)]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, v string").repartition(8)
    wrong = rows.select("k", T.prepare_text(F.col("v")).alias("p"), F.array_join(T.content_tokens(F.col("v")), " ").alias("w"))
    assert wrong.where("p <> w OR p IS NULL").collect() == []


def test_broken_characters_become_signs(spark):
    row = spark.sql("SELECT 1").select(F.expr("cast(X'616263FF646566E9' as string)").alias("v"))
    assert row.select(T.prepare_text(F.col("v"))).first()[0] == "abc def"


def test_lower_case_and_accents_are_not_taken_text_by_text(spark):
    df = spark.createDataFrame([("Él the árbol",)], "text string")
    plan = df.select(T.prepare_text(df["text"]).alias("p"))._jdf.queryExecution().executedPlan().toString()
    assert "lower(" not in plan and "translate(" not in plan


def test_languages_are_those_of_lower_cased_parts(spark):
    rng = random.Random(3)
    parts = [*T.SPANISH_MARKERS, *T.ENGLISH_MARKERS, "The", "PARA", "the,", "la\n", "\u0130t", "é", "x", ""]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randint(0, 6))) for _ in range(2000)] + [None]

    def wanted(text):
        found = {w for w in (text or "").lower().split(" ")}
        spanish, english = len(found & set(T.SPANISH_MARKERS)), len(found & set(T.ENGLISH_MARKERS))
        return "spanish" if spanish > english else "english" if english > spanish else "unknown"

    df = spark.createDataFrame([(t,) for t in texts], "v string").select("v", T.detect_language(F.col("v")).alias("l"))
    assert all(r["l"] == wanted(r["v"]) for r in df.collect())
    assert "lower(" not in df._jdf.queryExecution().executedPlan().toString()
