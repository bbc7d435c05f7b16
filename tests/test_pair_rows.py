from docsim.operators.pair_rows import extract_pairs

WORDS = " ".join(f"w{k}" for k in range(1, 14))
CELLS = [
    ("uno dos\ttres cuatro\t1", None, ("uno dos", "tres cuatro", 1)),
    ("uno dos\t\ttres cuatro\tx", None, ("uno dos", "tres cuatro", None)),
    ("uno\tdos", "0", ("uno", "dos", 0)),
    ("uno\tdos\t1", "0", ("uno", "dos", 1)),
    ("Sentence 1: uno Sentence 2: dos label: 1", None, ("uno", "dos", 1)),
    ("sentence1=uno\nmas sentence2 = dos", None, ("uno mas", "dos", None)),
    ("TEXT1: a b text2: c label=0", None, ("a b", "c", 0)),
    ("original: p q suspicious: r s", None, ("p q", "r s", None)),
    ("linea uno\n\nlinea dos\nlinea tres", None, ("linea uno", "linea dos", None)),
    ("uno dos", None, ("uno", "dos", None)),
    (WORDS, None, ("w1 w2 w3 w4 w5 w6", "w7 w8 w9 w10 w11 w12 w13", None)),
    ("corta", None, ("", "", None)),
    (None, "1", ("", "", 1)),
    ("a\tb\t 1_0 ", None, ("a", "b", 10)),
    ("a\tb\t1.0", "1", ("a", "b", 1)),
]


def test_cells(spark):
    rows = spark.createDataFrame(
        [(k, text, label) for k, (text, label, _) in enumerate(CELLS)], "k int, text string, label string"
    )
    got = [tuple(r)[1:] for r in extract_pairs(rows, ("k",)).orderBy("k").collect()]
    assert got == [expected for _, _, expected in CELLS]


def test_named_columns(spark):
    schema = "premise string, sentence2 string, target string, labels string, text string"
    rows = spark.createDataFrame(
        [("p", None, "t", " 1 ", None), ("p", "", "t", "0", None), ("a b", None, None, None, None)], schema
    )
    got = [tuple(r) for r in extract_pairs(rows).collect()]
    # an empty alias still wins over later ones, and one side alone is not enough
    assert got == [("p", "t", 1), ("", "", 0), ("", "", None)]


def test_label_types(spark):
    rows = spark.createDataFrame([("a", "b", 1.7, "0"), ("a", "b", None, "0")], "text1 string, text2 string, label double, labels string")
    assert [r["label"] for r in extract_pairs(rows).collect()] == [1, 0]
    rows = spark.createDataFrame([("a", "b", "1.0"), ("a", "b", "+1")], "text1 string, text2 string, label string")
    assert [r["label"] for r in extract_pairs(rows).collect()] == [None, 1]
