import io
import random
from contextlib import redirect_stdout

import numpy as np
import pyarrow as pa
import pytest
from plain import cosine

from docsim.functions import overlap as O
from docsim.operators import all_pairs as A
from docsim.operators import block_products as B
from docsim.operators import near_classes as N


@pytest.mark.parametrize("dense, share, many", [(2048, 800, 16), (2, 800, 1), (0, 800, 10**9), (2048, 10**9, 1)])
def test_products_are_exact_whatever_is_dense(spark, monkeypatch, dense, share, many):
    for name, value in (("DENSE_TERMS", dense), ("DENSE_SHARE", share), ("MANY_LEFT", many), ("STRIPE", 3), ("MEETS", 50)):
        monkeypatch.setattr(B, name, value)
    rng = random.Random(5)
    texts = [" ".join(rng.choices("abc abd abe abf abg xyz uvw".split(), k=rng.randint(1, 9))) for _ in range(30)]
    texts = list(dict.fromkeys(" ".join(sorted(t.split())) for t in texts))
    texts.append(" ".join(["abc"] * 5000 + ["xyz"]))  # more than single floats hold

    def block(lo, hi):
        bags = []
        for k in range(lo, hi):
            words, tf = np.unique(texts[k].split(), return_counts=True)
            keys = np.array([sum(ord(c) << (8 * n) for n, c in enumerate(w)) for w in words], np.int64)
            bags.append((keys, tf, int((tf * tf).sum())))
        terms, cols = np.unique(np.concatenate([b[0] for b in bags]), return_inverse=True)
        rows = np.repeat(np.arange(hi - lo), [len(b[0]) for b in bags])
        totals = np.array([b[2] for b in bags])
        return B.Block(np.arange(lo, hi), totals, np.ones(hi - lo, np.int64), rows, cols, np.concatenate([b[1] for b in bags]), terms)

    half, n = len(texts) // 2, len(texts)
    one, two = block(0, half), block(half, n)
    found = {}
    for x, y, same in ((one, one, True), (one, two, False), (two, two, True)):
        for batch in B.scored_pairs(x, y, same, 0.3):
            for r in batch.to_pylist():
                found[r["text_a"], r["text_b"]] = r["dot"]
    wanted = {(i, j) for i in range(n) for j in range(i + 1, n) if cosine(texts[i], texts[j]) >= 0.3}
    assert set(found) == wanted


def test_texts_do_not_meet_through_a_shuffle_of_terms(spark):
    rows = spark.createDataFrame([(k, f"common word{k} other{k % 3}") for k in range(40)], "id bigint, processed_text string")
    plan = io.StringIO()
    with redirect_stdout(plan):
        A.similar_texts(A.build_index(rows), 0.4).explain()
    assert "Window" not in plan.getvalue() and "SortMergeJoin" not in plan.getvalue()


def test_links_of_a_group_become_a_forest():
    ids = [f"n{k:03d}" for k in range(60)]
    links = pa.RecordBatch.from_pylist([{"a": a, "b": b} for a in ids[:40] for b in ids[:40] if a < b] + [{"a": "n059", "b": "n058"}])
    (out,) = N._forest(iter([links]))
    assert len(out) == 39 + 1
    assert {(r["a"], r["b"]) for r in out.to_pylist()} == {("n000", b) for b in ids[1:40]} | {("n058", "n059")}


def test_overlap_is_counted_in_slices(monkeypatch):
    seen = []
    whole = O.count_overlap
    monkeypatch.setattr(O, "count_overlap", lambda a, b: seen.append(len(a)) or whole(a, b))
    monkeypatch.setattr(O, "SLICE_CHARS", 100)
    texts = pa.array(["alpha beta gamma"] * 50 + [None, ""])
    out = O.overlap_sums.func(texts, texts)
    assert len(out) == 52 and max(seen) < 10
    assert out.field("dot").to_pylist() == [3] * 50 + [0, 0]
