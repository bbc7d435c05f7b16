import collections
import random

import pyarrow as pa
import pytest

from docsim.operators import features as X
from docsim.operators import frequent_terms as H
from docsim.operators import term_weights as W


def counted(texts):
    total, df = collections.Counter(), collections.Counter()
    for text in texts:
        words = [w for w in (text or "").split(" ") if w]
        terms = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
        total.update(terms)
        df.update(set(terms))
    return total, df


def zipf(rng, n_texts, words):
    return [" ".join(f"w{min(int(rng.paretovariate(0.9)), words)}" for _ in range(rng.randint(0, 60))) for _ in range(n_texts)]


def test_terms_of_texts():
    texts = ["b a b", None, "", "  a  ", "a b"]
    total, df = counted(texts)
    got = H.text_terms(pa.array(texts)).to_pylist()
    assert {(r["term"], r["total"], r["df"]) for r in got} == {(t, total[t], df[t]) for t in total}


def test_cut_counts_bound_what_they_take_off():
    rng = random.Random(1)
    for _ in range(200):
        counts = {f"t{k}": rng.randint(1, 20) for k in range(rng.randint(0, 40))}
        capacity = rng.randint(1, 20)
        table = pa.table({"term": pa.array(list(counts), pa.string()), "total": pa.array(list(counts.values()), pa.int64())})
        kept, off = H.cut_counts(table, capacity)
        got = dict(zip(kept["term"].to_pylist(), kept["total"].to_pylist()))
        assert len(got) <= capacity and off * (capacity + 1) <= sum(counts.values())
        assert all(got.get(t, 0) <= n <= got.get(t, 0) + off for t, n in counts.items())


@pytest.mark.parametrize("capacity", [5, 60, 400, 1 << 20])
def test_vocabulary_is_exact_at_every_capacity(spark, monkeypatch, capacity):
    monkeypatch.setattr(W, "CHUNK_CHARS", 500)
    texts = zipf(random.Random(7), 400, 300) + [None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "p string").repartition(6)
    total, df_counts = counted(texts)
    size = 40
    wanted = sorted(total, key=lambda t: (-total[t], t))[:size]
    got = X.fit_vocabulary(df, "p", size, capacity).collect()
    assert {(r["term"], r["total"], r["df"]) for r in got} == {(t, total[t], df_counts[t]) for t in wanted}


def test_a_tie_at_the_last_place_goes_by_the_alphabet(spark, monkeypatch):
    monkeypatch.setattr(W, "CHUNK_CHARS", 200)
    # 20 frequent words, then a tie of 30 words for the last 5 places, then many rare ones
    often = [f"often{k:02}" for k in range(20) for _ in range(40)]
    tied = [f"tie{k:02}" for k in range(30) for _ in range(20)]
    rare = [f"rare{k}" for k in range(1500)]
    words = often + tied + rare
    random.Random(3).shuffle(words)
    df = spark.createDataFrame([(w,) for w in words], "p string").repartition(4)
    summaries = H.term_summaries(df, "p", 200)
    assert summaries.where("slack > 0").count() > 0
    assert summaries.where("term IS NOT NULL").groupBy().count().first()[0] <= 4 * 2 * 200
    got = {r["term"] for r in X.fit_vocabulary(df, "p", 25, 200).collect()}
    assert got == {f"often{k:02}" for k in range(20)} | {f"tie{k:02}" for k in range(5)}


def test_only_candidates_are_counted_in_the_second_pass(spark, monkeypatch):
    monkeypatch.setattr(W, "CHUNK_CHARS", 200)
    words = [f"often{k:02}" for k in range(20) for _ in range(100)] + [f"rare{k}" for k in range(3000)]
    random.Random(3).shuffle(words)
    df = spark.createDataFrame([(w,) for w in words], "p string").repartition(4)
    asked = []

    def every_term():
        asked.append(True)
        return df.selectExpr("p AS term", "1 AS tf")

    got = H.frequent_terms(df, "p", 10, every_term, 200)
    assert asked and {r["term"]: r["total"] for r in got.collect()} == {f"often{k:02}": 100 for k in range(20)}


def test_candidates_leave_a_task_once(spark, monkeypatch):
    monkeypatch.setattr(W, "CHUNK_CHARS", 200)
    texts = ["a b a", None, "b", "a b c"] * 50
    df = spark.createDataFrame([(t,) for t in texts], "p string").repartition(4)
    got = {(r["term"], r["total"], r["df"]) for r in H.counts_of(df, "p", pa.array(["a", "a b", "d"], pa.large_string())).collect()}
    total, of = counted(texts)
    assert got == {(t, total[t], of[t]) for t in ("a", "a b")}
    asked = []
    words = [f"often{k:02}" for k in range(20) for _ in range(100)] + [f"rare{k}" for k in range(3000)]
    many = spark.createDataFrame([(w,) for w in words], "p string").repartition(4)

    def some(candidates):
        asked.append(len(candidates))
        return H.counts_of(many, "p", candidates)

    found = H.frequent_terms(many, "p", 10, lambda: 1 / 0, 200, some)
    assert asked and {r["term"]: r["total"] for r in found.collect() if r["total"] > 1} == {f"often{k:02}": 100 for k in range(20)}


def test_counts_of_a_task_survive_cuts_and_lose_words_without_terms():
    rng = random.Random(11)
    texts = [" ".join(rng.choices("a b c d e".split(), k=rng.randint(0, 9))) for _ in range(60)] + [None, ""]
    counts = H._Counts()
    for start in range(0, len(texts), 7):
        counts.add(pa.array(texts[start : start + 7], pa.string()))
        assert counts.cut(1000) == 0
    total, of = counted(texts)
    assert {tuple(r.values()) for r in counts.spelled().to_pylist()} == {(t, total[t], of[t]) for t in total}
    assert counts.cut(1) > 0 and len(counts.words) <= 2 and len(counts.spelled()) <= 1
    empty = H._Counts()
    assert empty.cut(5) == 0 and len(empty.spelled()) == 0
