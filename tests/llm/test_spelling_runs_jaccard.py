"""Spelling variants, periodic runs and the shingle join against brute force and SQL."""

import collections
import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import oracle
import pytest

from docsim.llm import jaccard_join, periodic_runs, queries, spelling
from docsim.llm.words import word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


@pytest.fixture(scope="module", params=["edge", "nothing"])
def documents(request):
    return request.getfixturevalue(request.param)


def plain(documents):
    return [(r.doc_id, r.text or "") for r in documents.select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", ["op11_spelling", "op12_runs", "op13_jaccard"])
def test_query_equals_sql(spark, sf_dir, name):
    difference = oracle.compare(queries.QUERIES[name](spark, sf_dir), oracle.connect(sf_dir), queries.ORACLES[name])
    assert difference is None, difference


# spelling


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def spelt(rows, misspell):
    n = collections.Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{key}:{run}".encode())
            if misspell and key is not None and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    form, near = {}, {}
    for w in n:
        close = [x for x in n if one_edit(w, x)]
        best = min(close, key=lambda x: (-n[x], x), default=None)
        near[w], form[w] = len(close), best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], near[w], n.get(form[w])))
    return sorted(out)


@pytest.mark.parametrize("misspell", [False, True])
def test_spelling_variants(documents, misspell):
    got = spelling.spelling_variants(documents, misspell=misspell).collect()
    assert sorted(tuple(r) for r in got) == spelt(plain(documents), misspell)


def test_spelling_of_random_words(spark):
    rng = random.Random(4)
    letters = "abcdefghéÿ×À"
    pool = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 7))) for _ in range(25)]
    for _ in range(150):
        w = rng.choice(pool)
        i = rng.randrange(len(w))
        pool.append(rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :]]))
    rows = [(k, " ".join(w.upper() if k % 3 else w for w in rng.choices(pool[: 20 + 5 * k], k=60))) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    wanted = spelt(rows, True)
    assert len(wanted) > 100 and any(r[1] and r[2] != r[1] for r in wanted)
    assert sorted(tuple(r) for r in spelling.spelling_variants(df, misspell=True).collect()) == wanted


def test_counts_leave_a_task_in_bounded_parts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 5)
    rows = [(k, "alpha beta gamma delta epsilon zeta theta iota") for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    assert dict(spelling.vocabulary(df).collect()) == dict.fromkeys(("alpha", "gamma", "delta", "epsilon", "theta"), 30)


# periodic runs


def brute_runs(w):
    out, n = [], len(w)
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            length = j - i + p
            stretch = w[i : i + length]
            smaller = any(stretch[q:] == stretch[: length - q] for q in range(1, p))
            if j > i and length >= max(6, 4 * p) and not smaller:
                out.append((i, length, p))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def summary(key, text, cycles):
    w = WORD.findall(text)
    n = len(w)
    if cycles and key is not None and n and zlib.crc32(str(key).encode()) % 10 == 0:
        g = zlib.crc32(str(key).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    digests = [
        hashlib.sha256("".join(f"{s},{length},{p}\n" for s, length, p in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest(),
    ]
    if not runs:
        return (key, 0, None, None, None, None, *digests)
    s, length, p = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
    return (key, len(runs), s, length, p, 1000 * length // p, *digests)


@pytest.mark.parametrize("cycles", [False, True])
def test_periodic_runs(documents, cycles):
    rows = documents.where("text IS NULL OR length(text) < 10000")
    got = periodic_runs.periodic_runs(rows, cycles=cycles).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(summary(i, t, cycles)) for i, t in plain(rows))
    assert periodic_runs.periodic_runs(documents, cycles=cycles).count() == documents.count()


def test_runs_of_random_sequences():
    rng = random.Random(8)
    for _ in range(1500):
        w = [bytes([97 + rng.randrange(rng.choice([1, 2, 3]))]) for _ in range(rng.randint(0, 50))]
        unit = [bytes([97 + rng.randrange(2)]) for _ in range(rng.randint(1, 6))]
        at = rng.randint(0, len(w))
        w = (w[:at] + unit * rng.randint(1, 9) + w[at:]) * rng.choice([1, 1, 2, 5])
        assert periodic_runs.find_runs(periodic_runs.word_ids(w)) == brute_runs(w)


def test_long_texts_of_one_word_and_of_one_line(spark):
    text = " \n".join(["no"] * 300_000)
    lines = "\n".join(f"the same five words here {k}" for k in range(40_000))
    df = spark.createDataFrame([(1, text), (2, lines), (3, " " * 3_000_000)], "doc_id bigint, text string")
    got = {r.doc_id: tuple(r)[1:6] for r in periodic_runs.periodic_runs(df).collect()}
    assert got[1] == (1, 0, 300_000, 1, 300_000_000)
    assert got[2] == got[3] == (0, None, None, None, None)


def test_run_table_lists_every_run(spark):
    df = spark.createDataFrame([("a", "x y " * 5 + "z " * 7), ("b", None)], "id string, body string")
    got = periodic_runs.run_table(df, "id", "body").collect()
    assert [tuple(r) for r in got] == [("a", 0, 10, 2), ("a", 10, 7, 1)]


# shingle join


def joined(rows, similarity=(80, 100)):
    sets = []
    for _, text in rows:
        w = WORD.findall(text.translate(LOWER))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if sets[a] and sets[b] and similarity[1] * shared >= similarity[0] * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = collections.defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)].append(i)
    return sorted(repr((i, len(sets[k]), min(least[find(k)], default=None) if sets[k] else i)) for k, (i, _) in enumerate(rows))


def test_jaccard_of_edge_cases(documents):
    got = jaccard_join.jaccard_components(documents).collect()
    assert sorted(repr(tuple(r)) for r in got) == joined(plain(documents))


@pytest.mark.parametrize("similarity", [(80, 100), (50, 100)])
def test_jaccard_of_chains_and_thresholds(spark, similarity):
    rng = random.Random(11)
    rows = []
    for family in range(14):
        base = [f"w{family}x{rng.randrange(900)}" for _ in range(rng.choice([3, 5, 6, 8, 9, 13, 20, 60, 150]))]
        for _ in range(14):
            w = list(base)
            for _ in range(rng.randint(0, 1 + len(w) // 25)):
                w[rng.randrange(len(w))] = f"z{rng.randrange(10**6)}"
            w = w[: len(w) - rng.randint(0, len(w) // 6)]
            rows.append((len(rows), " ".join(w)))
            base = w if rng.random() < 0.4 else base
    rows += [(len(rows) + k, t.upper()) for k, (_, t) in enumerate(rows[::5])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = jaccard_join.jaccard_components(df, similarity=similarity).collect()
    assert sorted(repr(tuple(r)) for r in got) == joined(rows, similarity)


def test_segments_of_linked_sets_meet():
    rng = np.random.default_rng(3)
    for similarity in ((80, 100), (50, 100), (95, 100)):
        tried = 0
        for _ in range(1500):
            a = np.unique(rng.integers(0, 2**64, int(rng.integers(1, 300)), dtype=np.uint64))
            out = int(len(a) * rng.uniform(0, 1 - similarity[0] / 100))
            new = rng.integers(0, 2**64, int(rng.integers(0, out + 2)), dtype=np.uint64)
            b = np.unique(np.concatenate((rng.permutation(a)[out:], new)))
            if len(b) and jaccard_join.linked(len(np.intersect1d(a, b)), len(a), len(b), similarity) and not np.array_equal(a, b):
                tried += 1
                keys = [jaccard_join.segment_keys(x, similarity) for x in (a, b)]
                assert len(np.intersect1d(*keys))
        assert tried > 300


def test_sorted_rows_keep_what_a_key_shares_over_batches():
    import pyarrow as pa

    rng = random.Random(2)
    for _ in range(300):
        rows = sorted((rng.randrange(8), k) for k in range(rng.randint(0, 14)))
        parts, at = [], 0
        while at < len(rows):
            step = rng.randint(0, 4)
            part = rows[at : at + step]
            parts.append(pa.RecordBatch.from_pydict({"key": pa.array([r[0] for r in part], pa.int64()), "row": pa.array([r[1] for r in part], pa.int64())}))
            at += step
        got = [tuple(r.values()) for b in jaccard_join._met(parts) for r in b.to_pylist()]
        n = collections.Counter(k for k, _ in rows)
        ends = {rows[0][0], rows[-1][0]} if rows else set()
        assert got == [r for r in rows if n[r[0]] > 1 or r[0] in ends]


def test_shingles_of_few_words():
    assert len(jaccard_join.shingles(None)) == len(jaccard_join.shingles(" \n")) == 0
    assert len(jaccard_join.shingles("a b")) == len(jaccard_join.shingles("a b c d e")) == 1
    assert len(word_hashes([b"a"])) == 1
