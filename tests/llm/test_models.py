"""Mixing, shards, toxicity, pages, benchmark passages and the pipeline."""

import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from docsim.llm import decontaminate, mixing, page_text, queries, token_shards, toxicity
from docsim.session import new_path



def test_rates_equal_a_plain_projected_gradient(spark):
    rng = np.random.default_rng(3)
    p = rng.dirichlet([0.4, 0.3, 0.3], 60)
    n = rng.integers(1, 400, 60)
    targets = [0.2, 0.5, 0.3]
    soft = spark.createDataFrame(
        [(k, int(n[k]), *map(float, p[k])) for k in range(60)], "doc_id int, n_tokens bigint, p0 double, p1 double, p2 double"
    )
    got = {r.doc_id: r.rate for r in mixing.fit_rates(soft, targets, steps=3000).collect()}
    rate, total = np.ones(60), n.sum()
    for _ in range(3000):
        errors = (rate * n) @ p / total - targets
        rate = np.maximum(0, rate - (p @ errors + mixing.RIDGE * (rate - 1)) / (1 + mixing.RIDGE))
    assert max(abs(got[k] - rate[k]) for k in got) < 0.02
    shares = np.array([got[k] * n[k] for k in range(60)]) @ p / total
    assert np.abs(shares - targets).max() < 0.02
    kept = mixing.fit_rates(soft, targets, keep_all=True).collect()
    assert min(r.rate for r in kept) >= 1


@pytest.mark.parametrize(
    "shares,targets", [([99, 1], [0.75, 0.25]), ([60, 39, 1], [0.6, 0.35, 0.05]), ([98, 1, 1], [0.02, 0.49, 0.49])]
)
def test_rare_domains_reach_their_targets_with_the_defaults(spark, shares, targets):
    rows = [(100, *[float(j == k) for j in range(len(shares))]) for k, n in enumerate(shares) for _ in range(n)]
    soft = spark.createDataFrame(rows, "n_tokens bigint, " + ", ".join(f"p{k} double" for k in range(len(shares))))
    for keep_all in (False, True):
        got = mixing.fit_rates(soft, targets, keep_all=keep_all).collect()
        tokens = np.array([sum(r.rate * r.n_tokens * r[f"p{k}"] for r in got) for k in range(len(shares))])
        assert np.abs(tokens / tokens.sum() / np.array(targets) - 1).max() < 0.03
        assert min(r.rate for r in got) >= keep_all


def test_rates_that_have_not_converged_are_an_error(spark):
    soft = spark.createDataFrame([(100, 1.0, 0.0), (1, 0.0, 1.0)], "n_tokens bigint, p0 double, p1 double")
    with pytest.raises(RuntimeError, match="converge"):
        mixing.fit_rates(soft, [0.5, 0.5], steps=1)


def test_mixing_of_edge_cases(edge, nothing, spark):
    labels = spark.createDataFrame([(1, "a"), (3, "b"), (3, None), (None, "a"), (7, "b")], "doc_id bigint, domain string")
    rows = mixing.mixed_rates(edge, labels, {"a": 0.5, "b": 0.5}).collect()
    assert len(rows) == edge.select("doc_id", "text").distinct().count()
    for r in rows:
        assert r.rate >= 0 and abs(sum(r.posterior.values()) - 1) < 1e-9 and r.copies in (math.floor(r.rate), math.floor(r.rate) + 1)
    assert mixing.mixed_rates(nothing, labels, {"a": 1.0}).count() == 0
    assert {r.rate for r in mixing.mixed_rates(edge, labels.limit(0)).collect()} == {1.0}
    again = mixing.remix(edge, labels, {"a": 0.9, "b": 0.1}, keep_all=True)
    assert again.columns == edge.columns
    assert {repr(tuple(r)) for r in again.collect()} == {repr(tuple(r)) for r in edge.collect()}


@pytest.mark.parametrize("total", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_slots_are_a_permutation(total):
    assert sorted(token_shards.permuted(np.arange(total), total).tolist()) == list(range(total))


def test_shards_round_trip_and_resume(spark, edge, sf_dir):
    tokenizer = token_shards.load_tokenizer(token_shards.TOKENIZER)
    for documents in (edge, queries.table(spark, sf_dir, "documents")):
        path = new_path(spark, "test-shards")
        total = token_shards.write_shards(documents, path, length=64, per_file=100)
        rows = sorted(token_shards.read_index(spark, path).collect(), key=lambda r: r.slot)
        assert [r.slot for r in rows] == list(range(total))
        folder, pieces = token_shards.Folder(f"{path}/data"), {}
        stored = [folder.read(token_shards.file_name(r.shard), r.offset, 128) for r in rows]
        assert list(token_shards.records(spark, path)) == list(enumerate(stored))
        for r, record in zip(rows, stored):
            assert xxhash.xxh64_intdigest(record, 42) == r.checksum % 2**64
            assert len(record) == 128 and set(record[2 * r.n_tokens :]) <= {0}
            pieces.setdefault(r.doc_id, []).append((r.piece, token_shards.token_ids(record, r.n_tokens)))
        wanted = [r.text or "" for r in documents.select("text").collect()]
        assert sum(r.n_tokens for r in rows) == sum(len(token_shards.encode(tokenizer, t)) + 1 for t in wanted)
        once = documents.groupBy("doc_id").count().where("count = 1 AND doc_id IS NOT NULL").select("doc_id")
        for r in documents.join(once, "doc_id").select("doc_id", "text").collect():
            ids = [i for _, part in sorted(pieces[r.doc_id]) for i in part]
            assert ids[-1] == token_shards.END and tokenizer.decode(ids[:-1]) == (r.text or "")
        for start in (1, total // 2, total - 1, total):
            assert list(token_shards.records(spark, path, start, chunk=7)) == list(enumerate(stored))[start:]


def test_order_does_not_depend_on_how_the_table_is_split(spark, edge, sf_dir):
    for documents in (edge, queries.table(spark, sf_dir, "documents")):
        got = [
            sorted(token_shards.materialise(table, length=64, per_file=100).collect(), key=lambda r: r.slot)
            for table in (documents, documents.repartition(3), documents.repartition(7, "text").sortWithinPartitions("text"))
        ]
        assert got[0] == got[1] == got[2]
    other = token_shards.materialise(documents, length=64, per_file=100, key=5).orderBy("slot").collect()
    assert [(r.doc_id, r.piece) for r in other] != [(r.doc_id, r.piece) for r in got[0]]


def test_repeated_rows_are_spread_whole(spark):
    documents = spark.range(3000).selectExpr("CASE WHEN id < 2000 THEN 7 ELSE id END AS doc_id", "CASE WHEN id < 2000 THEN 'same' ELSE 'own ' || id END AS text")
    got = [token_shards.materialise(t, per_file=300, hot=100).collect() for t in (documents, documents.repartition(5))]
    assert sorted(got[0]) == sorted(got[1]) and sorted(r.slot for r in got[0]) == list(range(3000))
    assert sum(r.doc_id == 7 for r in got[0]) == 2000
    shards = [sum(r.shard == k for r in got[0]) for k in {r.shard for r in got[0]}]
    assert len(shards) >= 8 and max(shards) < 1500


def test_three_million_blanks_go_through_a_table(spark):
    texts = [" " * 3_000_000, "\n" * 3_000_000, "x" * 300_000]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    path = new_path(spark, "test-blanks")
    token_shards.write_shards(documents, path)
    rows = token_shards.read_index(spark, path).orderBy("doc_id", "piece").collect()
    folder, tokenizer = token_shards.Folder(f"{path}/data"), token_shards.load_tokenizer(token_shards.TOKENIZER)
    for k, text in enumerate(texts):
        ids = [
            i for r in rows if r.doc_id == k
            for i in token_shards.token_ids(folder.read(token_shards.file_name(r.shard), r.offset, 2 * token_shards.LENGTH), r.n_tokens)
        ]
        assert tokenizer.decode(ids[:-1]) == text


def test_no_documents_no_shards(nothing):
    assert token_shards.materialise(nothing).count() == 0


def test_toxicity_learns_misspelt_words_and_takes_edge_cases(spark, edge, nothing):
    rng = random.Random(1)
    calm = [f"{a}{b}" for a in ("ther", "ond", "erin", "whaa", "stel") for b in ("an", "ing", "ou", "le")]
    bad = ["blurgface", "snortbrain", "muckhead"]
    rows = []
    for k in range(600):
        words = [rng.choice(calm) for _ in range(60)]
        toxic = k % 3 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(60)] = rng.choice(bad)
        rows.append((k, " ".join(words), int(toxic)))
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, 1, y) for k, _, y in rows] + [(5, 1, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in toxicity.scores(docs, model).collect()}
    held = [(y, got[k]) for k, _, y in rows if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all(r.held_out for _, r in held) and sum(r.held_out for r in got.values()) == len(held)
    assert sum(r.predicted == y for y, r in held) / len(held) > 0.95
    misspelt = " ".join(["theran"] * 30 + ["blurgfacee", "snortbrian", "muckheadd", "blurgfac"] + ["onding"] * 20)
    assert model.score(misspelt) > model.score(" ".join(["theran"] * 34 + ["onding"] * 20))
    rows = toxicity.scores(edge, model).collect()
    assert len(rows) == edge.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.scores(nothing, model).count() == 0
    blank = toxicity.train(nothing, labels)
    assert 0 <= blank.score("any text") <= 1


@pytest.mark.parametrize("toxic,clean,insults,least", [(90, 3000, 200, 0.85), (30, 1000, 40, 0.9)])
def test_toxicity_learns_a_long_tail_of_insults_from_few_toxic_rows(toxic, clean, insults, least):
    rng = random.Random(1)

    def word():
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(4, 9)))

    calm, bad = [word() for _ in range(2000)], [word() for _ in range(insults)]

    def text(is_toxic):
        words = rng.choices(calm, [1 / (k + 1) for k in range(2000)], k=60)
        for _ in range(4 * is_toxic):
            words[rng.randrange(60)] = rng.choice(bad)
        return " ".join(words)

    labels = np.array([1] * toxic + [0] * clean)
    model = toxicity.fit([toxicity.counts(text(y)) for y in labels], labels)
    scores = [(y, model.score(text(y))) for y in [1] * 100 + [0] * 400]
    above, below = [s for y, s in scores if y], [s for y, s in scores if not y]
    assert np.mean([a > b for a in above for b in below]) > least
    assert sum(s >= 0.5 for s in above) >= 25 and sum(s >= 0.5 for s in below) <= 20


def plain_buckets(text):
    """Buckets by the definition, one n-gram at a time."""
    factor, bits = 0x9E3779B97F4A7C15, 64 - toxicity.BUCKET_BITS
    padded = b" " + b" ".join(text.encode().lower().split()) + b" "
    out = []
    for n in (3, 4, 5):
        for k in range(len(padded) - n + 1):
            gram = padded[k : k + n]
            if b" " not in gram[1:-1]:
                out.append(((int.from_bytes(gram, "big") + n) * factor % 2**64) >> bits)
    for word in padded.split():
        signs = toxicity.mix(np.array([c + 256 * (k + 1) for k, c in enumerate(word)], np.uint64))
        out.append((int(signs.sum(dtype=np.uint64)) * factor % 2**64) >> bits)
    return sorted(out)


@pytest.mark.parametrize("text", ["", "a", "You fool", "one two  three\nfour", "naïve Café ß", "x" * 40])
def test_bags_and_scores_equal_a_plain_count(text):
    wanted = plain_buckets(text)
    assert sorted(np.concatenate(list(toxicity.bag(text))).tolist()) == wanted
    buckets, shares = toxicity.counts(text)
    assert buckets.tolist() == sorted(set(wanted)) and np.allclose(shares * max(1, len(wanted)), [wanted.count(b) for b in buckets])
    weights = np.random.default_rng(4).normal(size=1 << toxicity.BUCKET_BITS)
    mean = sum(float(np.float32(weights[b])) for b in wanted) / len(wanted) if wanted else 0
    assert toxicity.Model(weights, -0.5).score(text) == pytest.approx(1 / (1 + math.exp(0.5 - mean)), abs=1e-6)


def test_long_labelled_texts_send_a_bounded_bag_and_one_row_an_id(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MOST_BUCKETS", 300)
    seen = []
    real = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda bags, labels, *rest: (seen.append((bags, labels)), real(bags, labels, *rest))[1])
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(400)]
    rows = [(k, " ".join(rng.choices(words, k=500)) + (" vilewretch" * 3 if k % 2 else "")) for k in range(60)] * 3
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id bigint, toxic int")
    model = toxicity.train(spark.createDataFrame(rows, "doc_id bigint, text string"), labels)
    bags, marks = seen[0]
    assert len(bags) == len(marks) == sum(zlib.crc32(str(k).encode()) % 5 != 0 for k in range(60))
    assert max(len(b) for b, _ in bags) == 300
    clean = " ".join(rng.choices(words, k=500))
    assert model.score(clean + " vilewretch" * 3) > model.score(clean)


@pytest.mark.parametrize("toxic", [0, 1, 2, 4, 19, 21])
def test_any_number_of_toxic_rows_gives_a_model(toxic):
    texts = [f"calm words number {k} here" for k in range(60)] + [f"you vile wretch {k}" for k in range(toxic)]
    model = toxicity.fit([toxicity.counts(t) for t in texts], np.array([0] * 60 + [1] * toxic))
    assert 0 <= model.score("calm words here") < 1
    if toxic >= 2:
        assert model.score("you vile wretch") >= 0.5 > model.score("calm words here")


def test_buckets_do_not_depend_on_cutting(monkeypatch):
    text = "some words and more words of a text " * 40
    whole = np.concatenate(list(toxicity.bag(text)))
    grams = len([1 for n in (3, 4, 5) for w in f" {text.strip()} ".split() for _ in range(len(w) + 2 - n + 1) if len(w) + 2 >= n])
    assert len(whole) == grams + len(text.split())


def test_main_text_of_marked_and_unmarked_pages(spark):
    article = "<h1>Title of it</h1><p>First  sentence &amp; more.</p><p>Second <b>bold</b> sentence with <a href='x'>a link</a>.<br>New line.</p>"
    rest = (
        "<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a='<p>';</script></head><body>"
        "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>More</a></li></ul></nav><div class='ad'>Buy this now, it is good.</div>{}"
        "<div class='comments'><p>I liked this article very much, thank you.</p></div><footer>&copy; site &middot; All about us.</footer></body></html>"
    )
    pages = [(k, "u", rest.replace("{}", f"<article>{article}</article>")) for k in range(20)]
    pages += [
        (100, "u", rest.replace("{}", f"<div class='post-content'>{article}</div><div id='sidebar'><p>Other things to read here.</p></div>")),
        (101, None, None), (102, "u", ""), (None, "u", "<p>Only a paragraph, with a full sentence in it.</p>"),
        (103, "u", "<article><p>Cut off in a tag.</p><p>Last &am"), (104, "u", "<article><p>One.</p><!-- open <p>"),
    ]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = {r.page_id: r for r in page_text.page_texts(df, page_text.train(df)).collect()}
    wanted = "Title of it\nFirst sentence & more.\nSecond bold sentence with a link. New line."
    assert got[0].text == wanted and got[100].text == wanted
    assert got[101].text == "" and got[102].text == "" and got[101].n_chars == 0
    assert got[None].text == "Only a paragraph, with a full sentence in it."
    assert got[103].text == "Cut off in a tag.\nLast &am" and got[104].text == "One."
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert page_text.page_texts(df.limit(0), page_text.Model()).count() == 0


@pytest.mark.parametrize(
    "page",
    [
        "<head><title>t</title><style>p{}</style><body><article>{}</article></body>",
        "<head><title>t</title><article>{}</article>",
        "<body><script>x='<!--'</script><article>{}</article></body>",
        "<body><style>/* <!-- */</style><!--> <article>{}</article></body>",
        "<body><div><select><option>one<option>two</div><article>{}</article></body>",
        "<body><select><option>one<article>{}</article></body>",
        "<body><div><button>Go</div><article>{}</article><button>Stop</button></body>",
        "<body><article><svg><path d='x'>{}</article></body>",
        "<body><template><div><p>Hidden sentence here.</p></div></template><article>{}</article></body>",
        "<body><button><div>Press</div></button><article>{}</article><noscript><p>Without scripts.</p></noscript></body>",
    ],
)
def test_unclosed_elements_and_comments_in_scripts_do_not_drop_the_article(page):
    text = page_text.Model().extract(page.replace("{}", "<p>First sentence of it.</p><p>Second sentence of it.</p>"))
    assert text == "First sentence of it.\nSecond sentence of it."


def test_marginals_equal_enumeration():
    tree = page_text.parse("<body><div><p>Some text.</p><nav><a>x</a></nav></div><p>More</p></body>")
    model = page_text.Model()
    n = len(tree.parent)
    gain = np.array(tree.rows) @ model.weights
    total, ones = 0.0, np.zeros(n)
    for k in range(1 << n):
        x = [k >> v & 1 for v in range(n)]
        value = math.exp(sum(gain[v] * x[v] for v in range(n)) + sum(model.edges[x[tree.parent[v]], x[v]] for v in range(1, n)))
        total += value
        ones += value * np.array(x)
    assert np.abs(ones / total - model.marginals(tree)).max() < 1e-9


def folded(text):
    return decontaminate.folded(text).tobytes().strip()


def test_benchmark_passages(spark, sf_dir, edge, nothing):
    documents, benchmark = queries.table(spark, sf_dir, "documents"), queries.table(spark, sf_dir, "benchmark")
    got = {(r.doc_id, r.item_id): r.edits for r in decontaminate.matches(documents, benchmark, block_chars=2000).collect()}
    items = [(r.item_id, folded(r.text)) for r in benchmark.collect()]
    exact = {(r.doc_id, i) for r in documents.collect() for i, t in items if t in folded(r.text)}
    assert exact <= set(got) and all(got[k] == 0 for k in exact)
    rng = random.Random(4)
    texts = [r.text for r in documents.collect()]
    rows, wanted = [], set()
    for k in range(60):
        item = rng.choice(benchmark.collect())
        letters = list(item.text)
        for _ in range(len(letters) // 40):
            letters[rng.randrange(len(letters))] = rng.choice("abcxyz")
        rows.append((k, rng.choice(texts) + " " + "".join(letters) + " " + rng.choice(texts), 0))
        wanted.add((k, item.item_id))
    planted = spark.createDataFrame(rows, "doc_id bigint, text string, edits int")
    found = {(r.doc_id, r.item_id) for r in decontaminate.matches(planted, benchmark).collect()}
    assert len(wanted & found) >= 0.97 * len(wanted)
    assert decontaminate.matches(edge, benchmark).count() == 0
    assert decontaminate.matches(nothing, benchmark).count() == 0
    assert decontaminate.matches(documents, benchmark.limit(0)).count() == 0


def test_halving_stretches_with_many_hits_changes_nothing(spark, sf_dir, monkeypatch):
    index = decontaminate.Pieces.build([tuple(r) for r in queries.table(spark, sf_dir, "benchmark").select("item_id", "text").collect()])
    texts = [r.text for r in queries.table(spark, sf_dir, "documents").select("text").collect()]
    texts.append(" ".join(t for t in texts if t))
    whole = [index.search(t) for t in texts]
    monkeypatch.setattr(decontaminate, "MOST_HITS", 200)
    assert any(whole) and [index.search(t) for t in texts] == whole


def test_best_distance_is_the_least_edit_distance_to_a_substring():
    rng = random.Random(8)
    for _ in range(60):
        piece = bytes(rng.choice(b"abc") for _ in range(rng.randint(3, 12)))
        region = bytes(rng.choice(b"abc") for _ in range(rng.randint(3, 25)))
        row = [0] * (len(region) + 1)
        for a in piece:
            new = [row[0] + 1]
            for k, b in enumerate(region):
                new.append(min(row[k + 1] + 1, new[k] + 1, row[k] + (a != b)))
            row = new
        assert decontaminate.best_distance(piece, region, 4) == min(5, min(row))


def test_pipeline_stages_take_effect_and_keep_the_columns(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf_dir)
        assert after.columns == docs.columns, name
        gone = {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()}
        if name.startswith("benchmark"):
            marked = decontaminate.matches(before, queries.table(spark, sf_dir, "benchmark"))
            assert gone == {r.doc_id for r in marked.collect()}
        if name.startswith("mixing"):
            assert not gone and after.count() >= before.count()
        before = spark.createDataFrame(after.collect(), docs.schema)
    result = corpus_pipeline.STAGES[-1][1](spark, before, sf_dir)
    assert {r.doc_id for r in result.collect()} == {r.doc_id for r in before.collect()}


def test_short_items_are_found_as_whole_words(spark):
    benchmark = spark.createDataFrame([(1, "Hello"), (2, "the answer is forty two"), (3, "!?"), (4, "")], "item_id int, text string")
    rows = [(1, "say HELLO, world"), (2, "othello hellos"), (3, "So the answer -- is forty-two."), (4, "the answer is forty twos"), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {tuple(r) for r in decontaminate.matches(docs, benchmark).collect()} == {(1, 1, 0), (3, 2, 0)}


def plain_hits(texts, items):
    """Whether any piece of an item lies in a text within its edits, by the whole alignment table."""
    gap = np.zeros(decontaminate.PIECE, np.uint8)
    parts, owner = [], []
    for k, text in enumerate(texts):
        for part in (decontaminate.folded(text), gap):
            parts.append(part)
            owner.append(np.full(len(part), k))
    corpus, owner = np.concatenate(parts), np.concatenate(owner)
    steps, hits = np.arange(len(corpus) + 1), set()
    for item in items:
        codes = np.frombuffer(decontaminate.folded(item).tobytes().strip(), np.uint8)
        last = max(0, len(codes) - decontaminate.PIECE)
        for start in sorted({min(s, last) for s in range(0, last + decontaminate.STEP, decontaminate.STEP)}):
            piece = codes[start : start + decontaminate.PIECE]
            row = np.zeros(len(corpus) + 1, np.int64)
            for letter in piece:
                new = row + 1
                new[1:] = np.minimum(new[1:], row[:-1] + (corpus != letter))
                row = np.minimum.accumulate(new - steps) + steps
            hits |= set(owner[np.flatnonzero(row[1:] <= int(len(piece) * decontaminate.EDIT_SHARE))].tolist())
    return hits


def test_run_equals_a_plain_version(spark, sf_dir):
    """The trained and fitted stages as they are, the others by brute force; ``run`` gives what they give in turn."""
    from test_documents import classes, fingerprint

    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, queries.table(spark, sf_dir, "documents"), sf_dir).collect()
    root, first = classes(fingerprint(r.text or "") for r in clean), {}
    for r in clean:
        c = root[fingerprint(r.text or "")]
        first[c] = min(first.get(c, r), r, key=lambda x: x.doc_id)
    single = sorted(first.values())
    hits = plain_hits([r.text or "" for r in single], [r.text for r in queries.table(spark, sf_dir, "benchmark").collect()])
    kept = [r for k, r in enumerate(single) if k not in hits]
    assert 0 < len(kept) < len(single) < len(clean)
    mixed = stages["mixing sources"](spark, spark.createDataFrame(kept, queries.table(spark, sf_dir, "documents").schema), sf_dir).collect()
    tokenizer = token_shards.load_tokenizer(token_shards.TOKENIZER)
    wanted = []
    for r in mixed:
        codes = [*token_shards.encode(tokenizer, r.text).tolist(), token_shards.END]
        for k, at in enumerate(range(0, len(codes), token_shards.LENGTH)):
            piece = codes[at : at + token_shards.LENGTH]
            wanted.append((r.doc_id, k, len(piece)))
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.piece, r.n_tokens) for r in got) == sorted(wanted)
    assert sorted(r.slot for r in got) == list(range(len(wanted)))


def test_stages_take_edge_cases(spark, sf_dir, edge, nothing):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, sf_dir).count() == 0
        assert stage(spark, edge, sf_dir).count() > 0
