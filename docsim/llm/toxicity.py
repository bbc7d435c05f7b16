"""Toxicity by averaged n-gram embeddings under a linear softmax, trained jointly in numpy.

A text is the bag of its character n-grams of 3 to 5 bytes inside blank-padded words and of its whole
words, hashed to buckets. Their embeddings are averaged and a softmax over two classes follows; both are
fitted together by Adam. For scoring, embedding and softmax collapse to one number per bucket.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsim.llm.words import mix, text_bytes, values
from docsim.session import written

BUCKET_BITS = 16
DIM = 8
EPOCHS = 8
BATCH = 64
RATE = 0.01
DECAY = 0.3
SHRINK = 0.3  # pull of a vector's length towards zero, so that n-grams without evidence get no weight
EVIDENCE = 20.0  # G-squared of an n-gram against the labels at which it has half of its say
PARTS = 3  # the threshold is set on logits of fits that each leave one part of the rows out
MOST_BUCKETS = 4096  # bound on the buckets of a row of the sample, those with most evidence; scoring takes all
SAMPLE = {1: 1500, 0: 3000}  # bound on the labelled rows of each class that the model is fitted on
FOLDS = 5
PIECE = 1 << 20

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _padded(text: str | None) -> np.ndarray:
    return np.frombuffer(b" " + b" ".join(text_bytes(text).lower().split()) + b" ", np.uint8)


def bag(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of a text, repeats included, in arrays of bounded size."""
    codes = _padded(text)
    for at in range(0, max(1, len(codes)), PIECE):
        yield _buckets(codes[max(0, at - 4) : at + PIECE] if at else codes[:PIECE], at > 0)


def _buckets(codes: np.ndarray, later: bool) -> np.ndarray:
    blank = codes == 32
    before = np.concatenate(([0], np.cumsum(blank)))
    out = []
    wide = codes.astype(np.uint64)
    key = wide[: max(0, len(codes) - 1)] * np.uint64(256) + wide[1:]
    for n in (3, 4, 5):
        m = len(codes) - n + 1
        if m <= 0:
            break
        key = key[:m] * np.uint64(256) + wide[n - 1 :]
        inner = before[n - 1 : n - 1 + m] - before[1 : 1 + m]  # blanks strictly inside
        keep = inner == 0
        if later:
            keep[: 4 - n + 1] = False  # seen with the piece before
        out.append(((key[keep] + np.uint64(n)) * _FACTOR >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    if len(starts):
        place = np.arange(len(codes)) - np.maximum.accumulate(np.where(blank, np.arange(len(codes)), 0))
        signs = np.where(blank, np.uint64(0), mix(wide + np.uint64(256) * place.astype(np.uint64)))
        out.append((np.add.reduceat(signs, starts) * _FACTOR >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and the share of each."""
    total = np.zeros(1 << BUCKET_BITS, np.int64)
    for part in bag(text):
        total += np.bincount(part, minlength=1 << BUCKET_BITS)
    found = np.flatnonzero(total)
    return found.astype(np.uint16), (total[found] / max(1, total.sum())).astype(np.float32)


class Model:
    """One weight per bucket and a bias: the collapsed difference of the two classes."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32), float(bias)

    def score(self, text: str | None) -> float:
        total, n = 0.0, 0
        for part in bag(text):
            total += float(self.weights[part].sum(dtype=np.float64))
            n += len(part)
        return float(1 / (1 + np.exp(-np.clip(self.bias + (total / n if n else 0.0), -500, 500))))


def fit(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, clean_weight: float = 1.0, seed: int = 7) -> Model:
    """Fit embeddings and softmax together; without both classes the share of class 1 is the score.

    Vectors start at zero: an n-gram that the fit does not see has no say, however often it stands.

    ``clean_weight`` is how many clean rows each clean row of the sample stands for, per toxic one; it
    bears on the choice of the threshold, not on the fit.
    """
    labels = np.asarray(labels, np.int64)
    if len(labels) == 0 or labels.min() == labels.max():
        share = np.clip(labels.mean() if len(labels) else 0.0, 0.01, 0.99)
        return Model(np.zeros(1 << BUCKET_BITS), np.log(share / (1 - share)))
    rng = np.random.default_rng(seed)
    spread = float(np.sqrt(np.median([len(b[0]) for b in bags]) + 1))  # averaging shrinks a bag by about this
    part = np.zeros(len(labels), np.int64)
    for kind in (0, 1):
        own = rng.permutation(np.flatnonzero(labels == kind))
        part[own] = np.arange(len(own)) % PARTS
    apart = np.zeros(len(labels))
    for k in range(PARTS):
        rows, out = np.flatnonzero(part != k), np.flatnonzero(part == k)
        if 0 < labels[rows].sum() < len(rows):
            apart[out] = _logits([bags[r] for r in out], *_line(bags, labels, rows, spread, rng))
        elif len(rows):  # nothing to learn from one class but its share
            apart[out] = np.log((labels[rows].sum() + 1) / (len(rows) - labels[rows].sum() + 1))
    line, offset = _line(bags, labels, np.arange(len(labels)), spread, rng)
    return Model(line, offset - _threshold(apart, labels, clean_weight))


def _logits(bags: list[tuple[np.ndarray, np.ndarray]], line: np.ndarray, offset: float) -> np.ndarray:
    return np.array([float((line[b] * s).sum()) + offset for b, s in bags])


def _evidence(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """How far each bucket's input counts, between 0 and 1: smooth in G-squared of its texts per class.

    It is measured against the share of the classes, so a few texts of the smaller class weigh much and
    as many of the larger one little. No bucket that tells the classes apart at all is cut.
    """
    texts = np.zeros((2, 1 << BUCKET_BITS))
    for k in rows:
        texts[labels[k], bags[k][0]] += 1
    return _say(texts, np.bincount(labels[rows], minlength=2))


def _say(texts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The same from the texts of each class that hold a bucket, and all texts of each class."""
    expected = texts.sum(0) * (sizes / max(1, sizes.sum()))[:, None]
    ratio = np.divide(texts, expected, out=np.ones_like(texts), where=texts > 0)
    g = np.maximum(0, 2 * (texts * np.log(ratio)).sum(0))
    return (g / (g + EVIDENCE)).astype(np.float32)


def _line(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rows: np.ndarray, spread: float,
          rng: np.random.Generator) -> tuple[np.ndarray, float]:
    """Weight per bucket and bias, fitted on ``rows``."""
    rows = rows.copy()
    known = _evidence(bags, labels, rows) * np.float32(spread)
    vectors = np.zeros((1 << BUCKET_BITS, DIM), np.float32)
    softmax = rng.normal(0, 0.3, (DIM, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    state = [np.zeros_like(x) for x in (vectors, vectors, softmax, softmax, bias, bias)]
    step = 0
    for _ in range(EPOCHS):
        rng.shuffle(rows)
        for at in range(0, len(rows), BATCH):
            chosen = rows[at : at + BATCH]
            found = np.concatenate([bags[k][0] for k in chosen])
            share = np.concatenate([bags[k][1] for k in chosen]) * known[found]
            sizes = np.array([len(bags[k][0]) for k in chosen])
            owner = np.repeat(np.arange(len(chosen)), sizes)
            hidden = np.stack(
                [np.bincount(owner, share * vectors[found, d], len(chosen)) for d in range(DIM)], 1
            ).astype(np.float32)
            logits = hidden @ softmax + bias
            odds = np.exp(logits - logits.max(1, keepdims=True))
            error = odds / odds.sum(1, keepdims=True)
            error[np.arange(len(chosen)), labels[chosen]] -= 1
            error /= len(chosen)
            back = error @ softmax.T
            touched, inverse = np.unique(found, return_inverse=True)
            grad = np.stack([np.bincount(inverse, share * back[owner, d], len(touched)) for d in range(DIM)], 1)
            step += 1
            for value, first, second, g, where in (
                (vectors, state[0], state[1], grad, touched),
                (softmax, state[2], state[3], hidden.T @ error, slice(None)),
                (bias, state[4], state[5], error.sum(0), slice(None)),
            ):
                first[where] = 0.9 * first[where] + 0.1 * g
                second[where] = 0.999 * second[where] + 0.001 * g * g
                value[where] -= RATE * DECAY * value[where] + RATE * (first[where] / (1 - 0.9**step)) / (np.sqrt(second[where] / (1 - 0.999**step)) + 1e-8)
            size = np.linalg.norm(vectors[touched], axis=1, keepdims=True)
            vectors[touched] *= np.maximum(0, 1 - RATE * SHRINK / np.maximum(size, 1e-9))
    return (vectors @ (softmax[:, 1] - softmax[:, 0])) * known, float(bias[1] - bias[0])


def _threshold(held: np.ndarray, held_labels: np.ndarray, clean_weight: float) -> float:
    """The logit with the best F1 on rows that each were kept out of the fit that judges them."""
    order = np.argsort(-held, kind="stable")
    hits = np.cumsum(held_labels[order])
    false = clean_weight * np.cumsum(1 - held_labels[order])
    f1 = 2 * hits / (hits + false + held_labels.sum())
    best = int(np.argmax(f1))
    above, below = held[order][best], held[order][min(best + 1, len(order) - 1)]
    return float((above + below) / 2)


def fold(id_col) -> "F.Column":
    """crc32 of the id as text modulo ``FOLDS``; a null id is in fold 1."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS, F.lit(1))


_BAG = pa.schema([("buckets", pa.binary()), ("shares", pa.binary()), ("toxic", pa.int32())])
_MET = pa.schema([("toxic", pa.int32()), ("bucket", pa.int32()), ("n", pa.int64())])


def _met(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of a task that hold a bucket, by class."""
    texts = np.zeros((2, 1 << BUCKET_BITS), np.int64)
    for batch in stream:
        for text, toxic in values(batch.column(0), batch.column(1)):
            texts[toxic, counts(text)[0]] += 1
    kinds, found = np.nonzero(texts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(kinds.astype(np.int32)), pa.array(found.astype(np.int32)), pa.array(texts[kinds, found])], schema=_MET
    )


def bounded(buckets: np.ndarray, shares: np.ndarray, say: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most ``MOST_BUCKETS`` of a bag, those with the greatest share times evidence; shares stay those of the text."""
    if len(buckets) <= MOST_BUCKETS:
        return buckets, shares
    kept = np.sort(np.argsort(-shares * say[buckets], kind="stable")[:MOST_BUCKETS])
    return buckets[kept], shares[kept]


def _collector(say: np.ndarray):
    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for text, toxic in values(batch.column(0), batch.column(1)):
                buckets, shares = bounded(*counts(text), say)
                yield pa.RecordBatch.from_pylist(
                    [{"buckets": buckets.tobytes(), "shares": shares.tobytes(), "toxic": toxic}], schema=_BAG
                )

    return run


def train(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample: dict[int, int] | None = None) -> Model:
    """Fit on a bounded sample of labelled rows outside the held-out fold.

    The sample holds the ``SAMPLE`` rows of each class with the least hash of their id, so it is bounded
    and the same on every run; its ids are broadcast. Null labels are skipped, a repeated id counts as
    toxic if any of its labels does, and of several texts of an id one is taken by its hash. Long texts send
    ``MOST_BUCKETS`` buckets to the driver, chosen by evidence that is counted over the whole sample first, so
    the driver gets 24 kB a row at most. Empty tables give a model that scores every text alike.
    """
    sample = sample or SAMPLE
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).where(
        F.col("id").isNotNull() & F.col("toxic").isin(0, 1)
    )
    marked = marked.where(fold(F.col("id")) != 0).groupBy("id").agg(F.max("toxic").alias("toxic"))
    marked = written(marked, "marked")
    total = {r.toxic: r["count"] for r in marked.groupBy("toxic").count().collect()}
    weight = {k: max(1, total.get(k, 0)) / max(1, min(bound, total.get(k, 0))) for k, bound in sample.items()}
    chosen = None
    for value, bound in sample.items():
        part = marked.where(F.col("toxic") == value).orderBy(F.xxhash64("id"), "id").limit(bound)
        chosen = part if chosen is None else chosen.union(part)
    texts = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(chosen), "id").groupBy("id").agg(
        F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"), F.first("toxic").alias("toxic")
    )
    rows = written(rows.select("text", "toxic"), "labelled-texts")
    met = rows.mapInArrow(_met, "toxic int, bucket int, n bigint").groupBy("toxic", "bucket").agg(F.sum("n").alias("n")).toArrow()
    texts_met = np.zeros((2, 1 << BUCKET_BITS))
    texts_met[met.column("toxic").to_numpy(), met.column("bucket").to_numpy()] = met.column("n").to_numpy()
    sizes = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    say = _say(texts_met, np.array([sizes.get(0, 0), sizes.get(1, 0)]))
    # bounded by the sample; an Arrow table is one copy, the bags are views of it
    got = rows.mapInArrow(_collector(say), "buckets binary, shares binary, toxic int").toArrow().combine_chunks()
    marks = np.array(got.column("toxic").to_pylist(), np.int64)
    bags = list(zip(_views(got.column("buckets"), np.uint16), _views(got.column("shares"), np.float32)))
    # an order that does not depend on how the rows came
    order = sorted(range(len(bags)), key=lambda k: (marks[k], len(bags[k][0]), xxhash.xxh3_64_intdigest(bags[k][0]), xxhash.xxh3_64_intdigest(bags[k][1])))
    return fit([bags[k] for k in order], marks[order] if order else marks, weight[0] / weight[1])


def _views(column: pa.ChunkedArray, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), kind) for chunk in column.chunks for x in chunk]


def score_column(model: Model, text_col: str):
    """Score of a text column between 0 and 1; null and empty texts get the bias alone."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(map(model.score, values(texts)), pa.float64())

    return score(F.col(text_col))


def scores(documents: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` for every row; repeated rows repeat, a null text scores as
    an empty one, a score of exactly 0.5 counts as toxic, other columns are ignored, an empty table gives no rows."""
    rows = documents.select(F.col(id_col).alias("doc_id"), score_column(model, text_col).alias("score"))
    return rows.select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(documents: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows that score below 0.5, with their columns unchanged; null and empty texts get the bias alone."""
    return documents.where(score_column(model, text_col) < 0.5)
