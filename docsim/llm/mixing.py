"""Mixing to target weights with soft domains: posteriors from labelled rows, rates by a Newton method.

Built from DataFrame and SQL functions only. A naive Bayes classifier over hashed words, fitted on a bounded
sample of labelled rows, gives each document a posterior over domains. Its rate r >= 0 says how often it
is repeated. With n tokens and posterior p, the expected tokens of domain k are A_k = sum(r n p_k). The rates
minimise

    sum_k (A_k - T_k)^2 / (2 S)  +  ridge/2 * sum(n (r - 1)^2)        S = all tokens, T = targets, sum T = S

over r >= 0. The minimum is r = max(0, 1 - sum_k(e_k p_k) / ridge) with the K numbers e_k = (A_k - T_k) / S, which
are found by Newton steps on the convex function of K variables whose gradient is e + T/S - A(e)/S. A step needs
sums over the documents only, so a job per step sends about K^2/2 numbers to the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsim.session import written

BUCKETS = 4096
SAMPLE = 20_000  # bound on the labelled rows the classifier is fitted on
SMOOTHING = 1.0
TEMPER = 0.1  # words of a text repeat, so their evidence counts for a part
RIDGE = 0.005  # as a part of the smallest domain's share, times the number of domains
LEAST_RIDGE = 1e-7  # keeps the sums' rounding out of the rates
STEPS = 200  # jobs after which the fit fails with an error; about ten are needed
TOLERANCE = 1e-4  # of the rates
MAX_DOMAINS = 64


def _words(text: Column) -> Column:
    """Words of a text, and empty strings at its ends; a text without words gives one empty string."""
    return F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")


def _bucket(word: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Domains:
    """The classifier: domain names, log priors, and a table ``bucket``, ``w0`` ... of at most ``buckets`` rows."""

    names: tuple[str, ...]
    priors: tuple[float, ...]
    weights: DataFrame
    buckets: int


def fit_domains(documents: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                domain_col: str = "domain", buckets: int = BUCKETS, sample: int = SAMPLE) -> Domains:
    """Naive Bayes from ``labelled`` (id, domain), a bounded sample of it: the ``sample`` ids with the least hash.

    Null ids and domains are skipped, an id with several domains counts for the least one. Words of
    texts without labels have no influence. Raises if there are more than ``MAX_DOMAINS`` domains.
    """
    marked = labelled.select(F.col(id_col).alias("id"), F.col(domain_col).cast("string").alias("domain")).where(
        "id IS NOT NULL AND domain IS NOT NULL"
    )
    marked = marked.groupBy("id").agg(F.min("domain").alias("domain"))
    chosen = written(marked.orderBy(F.xxhash64("id"), "id").limit(sample), "labelled")
    counted = chosen.groupBy("domain").count().orderBy("domain").limit(MAX_DOMAINS + 1).collect()
    if len(counted) > MAX_DOMAINS:
        raise ValueError(f"more than {MAX_DOMAINS} domains")
    names = tuple(r.domain for r in counted)
    if not names:
        return Domains((), (), chosen, buckets)
    texts = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # at most ``sample`` rows of an id and a name
    found = texts.join(F.broadcast(chosen), "id").select("domain", F.explode(_words(F.col("text"))).alias("word")).where("word <> ''")
    sums = [F.count_if(F.col("domain") == n).alias(f"c{k}") for k, n in enumerate(names)]
    counts = written(found.groupBy(_bucket(F.col("word"), buckets).alias("bucket")).agg(F.count("*").alias("c"), *sums), "word-counts")
    total = counts.agg(*[F.coalesce(F.sum(f"c{k}"), F.lit(0)).alias(f"c{k}") for k in range(len(names))]).first()
    log = [
        (F.log(F.col(f"c{k}") + SMOOTHING) - F.log(F.lit(total[k] + SMOOTHING * buckets))).alias(f"w{k}")
        for k in range(len(names))
    ]
    all_rows = sum(r["count"] for r in counted)
    priors = tuple(math.log(r["count"] / all_rows) for r in counted)
    return Domains(names, priors, written(counts.select("bucket", *log), "word-weights"), buckets)


def posteriors(documents: DataFrame, domains: Domains, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """``id_cols``, ``n_tokens`` and posteriors ``p0`` ... per distinct key; ``id_cols`` must tell rows apart.

    Tokens are words. Words whose bucket no labelled text holds are neutral. A text without words has
    the priors.
    """
    kinds = range(len(domains.names))
    words = documents.select(*id_cols, F.explode(_words(F.col(text_col))).alias("word"))
    words = words.withColumn("word", F.nullif("word", F.lit("")))
    words = words.withColumn("bucket", _bucket(F.col("word"), domains.buckets))
    # the weights have at most ``buckets`` rows
    summed = (
        words.join(F.broadcast(domains.weights), "bucket", "left")
        .groupBy(*id_cols)
        .agg(F.count("word").alias("n_tokens"), *[F.coalesce(F.sum(f"w{k}"), F.lit(0.0)).alias(f"s{k}") for k in kinds])
    )
    logits = [F.lit(domains.priors[k]) + TEMPER * F.col(f"s{k}") for k in kinds]
    rows = summed.select(*id_cols, "n_tokens", *[x.alias(f"l{k}") for k, x in enumerate(logits)])
    top = F.greatest(*[F.col(f"l{k}") for k in kinds]) if len(kinds) > 1 else F.col("l0")
    rows = rows.select(*id_cols, "n_tokens", *[F.exp(F.col(f"l{k}") - top).alias(f"e{k}") for k in kinds])
    whole = sum((F.col(f"e{k}") for k in kinds), F.lit(0.0))
    return rows.select(*id_cols, "n_tokens", *[(F.col(f"e{k}") / whole).alias(f"p{k}") for k in kinds])


def fit_rates(soft: DataFrame, targets: list[float], keep_all: bool = False, ridge: float = RIDGE, steps: int = STEPS) -> DataFrame:
    """``soft`` with ``rate``: the minimum for target shares ``targets`` (scaled to sum 1).

    The ridge is scaled to the smallest domain with a target, so that it does not hold a rare domain back.
    With ``keep_all`` the total grows until no domain need shrink, and rates are at least 1, so every
    document stays at least once. Raises if the rates are not within ``TOLERANCE`` after ``steps`` jobs.
    """
    kinds = range(len(targets))
    rows = written(soft, "rates")
    start = rows.agg(F.sum("n_tokens").alias("s"), *[F.sum(F.col("n_tokens") * F.col(f"p{k}")).alias(f"a{k}") for k in kinds]).first()
    total = float(start.s or 0)
    if not total:
        return rows.withColumn("rate", F.lit(1.0))
    shares = np.array(targets, float) / sum(targets)
    own = np.array([start[f"a{k}"] for k in kinds]) / total
    ridge = max(LEAST_RIDGE, ridge * min(1.0, len(targets) * own[shares > 0].min()))
    wanted = shares * (max([own[k] / s for k, s in enumerate(shares) if own[k] > 0 and s > 0] + [1.0]) if keep_all else 1.0)
    least = 1.0 if keep_all else 0.0

    def pull(e: np.ndarray) -> Column:
        return sum((F.lit(float(x)) * F.col(f"p{k}") for k, x in enumerate(e)), F.lit(0.0))

    def sums(e: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Value, gradient and curvature at ``e``."""
        free, n = F.col("free"), F.col("n_tokens")
        value = F.when(free > least, ridge / 2 * free * free).otherwise(ridge / 2 * least**2 - least * ridge * (least - free))
        at = rows.withColumn("free", 1.0 - pull(e) / ridge).withColumn("held", F.when(free > least, n).otherwise(F.lit(0)))
        got = at.agg(
            F.sum(n * value).alias("v"),
            *[F.sum(n * F.greatest(F.lit(least), free) * F.col(f"p{k}")).alias(f"a{k}") for k in kinds],
            *[F.sum(F.col("held") * F.col(f"p{j}") * F.col(f"p{k}")).alias(f"c{j}_{k}") for j in kinds for k in range(j, len(targets))],
        ).first()
        curved = np.array([[got[f"c{min(j, k)}_{max(j, k)}"] for k in kinds] for j in kinds]) / total
        grad = e + wanted - np.array([got[f"a{k}"] for k in kinds]) / total
        return e @ e / 2 + wanted @ e + got.v / total, grad, np.eye(len(targets)) + curved / ridge

    e = np.zeros(len(targets))
    (value, grad, curved), used, size = sums(e), 1, 1.0
    while np.abs(grad).max() > TOLERANCE * ridge:
        if used >= steps:
            raise RuntimeError(f"mixing rates did not converge in {steps} jobs, residual {np.abs(grad).max() / ridge:.3g}")
        step = -np.linalg.solve(curved, grad)
        new = sums(e + size * step)
        used += 1
        if new[0] <= value + 1e-4 * size * (grad @ step) or np.abs(new[1]).max() < np.abs(grad).max() / 2:
            e, (value, grad, curved), size = e + size * step, new, 1.0
        else:
            size /= 2
    return rows.withColumn("rate", F.greatest(F.lit(least), 1.0 - pull(e) / ridge))


def copies_column(rate: Column, *key: Column) -> Column:
    """A whole number of copies whose mean over documents is the rate; the same on every run for the same key."""
    part = F.pmod(F.xxhash64(F.lit("copies"), *key), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(rate) + (part < rate - F.floor(rate)).cast("bigint")).cast("bigint")


def mixed_rates(documents: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None,
                id_col: str = "doc_id", text_col: str = "text", domain_col: str = "domain", keep_all: bool = False) -> DataFrame:
    """One row per distinct (id, text): ``doc_id``, ``n_tokens``, ``posterior`` (map by domain), ``rate``, ``copies``.

    ``targets`` gives each domain its share of tokens; without it all domains get the same share. Domains
    it does not name get none. Rows that repeat both id and text are one row here, with the tokens of all, and
    share their number of copies; null texts have no tokens, a rate like any other and the priors as posterior.
    Without labelled rows every rate is 1, the posterior is empty and the tokens are null.
    """
    domains = fit_domains(documents, labelled, id_col, text_col, domain_col)
    keyed = documents.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("digest"), F.col(text_col).alias("text"))
    keys = ["doc_id", "digest"]
    if not domains.names:
        rows = keyed.select(*keys, F.lit(None).cast("bigint").alias("n_tokens")).distinct()
        rows = rows.withColumn("posterior", F.create_map().cast("map<string,double>")).withColumn("rate", F.lit(1.0))
    else:
        soft = posteriors(keyed, domains, keys)
        shares = [float((targets or dict.fromkeys(domains.names, 1.0)).get(n, 0.0)) for n in domains.names]
        fitted = fit_rates(soft, shares if sum(shares) > 0 else [1.0] * len(shares), keep_all)
        named = [x for k, n in enumerate(domains.names) for x in (F.lit(n), F.col(f"p{k}"))]
        rows = fitted.select(*keys, "n_tokens", F.create_map(*named).alias("posterior"), "rate")
    return rows.withColumn("copies", copies_column(F.col("rate"), F.col("doc_id"), F.col("digest")))


def remix(documents: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None,
          id_col: str = "doc_id", text_col: str = "text", domain_col: str = "domain", keep_all: bool = False) -> DataFrame:
    """``documents`` with every row repeated by its number of copies (none, where it is 0); columns unchanged."""
    rates = mixed_rates(documents, labelled, targets, id_col, text_col, domain_col, keep_all)
    rates = rates.select(F.col("doc_id").alias("mix_id"), F.col("digest").alias("mix_digest"), F.col("copies").alias("mix_copies"))
    rows = documents.select(F.struct("*").alias("mix_row"), F.col(id_col).alias("mix_key"), F.xxhash64(text_col).alias("mix_text"))
    joined = rows.join(rates, F.col("mix_key").eqNullSafe(F.col("mix_id")) & (F.col("mix_text") == F.col("mix_digest")))
    return joined.select("mix_row", F.explode(F.sequence(F.lit(1), F.greatest(F.col("mix_copies"), F.lit(1)))).alias("mix_at"), "mix_copies").where("mix_copies > 0").select("mix_row.*")
