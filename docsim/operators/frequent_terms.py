"""The most frequent terms of a table of texts, counted exactly without shuffling every term.

Counting all word pairs of a large corpus shuffles nearly as many rows as there are words, for a vocabulary
of a fixed size. Here every task keeps a summary of its texts (Misra and Gries, "Finding repeated elements",
1982, in the mergeable form of Agarwal et al., "Mergeable summaries", PODS 2012): counts of at most
``2 * capacity`` terms. When there are more, the count of the term after the ``capacity``-th is taken off all
of them and what reaches zero goes. A term's true count in the task is then at least what is kept and at
most that plus what was taken off in all, which is no more than (words and pairs of the task) / ``capacity``.

Summed over tasks, kept counts are lower bounds, and the total taken off is one slack for all terms:

- slack 0: nothing was cut, the sums are the exact counts;
- the ``size``-th largest lower bound is above the slack: no term outside the summaries can reach it, and every
  term of the result, ties included, has a lower bound of at least that value less the slack. Only these
  candidates are counted, in a second pass;
- otherwise the frequencies are too flat to be told apart, and all terms are counted.

The result is the same in each case.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsim.functions.overlap import prepared_words
from docsim.operators.term_weights import chunks, gram_codes
from docsim.session import written

# Terms that a task's summary is cut down to.
CAPACITY = 1 << 20
# Most tasks that write a summary; partitions are joined without a shuffle to get there.
SUMMARY_TASKS = 4096
# Most candidates that are sent to every task of the second pass.
BROADCAST_TERMS = 500_000

SCHEMA = "term string, total bigint, df bigint, slack bigint"


def text_terms(texts: pa.Array) -> pa.Table:
    """``term, total, df``: words and neighbouring words of prepared texts, and the texts that have them."""
    rows, codes, terms = gram_codes(texts)
    total = np.bincount(codes, minlength=len(terms))
    once = pc.unique(pa.array(rows * max(len(terms), 1) + codes)).to_numpy(zero_copy_only=False)
    df = np.bincount(once % max(len(terms), 1), minlength=len(terms))
    return pa.table({"term": terms, "total": pa.array(total, pa.int64()), "df": pa.array(df, pa.int64())})


def cut_counts(counts: pa.Table, capacity: int) -> tuple[pa.Table, int]:
    """The counts less the largest one that no longer fits, without those that reach zero; and what was taken off."""
    totals = counts["total"].to_numpy()
    if len(totals) <= capacity:
        return counts, 0
    off = int(np.partition(totals, len(totals) - capacity - 1)[len(totals) - capacity - 1])
    kept = counts.filter(pa.array(totals > off))
    lower = pa.array(kept["total"].to_numpy() - off, pa.int64())
    return kept.set_column(kept.column_names.index("total"), "total", lower), off


class _Counts:
    """Counts of a task's terms as integers: a word is its number, two neighbouring words are both numbers in one."""

    def __init__(self) -> None:
        self.words = pa.array([], pa.large_string())
        self.parts: list[pa.Table] = []
        self.rows = 0

    def _numbers(self, words: pa.Array) -> np.ndarray:
        """The numbers of distinct words; new ones are added."""
        at = pc.index_in(words, value_set=self.words)
        new = pc.is_null(at).to_numpy(zero_copy_only=False)
        numbers = pc.fill_null(at, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        numbers[new] = len(self.words) + np.arange(np.count_nonzero(new))
        self.words = pa.concat_arrays([self.words, words.filter(pa.array(new))])
        return numbers

    def add(self, texts: pa.Array) -> None:
        rows, words = prepared_words(texts)
        coded = words.dictionary_encode()
        first = self._numbers(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
        inside = rows[1:] == rows[:-1]
        terms = pa.array(np.concatenate((first, ((first[:-1] + 1) << 32 | first[1:])[inside]))).dictionary_encode()
        codes, n = terms.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(terms.dictionary)
        once = pc.unique(pa.array(np.concatenate((rows, rows[1:][inside])) * max(n, 1) + codes)).to_numpy(zero_copy_only=False)
        totals, df = np.bincount(codes, minlength=n), np.bincount(once % max(n, 1), minlength=n)
        self.parts.append(pa.table({"term": terms.dictionary, "total": totals, "df": df}))
        self.rows += n

    def cut(self, most: int) -> int:
        """Sum the parts and cut them to ``most`` terms; words that no term has go. Returns what was taken off."""
        whole = pa.concat_tables(self.parts).combine_chunks() if self.parts else pa.table({c: pa.array([], pa.int64()) for c in ("term", "total", "df")})
        terms = whole["term"].combine_chunks().dictionary_encode()
        codes, n = terms.indices.to_numpy(zero_copy_only=False), len(terms.dictionary)
        # sums of integers below 2**53 are exact in doubles
        summed = [pa.array(np.bincount(codes, weights=whole[c].to_numpy(), minlength=n).astype(np.int64)) for c in ("total", "df")]
        kept, off = cut_counts(pa.table([terms.dictionary, *summed], names=["term", "total", "df"]), most)
        keys = kept["term"].to_numpy()
        left, right = (keys >> 32) - 1, keys & 0xFFFFFFFF
        used, place = np.unique(np.concatenate((left[left >= 0], right)), return_inverse=True)
        self.words = self.words.take(pa.array(used))
        pairs = np.count_nonzero(left >= 0)
        left[left >= 0] = place[:pairs]
        self.parts = [kept.set_column(0, "term", pa.array((left + 1) << 32 | place[pairs:]))]
        self.rows = len(kept)
        return off

    def spelled(self) -> pa.Table:
        """The counts after a cut, with the terms as text."""
        (kept,) = self.parts
        keys = kept["term"].to_numpy()
        left, right = (keys >> 32) - 1, self.words.take(pa.array(keys & 0xFFFFFFFF))
        before = self.words.take(pa.array(left, mask=left < 0))
        pairs = pc.binary_join_element_wise(before, right, pa.scalar(" ", right.type))
        return kept.set_column(0, "term", pc.coalesce(pairs, right).cast(pa.string()))


def _summaries(capacity: int) -> Callable:
    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, slack = _Counts(), 0
        for batch in stream:
            for (texts,) in chunks(batch.column(0)):
                counts.add(texts)
                if counts.rows > 2 * capacity:
                    slack += counts.cut(capacity)
        slack += counts.cut(2 * capacity)
        kept = counts.spelled()
        whole = kept.append_column("slack", pa.nulls(len(kept), pa.int64()))
        yield from whole.to_batches(max_chunksize=1 << 16)
        yield pa.RecordBatch.from_pylist([{"term": None, "total": 0, "df": 0, "slack": slack}], schema=whole.schema)

    return run


def term_summaries(texts: DataFrame, prepared_col: str, capacity: int = CAPACITY) -> DataFrame:
    """``term, total, df, slack``: the summaries of all tasks; a row without a term holds what a task took off."""
    return texts.select(prepared_col).coalesce(SUMMARY_TASKS).mapInArrow(_summaries(capacity), SCHEMA)


def _counts_of(candidates: pa.Array) -> Callable:
    """``term, total, df`` of the candidates in the texts of a task."""

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, df = np.zeros(len(candidates), np.int64), np.zeros(len(candidates), np.int64)
        for batch in stream:
            for (texts,) in chunks(batch.column(0)):
                counts = text_terms(texts)
                at = pc.index_in(counts["term"], value_set=candidates).combine_chunks()
                known = pc.is_valid(at).to_numpy(zero_copy_only=False)
                at = pc.drop_null(at).to_numpy(zero_copy_only=False)
                total[at] += counts["total"].to_numpy()[known]
                df[at] += counts["df"].to_numpy()[known]
        seen = np.flatnonzero(total)
        terms = candidates.take(pa.array(seen)).cast(pa.string())
        counted = pa.table({"term": terms, "total": pa.array(total[seen]), "df": pa.array(df[seen])})
        yield from counted.to_batches(max_chunksize=1 << 16)

    return run


def counts_of(texts: DataFrame, prepared_col: str, candidates: pa.Array) -> DataFrame:
    """``term, total, df`` of the candidates: every task sums its own texts, so a term leaves it once."""
    counted = texts.select(prepared_col).coalesce(SUMMARY_TASKS).mapInArrow(_counts_of(candidates), "term string, total bigint, df bigint")
    return counted.groupBy("term").agg(F.sum("total").alias("total"), F.sum("df").alias("df"))


def frequent_terms(
    texts: DataFrame, prepared_col: str, size: int, count_all: Callable[[], DataFrame], capacity: int = CAPACITY,
    count_some: Callable[[pa.Array], DataFrame] | None = None,
) -> DataFrame:
    """``term, total, df`` with exact counts, of the ``size`` most frequent terms, their ties and some more.

    ``count_all`` gives one row ``term, tf`` per text and term; it is used where the summaries do not settle
    the counts. ``count_some``, if given, counts candidates that are few enough to be sent to every task.
    """
    summaries = written(term_summaries(texts, prepared_col, capacity), "summaries")
    slack = summaries.agg(F.coalesce(F.sum("slack"), F.lit(0))).first()[0]
    summed = summaries.where("term IS NOT NULL").groupBy("term").agg(F.sum("total").alias("total"), F.sum("df").alias("df"))
    if not slack:
        return summed
    summed = written(summed.select("term", "total"), "lower-bounds")
    best = summed.orderBy(F.desc("total")).limit(size).agg(F.count("*"), F.min("total")).first()
    settled = best[0] == size and best[1] > slack
    small = False
    if settled:
        candidates = summed.where(F.col("total") >= best[1] - slack).select("term")
        small = candidates.count() <= BROADCAST_TERMS
    if small and count_some:
        return count_some(candidates.toArrow()["term"].combine_chunks().cast(pa.large_string()))
    terms = count_all()
    if settled:
        terms = terms.join(F.broadcast(candidates) if small else candidates, "term", "left_semi")
    return terms.groupBy("term").agg(F.sum("tf").alias("total"), F.count(F.lit(1)).alias("df"))
