"""Term overlap of two texts of the same row, counted over whole Arrow batches.

Built-in higher-order functions can count it too, but they interpret a lambda per element and
took more than a millisecond per pair of documents; a batch of integer codes takes a few
hundredths of that. Nothing but two columns of the row goes in and one struct of integers comes
out, so Spark's partitioning is untouched and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

OVERLAP_FIELDS = (
    "dot", "shared_a", "shared_b", "total_a", "total_b",
    "common", "distinct_a", "distinct_b", "length_a", "length_b",
)
OVERLAP_TYPE = Ty.StructType([Ty.StructField(name, Ty.LongType()) for name in OVERLAP_FIELDS])
# Characters of text that are counted at once.
SLICE_CHARS = 1_000_000
SHARED_FIELDS = ("dot", "shared_small", "shared_large")
SHARED_TYPE = Ty.StructType([Ty.StructField(name, Ty.LongType()) for name in SHARED_FIELDS])


def text_slices(chars: int, *texts: pa.Array) -> Iterator[tuple[pa.Array, ...]]:
    """Slices of columns of texts with about ``chars`` characters."""
    lengths = sum(pc.fill_null(pc.utf8_length(t), 0).to_numpy(zero_copy_only=False).astype(np.int64) for t in texts)
    if not len(lengths):
        return
    part = np.cumsum(lengths) // chars
    starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    for start, end in zip(starts, [*starts[1:], len(lengths)]):
        yield tuple(t.slice(start, end - start) for t in texts)


def prepared_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Row number of every word, and the words, of an array of space-separated texts."""
    split = pc.split_pattern(pc.fill_null(texts.cast(pa.large_string()), ""), " ")
    counts = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    words = pc.list_flatten(split)
    present = pc.not_equal(words, "")
    rows = np.repeat(np.arange(len(texts), dtype=np.int64), counts)
    return rows[present.to_numpy(zero_copy_only=False)], words.filter(present)


def _sum_by_row(rows: np.ndarray, values: np.ndarray | None, n: int) -> np.ndarray:
    # sums of integers below 2**53 are exact in doubles
    return np.bincount(rows, weights=values, minlength=n).astype(np.int64)


def count_overlap(texts_a: pa.Array, texts_b: pa.Array) -> dict[str, np.ndarray]:
    """The integer sums of :data:`OVERLAP_FIELDS` for two arrays of prepared texts."""
    n = len(texts_a)
    rows_a, words_a = prepared_words(texts_a)
    rows_b, words_b = prepared_words(texts_b)
    coded = pa.concat_arrays([words_a, words_b]).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(len(coded.dictionary), 1)
    terms_a, tf_a = np.unique(rows_a * width + codes[: len(words_a)], return_counts=True)
    terms_b, tf_b = np.unique(rows_b * width + codes[len(words_a) :], return_counts=True)
    at = np.searchsorted(terms_b, terms_a)
    met = np.zeros(len(terms_a), dtype=bool)
    inside = at < len(terms_b)
    met[inside] = terms_b[at[inside]] == terms_a[inside]
    both, a, b = terms_a[met] // width, tf_a[met], tf_b[at[met]]
    of_a, of_b = terms_a // width, terms_b // width
    return {
        "dot": _sum_by_row(both, a * b, n),
        "shared_a": _sum_by_row(both, a * a, n),
        "shared_b": _sum_by_row(both, b * b, n),
        "total_a": _sum_by_row(of_a, tf_a * tf_a, n),
        "total_b": _sum_by_row(of_b, tf_b * tf_b, n),
        "common": _sum_by_row(both, None, n),
        "distinct_a": _sum_by_row(of_a, None, n),
        "distinct_b": _sum_by_row(of_b, None, n),
        "length_a": _sum_by_row(rows_a, None, n),
        "length_b": _sum_by_row(rows_b, None, n),
    }


def overlap_of_slices(slices: Iterable[tuple[pa.Array, pa.Array]]) -> pa.Array:
    """:data:`OVERLAP_TYPE` for slices of two columns of prepared texts, one slice at a time."""
    parts = [count_overlap(*part) for part in slices]
    sums = {name: np.concatenate([np.zeros(0, np.int64), *[part[name] for part in parts]]) for name in OVERLAP_FIELDS}
    return pa.StructArray.from_arrays(
        [pa.array(sums[name], pa.int64()) for name in OVERLAP_FIELDS], names=list(OVERLAP_FIELDS)
    )


def _once(function):
    """Keep the optimizer from copying the call into filters and running it again there."""
    return function.asNondeterministic()


@_once
@F.arrow_udf(OVERLAP_TYPE)
def overlap_sums(texts_a: pa.Array, texts_b: pa.Array) -> pa.Array:
    """Struct of integer sums that every pair measure is made of, from two prepared texts.

    ``dot`` is the sum of tf_a * tf_b, ``shared_*`` and ``total_*`` are sums of tf squared over
    shared and over all terms, ``common`` and ``distinct_*`` count terms, ``length_*`` tokens.
    """
    return overlap_of_slices(text_slices(SLICE_CHARS, texts_a, texts_b))


@_once
@F.arrow_udf(SHARED_TYPE)
def shared_sums(
    small_keys: pa.Array, small_tf: pa.Array, large_keys: pa.Array, large_tf: pa.Array
) -> pa.Array:
    """Sums over the shared terms of two bags of term keys, each sorted by key."""
    lists = [
        (array.offsets.to_numpy(), array.values.to_numpy(zero_copy_only=False))
        for array in (small_keys, small_tf, large_keys, large_tf)
    ]
    (start_s, keys_s), (start_st, tf_s), (start_l, keys_l), (start_lt, tf_l) = lists
    n = len(small_keys)
    keys_s, tf_s = keys_s[start_s[0] : start_s[-1]], tf_s[start_st[0] : start_st[-1]].astype(np.int64)
    keys_l, tf_l = keys_l[start_l[0] : start_l[-1]], tf_l[start_lt[0] : start_lt[-1]].astype(np.int64)
    rows_s, rows_l = np.repeat(np.arange(n), np.diff(start_s)), np.repeat(np.arange(n), np.diff(start_l))
    # all rows at once: keys become their rank in the batch, rows come first
    known, codes = np.unique(np.concatenate((keys_s, keys_l)), return_inverse=True)
    width = max(len(known), 1)
    mine, theirs = rows_s * width + codes[: len(keys_s)], rows_l * width + codes[len(keys_s) :]
    at = np.minimum(np.searchsorted(theirs, mine), max(len(theirs) - 1, 0))
    met = theirs[at] == mine if len(theirs) else np.zeros(len(mine), dtype=bool)
    rows, s, t = rows_s[met], tf_s[met], tf_l[at[met]] if len(theirs) else tf_l[:0]
    sums = [_sum_by_row(rows, x, n) for x in (s * t, s * s, t * t)]
    return pa.StructArray.from_arrays(
        [pa.array(values, pa.int64()) for values in sums], names=list(SHARED_FIELDS)
    )
