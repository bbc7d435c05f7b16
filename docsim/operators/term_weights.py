"""TF-IDF weights of the texts of a row, computed over whole Arrow batches.

A fitted vocabulary has a fixed size and goes with the function, as a model does; both texts of a pair stand
in one row. So weights, features and the sum of a linear model need no shuffle, and no row is opened into its
terms unless the terms are asked for.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsim.functions.overlap import prepared_words, text_slices

# Characters of text that are opened into terms at once.
CHUNK_CHARS = 1_000_000


@dataclass(frozen=True)
class TermTable:
    """A vocabulary as arrays: terms, their numbers, idf, and the two coefficients of a model, if there is one."""

    terms: pa.Array
    idx: np.ndarray
    idf: np.ndarray
    coefs: tuple[np.ndarray, np.ndarray] | None
    width: int

    @staticmethod
    def of(vocabulary: DataFrame) -> TermTable:
        """The rows of ``term, idx, idf`` (and ``difference_coef, product_coef``), which are as many as the vocabulary allows."""
        names = [c for c in ("difference_coef", "product_coef") if c in vocabulary.columns]
        table = vocabulary.select("term", F.col("idx").cast("bigint").alias("idx"), "idf", *names).toArrow()
        columns = {name: table[name].to_numpy() for name in table.column_names if name != "term"}
        coefs = (columns["difference_coef"], columns["product_coef"]) if len(names) == 2 else None
        terms = table["term"].combine_chunks().cast(pa.large_string())
        return TermTable(terms, columns["idx"], columns["idf"], coefs, int(columns["idx"].max(initial=0)) + 1)


def chunks(*texts: pa.Array) -> Iterator[tuple[pa.Array, ...]]:
    """Slices of columns of texts with about ``CHUNK_CHARS`` characters."""
    return text_slices(CHUNK_CHARS, *texts)


def gram_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row and code of every word and every two neighbouring words of prepared texts, and the term of each code.

    Words become numbers first, so a term that comes often is spelled out once.
    """
    rows, words = prepared_words(texts)
    coded = words.dictionary_encode()
    first = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    width = len(coded.dictionary)
    inside = rows[1:] == rows[:-1]
    met = pa.array((first[:-1] * width + first[1:])[inside]).dictionary_encode()
    both = met.dictionary.to_numpy(zero_copy_only=False).astype(np.int64)
    left, right = (coded.dictionary.take(pa.array(part)) for part in np.divmod(both, max(width, 1)))
    pairs = pc.binary_join_element_wise(left, right, pa.scalar(" ", words.type))
    codes = np.concatenate((first, met.indices.to_numpy(zero_copy_only=False).astype(np.int64) + width))
    return np.concatenate((rows, rows[1:][inside])), codes, pa.concat_arrays([coded.dictionary, pairs])


def unit_weights(texts: pa.Array, table: TermTable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of each known term of each row (row * width + idx, rising), its row in the table, and its weight.

    The weights of a row have length one.
    """
    rows, codes, terms = gram_codes(texts)
    at = pc.fill_null(pc.index_in(terms, value_set=table.terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)[codes]
    known = at >= 0
    at = at[known]
    places, first, tf = np.unique(rows[known] * table.width + table.idx[at], return_index=True, return_counts=True)
    weights = tf * table.idf[at[first]]
    norms = np.sqrt(np.bincount(places // table.width, weights=weights * weights, minlength=len(texts)))
    return places, at[first], weights / norms[places // table.width]


@dataclass(frozen=True)
class PairTerms:
    """The known terms of pairs of texts: row, vocabulary number, place in the table, and both weights."""

    rows: np.ndarray
    idx: np.ndarray
    at: np.ndarray
    a: np.ndarray
    b: np.ndarray

    @property
    def difference(self) -> np.ndarray:
        return np.abs(self.a - self.b)

    @property
    def product(self) -> np.ndarray:
        return self.a * self.b


def pair_terms(texts_a: pa.Array, texts_b: pa.Array, table: TermTable) -> PairTerms:
    (places_a, at_a, w_a), (places_b, at_b, w_b) = (unit_weights(t, table) for t in (texts_a, texts_b))
    places = np.union1d(places_a, places_b)
    a, b, at = np.zeros(len(places)), np.zeros(len(places)), np.zeros(len(places), np.int64)
    for into, own, values, known in ((a, places_a, w_a, at_a), (b, places_b, w_b, at_b)):
        spot = np.searchsorted(places, own)
        into[spot], at[spot] = values, known
    return PairTerms(places // table.width, places % table.width, at, a, b)


def _lists(rows: np.ndarray, n: int, values: pa.Array) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=n)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _whole(parts: list[pa.Array], kind: pa.DataType) -> pa.Array:
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def _column(kind: str, arrow: pa.DataType, row_structs: Callable, *names: str) -> Column:
    """A struct per row from a function of slices of the named text columns; computed once per row."""

    def of(*texts: pa.Array) -> pa.Array:
        return _whole([row_structs(*part) for part in chunks(*texts)], arrow)

    one = F.arrow_udf(lambda a: of(a), kind) if len(names) == 1 else F.arrow_udf(lambda a, b: of(a, b), kind)
    return one.asNondeterministic()(*[F.col(name) for name in names])


def text_weights(table: TermTable, prepared_col: str) -> Column:
    """``array<struct<idx, term, weight>>`` of a prepared text, by idx."""
    fields = [pa.field("idx", pa.int32()), pa.field("term", pa.string()), pa.field("weight", pa.float64())]

    def of(texts: pa.Array) -> pa.Array:
        places, at, weights = unit_weights(texts, table)
        terms = table.terms.take(pa.array(at)).cast(pa.string())
        rows = pa.StructArray.from_arrays([pa.array(table.idx[at].astype(np.int32)), terms, pa.array(weights)], fields=fields)
        return _lists(places // table.width, len(texts), rows)

    return _column("array<struct<idx:int,term:string,weight:double>>", pa.list_(pa.struct(fields)), of, prepared_col)


def pair_term_rows(table: TermTable) -> Callable:
    """From rows ``id, processed_a, processed_b`` to rows ``id, idx, difference, product``, slice by slice.

    The terms of a slice leave the task before the next is opened.
    """

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            start = 0
            for texts_a, texts_b in chunks(batch.column(1), batch.column(2)):
                met = pair_terms(texts_a, texts_b, table)
                ids = batch.column(0).slice(start, len(texts_a)).take(pa.array(met.rows))
                columns = [ids, pa.array(met.idx.astype(np.int32)), pa.array(met.difference), pa.array(met.product)]
                yield pa.RecordBatch.from_arrays(columns, names=[batch.schema.names[0], "idx", "difference", "product"])
                start += len(texts_a)

    return run


def pair_weights(table: TermTable, col_a: str, col_b: str) -> Column:
    """``array<struct<idx, difference, product>>`` of two prepared texts, by idx."""
    fields = [pa.field("idx", pa.int32()), pa.field("difference", pa.float64()), pa.field("product", pa.float64())]

    def of(texts_a: pa.Array, texts_b: pa.Array) -> pa.Array:
        met = pair_terms(texts_a, texts_b, table)
        columns = [pa.array(met.idx.astype(np.int32)), pa.array(met.difference), pa.array(met.product)]
        return _lists(met.rows, len(texts_a), pa.StructArray.from_arrays(columns, fields=fields))

    return _column("array<struct<idx:int,difference:double,product:double>>", pa.list_(pa.struct(fields)), of, col_a, col_b)


def linear_sums(table: TermTable, col_a: str, col_b: str) -> Column:
    """``struct<term_sum, cosine>``: the terms' part of a linear model, and the sum of products."""
    names = ["term_sum", "cosine"]

    def of(texts_a: pa.Array, texts_b: pa.Array) -> pa.Array:
        met = pair_terms(texts_a, texts_b, table)
        differ, shared = (c[met.at] for c in table.coefs)
        parts = (met.difference * differ + met.product * shared, met.product)
        return pa.StructArray.from_arrays([pa.array(np.bincount(met.rows, weights=p, minlength=len(texts_a))) for p in parts], names=names)

    kind = pa.struct([pa.field(name, pa.float64()) for name in names])
    return _column("struct<term_sum:double,cosine:double>", kind, of, col_a, col_b)
