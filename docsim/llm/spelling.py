"""Words of a corpus grouped with their spelling variants, by one-edit neighbourhoods of reduced words.

Letters are hashed to a few symbols. A word of the vocabulary becomes a reduced word of the same length, and
two words one edit apart have reduced words at most one edit apart. For every reduced word its whole
neighbourhood is generated: itself, what one deletion leaves, and every replacement of one symbol.
(Insertions are the deletions of the longer word, and of two words that replace into each other only one
generates the other, so each pair of reduced words is met from one side.) The neighbourhoods meet the
reduced vocabulary in an equality join, and only pairs that are found are verified, on the words
themselves, inside the join that brings the words back.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsim.llm.words import text_bytes, values
from docsim.session import written

SYMBOLS = 8
MIN_LENGTH = 5
MIN_COUNT = 3
RATIO = 2
ONE_IN = 97
#: Words that a task counts before it hands them on.
HELD = 200_000

# Fixed value: what counts as a letter, after A-Z are lower-cased.
LETTERS = re.compile("[a-zÀ-ÿ]+")


def symbol(letter: str, symbols: int = SYMBOLS) -> str:
    """The symbol that a letter is hashed to."""
    return chr(ord("a") + xxhash.xxh32_intdigest(letter) % symbols)


def reduced_column(word: Column, symbols: int = SYMBOLS) -> Column:
    letters = "".join(chr(c) for c in [*range(0x61, 0x7B), *range(0xC0, 0x100)])
    return F.translate(word, letters, "".join(symbol(c, symbols) for c in letters))


def _counts(misspell: bool):
    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])

        for batch in stream:
            for key, text in values(batch.column(0), batch.column(1)):
                found = Counter(LETTERS.findall(text_bytes(text).lower().decode("utf-8", "replace")))
                start = zlib.crc32(f"{key}:".encode())
                for word, n in found.items():
                    if misspell and key is not None:
                        h = zlib.crc32(word.encode(), start)
                        if not h % ONE_IN:
                            h %= len(word)
                            word = word[:h] + word[h + 1 :]
                    total[word] = total.get(word, 0) + n
                if len(total) > HELD:
                    yield out()
                    total.clear()
        if total:
            yield out()

    return run


def vocabulary(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", misspell: bool = False,
    min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
) -> DataFrame:
    """``word``, ``n`` of every word of at least ``min_length`` letters that comes ``min_count`` times or more.

    ``misspell`` takes a letter out of one word of a document in 97: for ``h = crc32("<id>:<word>")``, the
    letter at ``h % length`` goes where 97 divides ``h``. Counts are added up inside a task first.
    """
    texts = documents.select(F.col(id_col).cast("string"), F.col(text_col).alias("text"))
    counted = texts.mapInArrow(_counts(misspell), "word string, n bigint")
    counted = counted.where(F.length("word") >= min_length).groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= min_count)


def neighbourhood(reduced: Column, symbols: int = SYMBOLS) -> Column:
    """A reduced word, every word one deletion makes of it, and every one that replaces a symbol by an earlier one."""

    def without(i: Column) -> Column:
        return F.concat(F.substring(reduced, F.lit(1), i - 1), F.substring(reduced, i + 1, F.length(reduced)))

    def replaced(i: Column) -> Column:
        lower = F.array(*[F.lit(chr(ord("a") + k)) for k in range(symbols)])
        lower = F.slice(lower, F.lit(1), F.ascii(F.substring(reduced, i, F.lit(1))) - ord("a"))
        head, tail = F.substring(reduced, F.lit(1), i - 1), F.substring(reduced, i + 1, F.length(reduced))
        return F.transform(lower, lambda s: F.concat(head, s, tail))

    places = F.sequence(F.lit(1), F.length(reduced))
    return F.array_distinct(
        F.concat(F.array(reduced), F.transform(places, without), F.flatten(F.transform(places, replaced)))
    )


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """``a``, ``n_a``, ``b``, ``n_b`` for every two words of ``words`` (``word``, ``n``) one edit apart, once."""
    words = words.withColumn("reduced", reduced_column(F.col("word"), symbols))
    reduced = words.select("reduced").distinct()
    around = reduced.select(F.col("reduced").alias("r_a"), F.explode(neighbourhood(F.col("reduced"), symbols)).alias("r_b"))
    met = around.join(reduced.select(F.col("reduced").alias("r_b")), "r_b", "left_semi")
    first = words.select(F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("reduced").alias("r_a"))
    second = words.select(F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("reduced").alias("r_b"))
    one_edit = (F.levenshtein("a", "b", 1) == 1) & ((F.col("r_a") != F.col("r_b")) | (F.col("a") < F.col("b")))
    return first.join(met, "r_a").join(second, "r_b").where(one_edit).select("a", "n_a", "b", "n_b")


def forms(words: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word``, ``n``, ``form``, ``form_n``, ``n_near``: the most frequent near word, if it is ``ratio`` times as frequent.

    Of equally frequent near words the first in code-point order is taken.
    """
    sides = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")),
    )
    near = pairs.select(F.inline(sides)).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    )
    enough = -F.col("best.less") >= ratio * F.col("n")
    return words.join(near, "word", "left").select(
        "word",
        "n",
        F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.less")).alias("form_n"),
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
    )


def roots(formed: DataFrame) -> DataFrame:
    """``word``, ``root`` of every word that has a form: the last word on the way from form to form.

    A form is more frequent than its word, so ways end. Each round doubles the steps of every way and is
    written; the rounds grow with the logarithm of the longest way.
    """
    ways = written(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "ways")
    while True:
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = written(ways.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "ways")
        if longer.where("moved").isEmpty():
            return longer.select("word", "root")
        ways = longer.select("word", "root")


def spelling_variants(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", misspell: bool = False,
    min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every word of the vocabulary.

    Null and empty texts have no words; repeated rows count as often as they come; a row with a null id
    counts and is not misspelt; ties between near words go by code points; an empty table gives no rows;
    other columns are ignored. A letter sequence of any length is one word.
    """
    words = written(vocabulary(documents, id_col, text_col, misspell, min_length, min_count), "vocabulary")
    formed = written(forms(words, near_words(words)), "forms")
    return formed.join(roots(formed), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
