"""Text column functions: normalising, tokenising, language marks, previews.

Everything here is a ``Column -> Column`` expression, so it runs inside the scan stage and shuffles nothing.
All are Spark built-ins but three: the content words of a text are picked over whole Arrow batches, those of two
texts compared, and language marks counted (:mod:`docsim.functions.content_words`), as a lambda per word, a pattern
per text, lower case and accents text by text took most of the time.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from docsim.functions.content_words import (
    GONE, SIGN, SPACE, Preparation, content_overlap_column, content_words_column, more_markers_column,
    packed,
)

# The stopword list (Spanish, then English).
STOPWORDS = (
    "el la los las un una unos unas de del al a ante bajo con contra desde durante en entre "
    "hacia hasta para por segun sin sobre tras y o u e que se su sus lo como mas pero porque ya "
    "si no es son fue ser estar esta este estos estas tambien donde cuando cual cuales quien "
    "quienes "
    "the a an and or but of to in on at for with without is are was were be been being this that "
    "these those there their his her its as by"
).split()

# The language markers.
SPANISH_MARKERS = (
    "el la los las que para con documento sistema investigacion academico universidad"
).split()
ENGLISH_MARKERS = (
    "the and for with document system research academic university person children"
).split()

# Sizes.
MIN_TOKEN_LENGTH = 3
MIN_DOCUMENT_TOKENS = 10

# The Unicode white space that a text pattern's ``\s`` stands for, as a Java character class body.
SPACE_CLASS = r"\s\x1c-\x1f\x85\p{Z}"
LINK_PATTERN = rf"http[^{SPACE_CLASS}]+|www[^{SPACE_CLASS}]+"


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """``translate`` arguments: accented characters to their base, combining marks to nothing.

    Built from the Unicode database: every code point whose canonical decomposition without
    combining marks is one ASCII letter or digit, then every combining mark (deleted, because
    the target string is shorter than the source string).
    """
    source, target, marks = [], [], []
    for point in range(128, sys.maxunicode + 1):
        char = chr(point)
        if unicodedata.category(char) == "Mn":
            marks.append(char)
            continue
        if not unicodedata.decomposition(char):
            continue
        base = "".join(
            part for part in unicodedata.normalize("NFD", char) if unicodedata.category(part) != "Mn"
        )
        if len(base) == 1 and base.isascii() and base.isalnum():
            source.append(char)
            target.append(base)
    return "".join(source + marks), "".join(target)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``.

    Spark would otherwise evaluate the expression again at every use inside a condition or,
    inside a lambda, for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def remove_accents(text: Column) -> Column:
    """Drop accents. Texts of ASCII bytes only skip the per-character lookup."""
    source, target = accent_table()
    return F.when(F.octet_length(text) == F.char_length(text), text).otherwise(
        F.translate(text, source, target)
    )


def remove_links(text: Column) -> Column:
    """Replace links by a space. Texts without a link mark skip the pattern."""
    return F.when(
        text.contains("http") | text.contains("www"), F.regexp_replace(text, LINK_PATTERN, " ")
    ).otherwise(text)


def _plain(text: Column) -> Column:
    """Lower case, no accents, no links."""
    return bind(bind(F.lower(F.coalesce(text, F.lit(""))), remove_accents), remove_links)


def normalize_text(text: Column) -> Column:
    """Lower case, no accents, no links, ASCII letters and digits separated by one space."""
    return F.trim(F.regexp_replace(_plain(text), "[^a-z0-9]+", " "))


def tokenize(text: Column) -> Column:
    """Words of the normalised text, in order, repeats kept."""
    return F.filter(F.split(normalize_text(text), " "), lambda word: word != "")


def filter_stopwords(tokens: Column) -> Column:
    """Drop stopwords and words shorter than three characters."""
    return F.filter(
        tokens,
        lambda word: (F.length(word) >= MIN_TOKEN_LENGTH) & ~word.isin(*sorted(set(STOPWORDS))),
    )


def content_tokens(text: Column) -> Column:
    """The tokens that are compared: normalised, tokenised, without stopwords."""
    return filter_stopwords(F.split(normalize_text(text), " "))


@lru_cache(maxsize=1)
def preparation() -> Preparation:
    """Lower case, accents, white space and signs as one byte per code point, and the words to drop.

    Equal to lower-casing and :func:`remove_accents`, where the only character that becomes two is the dotted
    capital I, whose second one is a mark.
    """
    source, target = accent_table()
    plain = {char: ord(target[k]) if k < len(target) else GONE for k, char in enumerate(source)}
    plain |= {chr(c): c for c in range(128) if chr(c).isalnum()}
    spaces = {*"\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85"}
    points, letters = [], []
    for point in range(sys.maxunicode + 1):
        char = chr(point)
        if char in spaces or unicodedata.category(char)[0] == "Z":
            letter = SPACE
        else:
            letter = max(plain.get(c, SIGN) for c in char.lower())  # the letter, not its mark
        if letter != SIGN:
            points.append(point)
            letters.append(letter)
    return Preparation(np.array(points, np.int64), np.array(letters, np.uint8), packed(STOPWORDS), MIN_TOKEN_LENGTH)


@lru_cache(maxsize=1)
def _content_words() -> Callable[[Column], Column]:
    return content_words_column(preparation())


@lru_cache(maxsize=1)
def _content_overlap() -> Callable[[Column, Column], Column]:
    return content_overlap_column(preparation())


def prepare_text(text: Column) -> Column:
    """Content tokens joined by one space: what joining :func:`content_tokens` gives."""
    return _content_words()(text)


def content_overlap(text_a: Column, text_b: Column) -> Column:
    """``overlap_sums`` of the two prepared texts, from the raw ones."""
    return _content_overlap()(text_a, text_b)


def prepared_tokens(prepared: Column) -> Column:
    """Tokens of a text that is already prepared."""
    return F.filter(F.split(F.coalesce(prepared, F.lit("")), " "), lambda word: word != "")


def word_count(prepared: Column) -> Column:
    """Number of words of a prepared text, without building the array."""

    def count(text: Column) -> Column:
        spaces = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))
        return F.when(text == "", F.lit(0)).otherwise(spaces + 1)

    return bind(F.coalesce(prepared, F.lit("")), count)


def is_valid_document(text: Column) -> Column:
    """At least ten content tokens."""
    return word_count(prepare_text(text)) >= MIN_DOCUMENT_TOKENS


@lru_cache(maxsize=1)
def _languages() -> Callable[[Column], Column]:
    return more_markers_column({"spanish": SPANISH_MARKERS, "english": ENGLISH_MARKERS}, "unknown")


def detect_language(text: Column) -> Column:
    """``spanish``, ``english`` or ``unknown`` by the number of distinct markers in the raw text.

    A marker stands between spaces or at an end of the text, so it is one of the parts that spaces cut.
    """
    return _languages()(text)


def strip_spaces(text: Column) -> Column:
    """Trim every kind of Unicode white space on both ends."""
    return F.regexp_replace(text, rf"^[{SPACE_CLASS}]+|[{SPACE_CLASS}]+$", "")


def collapse_spaces(text: Column) -> Column:
    """Every run of Unicode white space becomes one space; both ends are trimmed."""
    return F.trim(F.regexp_replace(text, rf"[{SPACE_CLASS}]+", " "))


def is_blank(text: Column) -> Column:
    """Null, empty or white space only."""
    return F.coalesce(~text.rlike(rf"[^{SPACE_CLASS}]"), F.lit(True))


def text_length(text: Column) -> Column:
    """Length in characters; null counts as empty."""
    return F.length(F.coalesce(text, F.lit("")))


def safe_filename(name: Column) -> Column:
    """Spaces become underscores."""
    return F.translate(name, " ", "_")


def is_pdf_name(name: Column) -> Column:
    """The name ends with ``.pdf`` in any letter case."""
    return F.lower(name).endswith(".pdf")


def preview(text: Column, length: int) -> Column:
    """First ``length`` characters, for display."""
    return F.substring(F.coalesce(text, F.lit("")), 1, length)
