"""Content words of texts, picked over whole Arrow batches.

Columns of the row go in and one comes out, so Spark's partitioning is untouched and nothing is shuffled.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from docsim.functions.overlap import OVERLAP_TYPE, SLICE_CHARS, overlap_of_slices, text_slices

# Bytes of a word that are compared with the words to drop, which must not be longer.
PACKED = 8
# Bytes of a plain text beside letters and digits: white space, any other sign, and what is left out.
SPACE, SIGN, GONE = ord(" "), ord("."), 0
_LINK_START, _LINK = re.compile(rb"http|www"), re.compile(rb"http[^ ]+|www[^ ]+")
_WORD_BYTES = np.isin(np.arange(256), np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789", np.uint8))


def packed(words: Iterable[str]) -> np.ndarray:
    """Words as integers, in order."""
    whole = [word.encode() for word in words]
    if any(len(word) > PACKED for word in whole):
        raise ValueError(f"words to drop have {PACKED} bytes at most")
    return np.array(sorted({int.from_bytes(word, "little") for word in whole}), np.uint64)


@dataclass(frozen=True)
class Preparation:
    """How raw texts become content words: bytes of code points (all others are signs) and words to drop."""

    points: np.ndarray
    letters: np.ndarray
    dropped: np.ndarray
    shortest: int

    def table(self) -> np.ndarray:
        table = np.full(sys.maxunicode + 1, SIGN, np.uint8)
        table[self.points] = self.letters
        return table

    def words(self, texts: pa.Array) -> pa.Array:
        """The prepared texts of raw ones; null counts as empty."""
        table = self.table()
        parts = [picked(*plain_bytes(part, table), self.dropped, self.shortest) for (part,) in text_slices(SLICE_CHARS, texts)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each text begins and the last one ends."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def plain_bytes(texts: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One byte per character of lower-cased texts without accents, and offsets; links are blank."""
    texts = pc.fill_null(texts, "")
    data, offsets = _bytes_of(texts)
    codes = data
    if len(data) and data.max() >= 128:
        try:
            whole = data.tobytes().decode()
        except UnicodeDecodeError:  # broken characters become signs
            mended = [text.decode(errors="replace") for text in texts.cast(pa.binary()).to_pylist()]
            data, offsets = _bytes_of(pa.array(mended, pa.large_string()))
            whole = data.tobytes().decode()
        offsets = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offsets]
        codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    letters = table[codes]
    kept = letters != GONE
    if not kept.all():
        offsets = np.concatenate(([0], np.cumsum(kept)))[offsets]
        letters = letters[kept]
    marks = [mark.start() for mark in _LINK_START.finditer(letters.tobytes())]
    for row in np.unique(np.searchsorted(offsets, marks, "right") - 1) if marks else ():
        first = offsets[row]
        for link in _LINK.finditer(letters[first : offsets[row + 1]].tobytes()):
            letters[first + link.start() : first + link.end()] = SPACE
    return letters, offsets


def content_words(texts: pa.Array, dropped: np.ndarray, shortest: int) -> pa.Array:
    """Runs of a-z and 0-9 of each text, joined by one space, without ``dropped`` and those below ``shortest``."""
    return picked(*_bytes_of(texts), dropped, shortest)


def picked(data: np.ndarray, offsets: np.ndarray, dropped: np.ndarray, shortest: int) -> pa.Array:
    """:func:`content_words` of texts given by their bytes and offsets."""
    if not len(data):
        return pa.array([""] * (len(offsets) - 1), pa.string())
    inside = _WORD_BYTES[data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    # a text begins and ends words, even where the next one goes on without a space
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    begin[edge], end[edge - 1] = inside[edge], inside[edge - 1]
    first = np.flatnonzero(begin)
    size = np.flatnonzero(end) + 1 - first
    long = size >= shortest
    first, size = first[long], size[long]

    brief = np.flatnonzero(size <= PACKED)
    number = np.zeros(len(brief), np.uint64)
    for k in range(PACKED):
        letter = data[np.minimum(first[brief] + k, len(data) - 1)].astype(np.uint64)
        number |= np.where(k < size[brief], letter, np.uint64(0)) << np.uint64(8 * k)
    keep = np.ones(len(first), bool)
    if len(dropped):
        keep[brief] = dropped[np.minimum(np.searchsorted(dropped, number), len(dropped) - 1)] != number
    first, size = first[keep], size[keep]

    row_first = np.searchsorted(first, offsets)
    # spaces up to and with the one before each word: as many as words before it that are not the last of their text
    spaces = np.ones(len(first) + 1, np.int64)
    spaces[row_first[:-1]] = 0
    spaces = np.cumsum(spaces[: len(first)])
    letters = np.concatenate(([0], np.cumsum(size)))
    at = np.arange(letters[-1])
    out = np.full(letters[-1] + (spaces[-1] if len(spaces) else 0), ord(" "), np.uint8)
    out[at + np.repeat(spaces, size)] = data[at + np.repeat(first - letters[:-1], size)]
    ends = np.concatenate(([0], letters[1:] + spaces))
    bounds = ends[row_first].astype(np.int32)
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(bounds.tobytes()), pa.py_buffer(out.tobytes()))


def content_words_column(how: Preparation) -> Callable[[Column], Column]:
    """The prepared text of a raw one; computed once per row."""
    return F.arrow_udf(lambda texts: how.words(texts), "string").asNondeterministic()


def content_overlap_column(how: Preparation) -> Callable[[Column, Column], Column]:
    """``overlap_sums`` of the prepared texts of two raw ones.

    Texts are prepared and counted slice by slice in one worker: no prepared batch is held, and none is sent back.
    """
    return F.arrow_udf(
        lambda a, b: overlap_of_slices((how.words(x), how.words(y)) for x, y in text_slices(SLICE_CHARS, a, b)), OVERLAP_TYPE
    ).asNondeterministic()


def more_markers_column(markers: dict[str, Iterable[str]], otherwise: str) -> Callable[[Column], Column]:
    """The name whose markers are most among the parts of a text that spaces cut, in any letter case; computed once per row."""
    sets = {name: frozenset(words) for name, words in markers.items()}
    every = frozenset().union(*sets.values())

    def best(text: str) -> str:
        found = every.intersection(text.lower().split(" "))
        counts = sorted(((len(found & words), name) for name, words in sets.items()), reverse=True)
        return counts[0][1] if counts[0][0] > counts[1][0] else otherwise

    def of(texts: pa.Array) -> pa.Array:
        parts = (part for (part,) in text_slices(SLICE_CHARS, texts))
        whole = (text.decode(errors="replace") if text else "" for part in parts for text in part.cast(pa.binary()).to_pylist())
        return pa.array([best(text) for text in whole], pa.string())

    return F.arrow_udf(lambda texts: of(texts), "string").asNondeterministic()
