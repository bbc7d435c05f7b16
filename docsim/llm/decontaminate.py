"""Benchmark passages in documents: shared q-grams per diagonal band, then banded alignment.

Texts are compared as lower-case letters and digits with single spaces. Every benchmark item is cut into
overlapping pieces. A piece of length L that stands in a document with at most e edits shares at least
L - q + 1 - q*e of its q-grams with it, all inside a band of e + 1 diagonals; bands are 2(e + 1) wide and
overlap by half, so one of them holds the whole match. Bands that reach the bound are verified by a
banded edit distance.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from docsim.llm.words import text_bytes, values

Q = 8
PIECE = 96
STEP = 48
EDIT_SHARE = 0.08
SHORTEST = 24
BLOCK_CHARS = 4_000_000
TABLE_BITS = 22
SPAN = 1 << 20
MOST_HITS = 1 << 21  # q-gram hits held at once; a stretch with more is halved

_FOLD = np.full(256, 32, np.uint8)  # everything else is a gap
for _c in b"abcdefghijklmnopqrstuvwxyz0123456789":
    _FOLD[_c] = _c
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _FOLD[_c] = _c + 32
_FOLD[128:] = np.arange(128, 256)  # bytes of other letters stay


def folded(text: str | None) -> np.ndarray:
    """The compared form of a text as bytes: runs of other signs become one space."""
    raw = _FOLD[np.frombuffer(text_bytes(text), np.uint8)]
    gap = raw == 32
    keep = ~gap
    keep[1:] |= ~gap[:-1]
    raw = raw[keep]
    return raw[1:] if len(raw) and raw[0] == 32 else raw


def _grams(codes: np.ndarray) -> np.ndarray:
    """Every q-gram of eight bytes as one 64-bit number, exactly."""
    n = len(codes) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(codes, Q)).view("<u8").reshape(-1)


def _slots(grams: np.ndarray) -> np.ndarray:
    return ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


@dataclass
class Pieces:
    """The q-gram index of a block of benchmark pieces."""

    items: list
    texts: list[bytes]
    edits: np.ndarray
    needed: np.ndarray
    grams: np.ndarray
    owner: np.ndarray
    place: np.ndarray
    table: np.ndarray
    short: dict[bytes, list[tuple[list[bytes], object]]]  # words and item of short items, by their first word

    @staticmethod
    def build(rows: list[tuple], edit_share: float = EDIT_SHARE) -> Pieces:
        items, texts, short = [], [], {}
        for item, text in rows:
            codes = folded(text)
            while len(codes) and codes[-1] == 32:
                codes = codes[:-1]
            n = len(codes)
            if n < SHORTEST:
                if phrase := codes.tobytes().split():
                    short.setdefault(phrase[0], []).append((phrase, item))
                continue
            starts = range(0, max(1, n - PIECE + STEP), STEP) if n > PIECE else [0]
            for s in starts:
                s = min(s, max(0, n - PIECE))
                items.append(item)
                texts.append(codes[s : s + PIECE].tobytes())
        sizes = np.array([len(t) for t in texts], np.int64)
        edits = np.floor(sizes * edit_share).astype(np.int64)
        bound = sizes - Q + 1 - Q * edits
        edits = np.where(bound < 1, 0, edits)  # too short for the lemma: exact only
        needed = sizes - Q + 1 - Q * edits
        grams, owner, place = [], [], []
        for k, t in enumerate(texts):
            g = _grams(np.frombuffer(t, np.uint8))
            grams.append(g)
            owner.append(np.full(len(g), k, np.int64))
            place.append(np.arange(len(g)))
        if not texts:
            empty = np.zeros(0, np.int64)
            return Pieces([], [], empty, empty, np.zeros(0, np.uint64), empty, empty, np.zeros(1 << TABLE_BITS, bool), short)
        grams, owner, place = map(np.concatenate, (grams, owner, place))
        order = np.argsort(grams, kind="stable")
        grams, owner, place = grams[order], owner[order], place[order]
        table = np.zeros(1 << TABLE_BITS, bool)
        table[_slots(grams)] = True
        return Pieces(items, texts, edits, needed, grams, owner, place, table, short)

    def search(self, text: str | None) -> dict:
        """Least edits per item over its pieces found in the text; short items are found as whole words, without edits."""
        found: dict = {}
        codes = folded(text)
        if self.short:
            parts = codes.tobytes().split()
            for k, word in enumerate(parts):
                for phrase, item in self.short.get(word, ()):
                    if parts[k : k + len(phrase)] == phrase:
                        found[item] = 0
        for at in range(0, max(1, len(codes) - 1), SPAN):
            self._search(codes[max(0, at - 2 * PIECE) : at + SPAN], found)
        return found

    def _dense(self, known: np.ndarray) -> np.ndarray:
        """Places of q-grams known to the index, where enough of them lie within one piece's reach of each other."""
        sums = np.concatenate(([0], np.cumsum(known)))
        reach = PIECE + int(self.edits.max(initial=0))
        first = np.arange(len(known))
        rich = sums[np.minimum(first + reach, len(known))] - sums[first] >= (int(self.needed.min()) if len(self.needed) else 1)
        cover = np.zeros(len(known) + 1, np.int64)
        starts = np.flatnonzero(rich)
        cover[starts] += 1
        np.subtract.at(cover, np.minimum(starts + reach, len(known)), 1)
        return np.flatnonzero(known & (np.cumsum(cover[:-1]) > 0))

    def _search(self, codes: np.ndarray, found: dict) -> None:
        grams = _grams(codes)
        at = self._dense(self.table[_slots(grams)])
        if not len(at):
            return
        low = np.searchsorted(self.grams, grams[at], "left")
        count = np.searchsorted(self.grams, grams[at], "right") - low
        at, low, count = at[count > 0], low[count > 0], count[count > 0]
        if not len(at):
            return
        half, overlap = len(codes) // 2, PIECE + int(self.edits.max())
        if count.sum() > MOST_HITS and half > 2 * overlap:
            # any match lies whole in one of the halves
            self._search(codes[: half + overlap], found)
            self._search(codes[half - overlap :], found)
            return
        hit = np.repeat(low - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
        where, owner, place = np.repeat(at, count), self.owner[hit], self.place[hit]
        width = self.edits[owner] + 1
        diagonal = where - place + PIECE
        band = diagonal // width
        shift = len(codes) + 2 * PIECE + 2
        # a band is two strips wide: each q-gram counts for the band that starts at its strip and the one before
        keys = np.concatenate((owner * shift + band, owner * shift + band - 1))
        bands, shared = np.unique(keys, return_counts=True)  # a repeated q-gram counts twice: only more to verify
        bands = bands[shared >= self.needed[bands // shift]]
        for key in bands.tolist():
            k, b = divmod(key, shift)
            if found.get(self.items[k]) == 0:
                continue
            e = int(self.edits[k])
            first = b * (e + 1) - PIECE
            distance = best_distance(self.texts[k], codes[max(0, first - e) : first + 2 * (e + 1) + len(self.texts[k]) + e].tobytes(), e)
            if distance <= e and distance < found.get(self.items[k], e + 1):
                found[self.items[k]] = distance


def best_distance(piece: bytes, region: bytes, limit: int) -> int:
    """Least edit distance of ``piece`` to any substring of ``region``; ``limit + 1`` if above it.

    The region is the piece's band, so its length bounds the width of the alignment.
    """
    if piece in region:
        return 0
    if not limit:
        return 1
    window = np.frombuffer(region, np.uint8)
    steps = np.arange(len(window) + 1)
    row = np.zeros(len(window) + 1, np.int64)
    for letter in piece:
        new = row + 1
        new[1:] = np.minimum(new[1:], row[:-1] + (window != letter))
        row = np.minimum.accumulate(new - steps) + steps
        if row.min() > limit:
            return limit + 1
    return int(row.min())


def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple]]:
    """The benchmark in blocks of at most ``block_chars`` characters (one item at least), in order of item.

    A stated query set: each block is matched against all documents. Items come to the driver one
    partition at a time and only a block is held. Null items and texts are skipped.
    """
    rows = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).where(
        "item IS NOT NULL AND text IS NOT NULL"
    )
    block, size = [], 0
    for item, text in rows.distinct().orderBy("item", "text").toLocalIterator():
        if block and size + len(text) > block_chars:
            yield block
            block, size = [], 0
        block.append((item, text))
        size += len(text)
    if block:
        yield block


def matches(
    documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", edit_share: float = EDIT_SHARE, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``doc_id``, ``item_id``, ``edits``: every document with every item of which it holds a piece.

    ``edits`` is the least number of edits over the item's pieces. Null and empty texts hold nothing;
    an empty benchmark gives no rows; repeated documents give repeated rows; rows with null ids are
    returned with a null id. Items of fewer than ``SHORTEST`` folded bytes are found as whole words, without edits.
    """
    spark = documents.sparkSession
    item_type = benchmark.schema[item_col].dataType.simpleString()
    schema = f"doc_id {documents.schema[id_col].dataType.simpleString()}, item_id {item_type}, edits int"
    docs = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = None
    for block in benchmark_blocks(benchmark, item_col, item_text, block_chars):
        part = docs.mapInArrow(_matcher(block, edit_share, to_arrow_type(benchmark.schema[item_col].dataType)), schema)
        found = part if found is None else found.union(part)
    return found if found is not None else spark.createDataFrame([], schema)


def _matcher(block: list[tuple], edit_share: float, item_type: pa.DataType):
    def scan(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Pieces.build(block, edit_share)
        for batch in stream:
            ids, items, edits = [], [], []
            for doc, text in values(batch.column(0), batch.column(1)):
                for item, distance in index.search(text).items():
                    ids.append(doc)
                    items.append(item)
                    edits.append(distance)
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, batch.schema.field(0).type), pa.array(items, item_type), pa.array(edits, pa.int32())],
                    names=["doc_id", "item_id", "edits"],
                )

    return scan


def contaminated_column(benchmark: DataFrame, text_col: str, item_col: str = "item_id", item_text: str = "text",
                        edit_share: float = EDIT_SHARE, block_chars: int = BLOCK_CHARS):
    """A boolean column: the text holds a piece of some benchmark item; false for null texts."""
    column = F.lit(False)
    for block in benchmark_blocks(benchmark, item_col, item_text, block_chars):
        column = column | _contains(block, edit_share)(F.col(text_col))
    return column


def _contains(block: list[tuple], edit_share: float):
    index: list[Pieces] = []

    @F.arrow_udf("boolean")
    def holds(texts: pa.Array) -> pa.Array:
        if not index:
            index.append(Pieces.build(block, edit_share))
        return pa.array((bool(index[0].search(t)) for t in values(texts)), pa.bool_())

    return holds
