"""Repeated word spans by compacting the graph of word windows.

Every run of 50 words is an edge of a De Bruijn graph over the corpus. Runs of edges that share their
least inner k-mer (the anchor) form one path; only the path goes through Spark: its anchor, a hash of its
words, its source and place. Equal paths are one row after a grouping, so a repeated stretch that does not
branch is settled by one join. Where one anchor has several paths, the graph branches there, and these
paths are opened into their single edges. Sources and places of paths and edges give the words to remove.

An anchor is chosen by the words of its window alone, so equal windows have equal anchors. Paths and edges
are compared by two independent 64-bit hashes, of the anchor and of all their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsim.llm.words import Sequences, batches, mix, signed, values, word_hashes, words
from docsim.session import written

WINDOW = 50
ANCHOR = 12
PLACE_BITS = 20
BLOCK = (1 << PLACE_BITS) - 1


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every run of ``width``."""
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out


def paths(hashes: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, content hash, first window and number of windows of each path of a text."""
    n = len(hashes) - window + 1
    if n <= 0:
        empty = np.zeros(0, np.int64)
        return empty.astype(np.uint64), empty.astype(np.uint64), empty, empty
    kmers = Sequences(hashes, 1).of(np.arange(len(hashes) - anchor + 1), anchor)
    inner = window - anchor + 1
    order = mix(kmers + np.uint64(5)) & ~np.uint64(BLOCK)
    chosen = np.zeros(n, np.int64)
    step = BLOCK - inner
    for at in range(0, n, step):
        part = order[at : at + step + inner - 1]
        packed = part | np.arange(len(part), dtype=np.uint64)
        chosen[at : at + step] = (_sliding_min(packed, inner) & np.uint64(BLOCK)).astype(np.int64)[: n - at] + at
    starts = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
    counts = np.diff(np.append(starts, n))
    content = Sequences(hashes, 2).of(starts, counts + window - 1)
    return kmers[chosen[starts]], content, starts, counts


def _path_rows(schema: pa.Schema, window: int, anchor: int) -> Callable:
    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            out: list[list] = [[] for _ in range(6)]
            for doc, digest, text in values(*batch.columns):
                a, c, s, n = paths(word_hashes(words(text)), window, anchor)
                for column, value in zip(out, (signed(a), signed(c), np.full(len(s), doc), np.full(len(s), digest), s, n)):
                    column.append(value)
            yield from batches(schema, [np.concatenate(c) if c else [] for c in out])

    return run


def _edge_rows(schema: pa.Schema, window: int) -> Callable:
    """Opened paths: a row per window with its hash."""

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for text, opened in values(batch.column(0), batch.column(1)):
                sequences = Sequences(word_hashes(words(text)), 3)
                starts = np.array([o["start"] for o in opened], np.int64)
                counts = np.array([o["n"] for o in opened], np.int64)
                which = np.repeat(np.arange(len(opened)), counts)
                offset = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
                fields = [np.array([o[k] for o in opened], np.int64)[which] for k in ("anchor", "content", "first")]
                edges = signed(sequences.of(starts[which] + offset, window))
                yield from batches(schema, [fields[0], edges, fields[1], fields[2], offset])

    return run


def _arrow(ddl: dict[str, pa.DataType]) -> tuple[str, pa.Schema]:
    names = {pa.int64(): "bigint", pa.int32(): "int"}
    return ", ".join(f"{k} {names[v]}" for k, v in ddl.items()), pa.schema(list(ddl.items()))


def removed_spans(documents: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id``, ``digest``, ``spans``: the word spans (start, end) that an earlier document holds.

    ``documents`` has ``doc_id`` (bigint, not null), ``digest`` (of the text) and ``text``.
    """
    ddl, schema = _arrow({"anchor": pa.int64(), "content": pa.int64(), "doc_id": pa.int64(), "digest": pa.int64(), "start": pa.int32(), "n": pa.int32()})
    found = written(documents.select("doc_id", "digest", "text").mapInArrow(_path_rows(schema, window, anchor), ddl), "paths")
    contents = written(
        found.groupBy("anchor", "content").agg(
            F.min(F.struct("doc_id", "digest", "start")).alias("source"), F.max("doc_id").alias("last"), F.first("n").alias("n")
        ),
        "path-contents",
    )
    branching = contents.groupBy("anchor").agg(F.count("*").alias("ways")).where("ways > 1").select("anchor")
    opened = contents.join(branching, "anchor", "left_semi").select(
        F.col("source.doc_id").alias("doc_id"), F.col("source.digest").alias("digest"),
        F.struct("anchor", "content", F.col("source.doc_id").alias("first"), F.col("source.start").alias("start"), "n").alias("o"),
    )
    per_text = opened.groupBy("doc_id", "digest").agg(F.collect_list("o").alias("opened"))  # a text has at most one path per word
    texts = documents.select("doc_id", "digest", "text").dropDuplicates(["doc_id", "digest"])
    ddl, schema = _arrow({"anchor": pa.int64(), "edge": pa.int64(), "content": pa.int64(), "first": pa.int64(), "at": pa.int32()})
    edges = written(
        texts.join(per_text, ["doc_id", "digest"]).select("text", "opened").mapInArrow(_edge_rows(schema, window), ddl), "edges"
    )
    earliest = edges.groupBy("anchor", "edge").agg(F.min("first").alias("least"), F.max("first").alias("most")).where("least < most")
    known = edges.join(earliest, ["anchor", "edge"]).where("first > least").groupBy("anchor", "content").agg(F.collect_set("at").alias("at"))
    repeated = contents.where("source.doc_id < last").select("anchor", "content", F.col("source.doc_id").alias("first"))
    marks = repeated.join(known, ["anchor", "content"], "full_outer").select("anchor", "content", "first", "at")
    # a path seen before in a smaller document goes as a whole; in its first document go the edges seen elsewhere
    whole = F.when(F.col("doc_id") > F.col("first"), F.array(F.struct(F.col("start").alias("start"), (F.col("start") + F.col("n") + (window - 1)).alias("end"))))
    single = F.transform("at", lambda a: F.struct((F.col("start") + a).alias("start"), (F.col("start") + a + window).alias("end")))
    spans = found.join(marks, ["anchor", "content"]).select("doc_id", "digest", F.explode(F.coalesce(whole, single)).alias("s"))
    return spans.groupBy("doc_id", "digest").agg(F.collect_set("s").alias("spans"))


def _kept(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        sizes, gone, digests = [], [], []
        for text, spans in values(batch.column(1), batch.column(2)):
            parts = words(text)
            cover = np.zeros(len(parts) + 1, np.int64)
            for s in spans or ():
                cover[s["start"]] += 1
                cover[s["end"]] -= 1
            free = np.cumsum(cover[:-1]) == 0
            kept = [parts[k] for k in np.flatnonzero(free).tolist()] if spans else parts
            sizes.append(len(parts))
            gone.append(len(parts) - len(kept))
            digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256"],
        )


def substring_dedup(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` for every row.

    A word goes where a window of ``window`` words covers it that also starts in a row with a smaller id.
    Null and empty texts have no words. Rows with a null id are kept whole and take nothing from others;
    rows that share an id take nothing from each other. Other columns are ignored.
    """
    rows = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text_col).alias("digest"), F.col(text_col).alias("text"))
    spans = removed_spans(rows.where("doc_id IS NOT NULL AND text IS NOT NULL"), window, anchor)
    joined = rows.join(spans, ["doc_id", "digest"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_kept, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")
