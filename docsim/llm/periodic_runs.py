"""Periodic runs of words: maximal pairs read off the tree of LCP intervals.

Suffixes of a word sequence, sorted, with the longest common prefix (LCP) of neighbours, nest into
intervals: all suffixes that share ``l`` words. Intervals are closed from the longest prefix up. Each holds
the places of its suffixes in text order, told apart by the word to their left. Two places of one interval
that lie in different children share exactly ``l`` words, and if their left words differ too, the pair is
maximal: the stretch from the first place to the end of the second copy cannot grow. With a distance of at
most a third of ``l`` the stretch holds four periods, and the pair is a run as it stands.

Only neighbours in text order need a look. If the places ``i < i + q`` form a run of smallest period ``q``,
no other suffix of the interval starts between them: it would give the ``l >= 3 q`` words a smaller period.
The other way round, places between ``i`` and ``i + p`` exist whenever ``p`` is not the smallest period. So
each run is met once, in the interval of its ``l``, when two children are merged.

Every run has ``l >= 5`` (six words of period one, eight of period two), so intervals of less are left out,
and texts in which no five words come twice within a fourth of their length have no run.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsim.llm.words import BASE, values, words

SHORTEST = 6
REPEATS = 4
LEAST_LCP = SHORTEST - 1

Run = tuple[int, int, int]  # start, length, period

COLUMNS = (
    "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)


def word_ids(parts: list[bytes]) -> np.ndarray:
    """The first place of each word: equal words and only these have equal numbers."""
    first: dict[bytes, int] = {}
    return np.fromiter(map(first.setdefault, parts, count()), np.int64, len(parts))


def may_repeat(ids: np.ndarray) -> bool:
    """False if no ``LEAST_LCP`` words come twice within ``1 / REPEATS`` of the text; true is not a proof."""
    n = len(ids) - LEAST_LCP + 1
    if n < 2:
        return False
    hashes = np.zeros(n, np.uint64)
    for k in range(LEAST_LCP):
        hashes = hashes * BASE + ids[k : k + n].astype(np.uint64)
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    return bool(((hashes[1:] == hashes[:-1]) & (np.diff(order) * REPEATS <= len(ids))).any())


def suffix_ranks(ids: np.ndarray) -> np.ndarray:
    """Rank of every suffix, by doubling; a suffix that is alone in its rank is not sorted again."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    heads = np.concatenate(([True], ids[order][1:] != ids[order][:-1]))
    start = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = start
    alone = heads & np.append(heads[1:], True)
    active, width = order[~alone], 1
    while len(active):
        follow = np.zeros(len(active), np.int64)
        inside = active + width < n
        follow[inside] = rank[active[inside] + width] + 1
        key = rank[active] * (n + 1) + follow
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        old = rank[active]
        place = np.arange(len(active))
        group = np.concatenate(([True], old[1:] != old[:-1]))
        heads = np.concatenate(([True], key[1:] != key[:-1]))
        first = np.maximum.accumulate(np.where(group, place, 0))
        start = np.maximum.accumulate(np.where(heads, place, 0))
        rank[active] = old + start - first
        alone = heads & np.append(heads[1:], True)
        active, width = active[~alone], 2 * width
    return rank


def neighbour_lcp(ids: list[int], order: list[int], rank: list[int]) -> list[int]:
    """Words that each sorted suffix shares with the one before it."""
    n, shared = len(ids), 0
    out = [0] * n
    for i, r in enumerate(rank):
        if not r:
            shared = 0
            continue
        j = order[r - 1]
        most = n - max(i, j)
        while shared < most and ids[i + shared] == ids[j + shared]:
            shared += 1
        out[r] = shared
        if shared:
            shared -= 1
    return out


def _merge(ids: list[int], shared: int, children: list, runs: list[Run]) -> list[int]:
    """Places of an interval, in text order, from those of its children; runs between children are added."""
    children = [[c] if isinstance(c, int) else c for c in children]
    most = shared // (REPEATS - 1)
    big = max(children, key=len)

    def met(i: int, j: int) -> None:
        if j - i <= most and (i == 0 or ids[i - 1] != ids[j - 1]):
            runs.append((i, j - i + shared, j - i))

    small = [c for c in children if c is not big]
    if len(small) == 1 and len(small[0]) == 1:
        (x,) = small[0]
        at = bisect_left(big, x)
        if at:
            met(big[at - 1], x)
        if at < len(big):
            met(x, big[at])
        big.insert(at, x)
        return big
    child = {x: k for k, places in enumerate(small) for x in places}
    merged = sorted([*big, *(x for places in small for x in places)])
    if 8 * len(child) < len(merged):
        for x in child:
            at = bisect_left(merged, x)
            if at and child.get(merged[at - 1]) != child[x]:
                met(merged[at - 1], x)
            if at + 1 < len(merged) and merged[at + 1] not in child:
                met(x, merged[at + 1])
    else:
        of = [child.get(x, -1) for x in merged]
        for k in range(1, len(merged)):
            if of[k] != of[k - 1]:
                met(merged[k - 1], merged[k])
    return merged


def find_runs(ids: np.ndarray) -> list[Run]:
    """All runs (start, length, smallest period) of at least ``SHORTEST`` words and ``REPEATS`` periods, in order."""
    if not may_repeat(ids):
        return []
    ranks = suffix_ranks(ids)
    suffixes = np.empty(len(ids), np.int64)
    suffixes[ranks] = np.arange(len(ids))
    symbols, order = ids.tolist(), suffixes.tolist()
    lcp = neighbour_lcp(symbols, order, ranks.tolist())
    runs: list[Run] = []
    lengths: list[int] = []
    open_children: list[list] = []
    long = np.flatnonzero(np.array(lcp) >= LEAST_LCP)
    for r in np.union1d(long, long + 1).tolist():
        shared = lcp[r] if r < len(lcp) else 0
        shared = shared if shared >= LEAST_LCP else 0
        last: int | list[int] = order[r - 1]
        while lengths and lengths[-1] > shared:
            open_children[-1].append(last)
            last = _merge(symbols, lengths.pop(), open_children.pop(), runs)
        if shared and lengths and lengths[-1] == shared:
            open_children[-1].append(last)
        elif shared:
            lengths.append(shared)
            open_children.append([last])
    return sorted(runs, key=lambda run: (run[0], run[2]))


def strongest(runs: Iterable[Run]) -> Run | None:
    """The run of greatest length/period, compared exactly; ties go to the least start, then period."""
    best = None
    for run in runs:
        if best is not None:
            ahead = run[1] * best[2] - best[1] * run[2]
            if ahead < 0 or ahead == 0 and (run[0], run[2]) >= (best[0], best[2]):
                continue
        best = run
    return best


def collapsed(parts: list[bytes], runs: Iterable[Run]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    steps = np.zeros(len(parts) + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return [parts[k] for k in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()]


def with_cycle(parts: list[bytes], key: str | None) -> list[bytes]:
    """The words, with a tail that repeats for one key in ten.

    For ``h = crc32(key)`` with ``h % 10 == 0`` and ``g = h // 10``, the words from ``a = g % n`` on repeat
    with period ``1 + (n - a) // (3 + g % 8)``. A null key changes nothing.
    """
    n = len(parts)
    if key is None or not n:
        return parts
    g, rest = divmod(zlib.crc32(key.encode()), 10)
    if rest:
        return parts
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return parts[:a] + (parts[a : a + period] * (1 + (n - a) // period))[: n - a]


def run_table(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``start``, ``length``, ``period`` of every run of every text, for further work on the runs."""
    kind = documents.schema[id_col].dataType.simpleString()

    def rows(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            taken, found = [], []
            for k, text in enumerate(values(batch.column(1))):
                runs = find_runs(word_ids(words(text)))
                found += runs
                taken += [k] * len(runs)
            columns = [pa.array([run[c] for run in found], pa.int64()) for c in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(taken, pa.int64())), *columns], names=["doc_id", "start", "length", "period"]
            )

    texts = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(rows, f"doc_id {kind}, start bigint, length bigint, period bigint")


def _summary(parts: list[bytes]) -> tuple:
    runs = find_runs(word_ids(parts))
    best = strongest(runs)
    lines = hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest()
    kept = hashlib.sha256(b" ".join(collapsed(parts, runs) if runs else parts)).hexdigest()
    if best is None:
        return len(runs), None, None, None, None, lines, kept
    return len(runs), *best, 1000 * best[1] // best[2], lines, kept


def periodic_runs(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", cycles: bool = False) -> DataFrame:
    """Per row: number of runs, the strongest one, digests of all runs and of the words without repetition.

    ``cycles`` first makes the tail of one document in ten repeat (``with_cycle``). A null or blank text has
    no words and no run; a row with a null id is measured like any other, without a cycle; repeated rows
    repeat; other columns are ignored; an empty table gives no rows. A text is worked on in memory that
    grows with its words, its time with words times the logarithm of its longest repeat.
    """
    kind = documents.schema[id_col].dataType.simpleString()
    kinds = [pa.int64()] * 5 + [pa.string()] * 2
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]

    def rows(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            found = []
            for key, text in values(batch.column(0), batch.column(1)):
                parts = words(text)
                found.append(_summary(with_cycle(parts, None if key is None else str(key)) if cycles else parts))
            columns = [pa.array([r[k] for r in found], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    texts = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(rows, f"doc_id {kind}, {COLUMNS}")
