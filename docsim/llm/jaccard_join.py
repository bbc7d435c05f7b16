"""N-gram Jaccard join by parity sketches.

A document is the set of its five-word shingles. Every shingle flips one bit of a sketch, so the bits in
which two sketches differ are no more than the shingles that only one of the two sets holds. Sets of ``a``
and ``b`` shingles at similarity ``s`` or more differ in at most ``(a + b) (1 - s) / (1 + s)`` shingles.

A size band (all sizes between two powers of two) cuts its sketches into ``K`` segments. Of these, two
linked sets have all but ``d`` alike, ``d`` being that bound, so any ``d + 1`` segments of one set, the first
in an order common to all sets, meet one of the first ``d + 1`` of the other. Segments with many bits of
uncommon shingles come first, as they are shared by few; which shingles are common is counted over all
documents beforehand, and decides the order only. A set whose partners may lie in the next band is also cut
by that band's ``K``. A segment is known by the XOR of hashes of its set bits; its 2**32 bits are never laid
out.

Copies of one set are one member. Segments are sorted by range, which splits a hot segment over tasks, and
read in order. Two members of a segment are candidates only if a parity of 512 bits that goes with them allows
it. Members first meet in rounds, each one other member that shares many segments with it and is not
connected with it yet. Pairs of a segment are opened only for members that belong to different components by
then, so a group of many near copies is never opened into its pairs, and no link between components is lost. A
pair that shares many segments is opened under one of them, or few. All candidates are verified on their sets.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsim.llm.graph import components
from docsim.llm.words import Sequences, batches, lower_words, mix, signed, values, word_hashes
from docsim.session import written

SHINGLE = 5
SIMILARITY = (80, 100)
#: Sets that a task remembers, so that their copies are not cut again.
REMEMBERED = 1 << 18
#: Shingles that a task's counts are cut down to; common ones are at most as many.
COUNTED = 1 << 16
#: Bits of the parity that decides whether two members that meet are looked at.
PARITY = 512
#: A round that links one member in so many, or fewer, is the last.
YIELD = 20
#: Segments that a member takes with it, by which a pair is known to be opened elsewhere.
LEAST = 16
#: Shingles that a task gathers between two cuts.
GATHERED = 1 << 20


def shingles(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Hashes of the distinct runs of ``width`` words (of all words, if they are fewer), in order."""
    hashes = word_hashes(lower_words(text))
    if not len(hashes):
        return hashes
    width = min(width, len(hashes))
    found = np.sort(Sequences(hashes).of(np.arange(len(hashes) - width + 1), width))
    return found[np.concatenate(([True], found[1:] != found[:-1]))]


def linked(shared: int, a: int, b: int, similarity: tuple[int, int] = SIMILARITY) -> bool:
    return similarity[1] * shared >= similarity[0] * (a + b - shared)


def _segments(band: int, similarity: tuple[int, int]) -> int:
    """Segments of a band's sketches: nine for every seven shingles in which its largest sets may differ."""
    low, high = similarity
    return max(2, -(-18 * (2 << band) * (high - low) // (7 * (high + low))))


def _segment_keys(shingle_hashes: np.ndarray, rare: np.ndarray, band: int, count: int, take: int) -> np.ndarray:
    """Keys of the first ``take`` of ``count`` segments, those with most set bits of ``rare`` shingles first."""
    segment = ((shingle_hashes >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
    starts = np.concatenate(([0], np.flatnonzero(segment[1:] != segment[:-1]) + 1))
    bits = np.diff(starts, append=len(segment)).astype(np.uint64)
    strength = np.minimum(np.add.reduceat(rare, starts), np.uint64(15)) * np.uint64(16) + np.minimum(bits, np.uint64(15))
    # The number of the segment and the low half of a hash name the bit; shingles that flip the same bit cancel out.
    parity = np.bitwise_xor.reduceat(mix(shingle_hashes & np.uint64(0xFFFFFFFF)), starts)
    number = segment[starts]
    if len(number) < take:
        empty = np.setdiff1d(np.arange(count, dtype=np.uint64), number)
        number = np.concatenate((number, empty))
        parity, strength = (np.concatenate((x, np.zeros(len(empty), np.uint64))) for x in (parity, strength))
    keys = mix(parity ^ mix(number + np.uint64(band << 32) + np.uint64(1))) >> np.uint64(8)
    keys |= (np.uint64(255) - strength) << np.uint64(56)
    return np.sort(keys)[:take]


def segment_keys(
    shingle_hashes: np.ndarray, similarity: tuple[int, int] = SIMILARITY, common: np.ndarray = np.zeros(0, np.uint64)
) -> np.ndarray:
    """Keys under which a set is found: of its own band, and of every higher one that may hold partners.

    ``common`` shingles, in order, make no segment come first. A set that differs from every partner in less
    than one shingle has only copies, and no keys.
    """
    low, high = similarity
    size = len(shingle_hashes)
    if not size:
        return np.zeros(0, np.uint64)
    rare = np.ones(size, np.uint64)
    if len(common):
        at = np.minimum(np.searchsorted(common, shingle_hashes), len(common) - 1)
        rare[common[at] == shingle_hashes] = 0
    band, largest = size.bit_length() - 1, size * high // low
    out = [np.zeros(0, np.uint64)]
    while 1 << band <= largest:
        differ = (size + min(largest, (2 << band) - 1)) * (high - low) // (high + low)
        if differ:
            out.append(_segment_keys(shingle_hashes, rare, band, _segments(band, similarity), differ + 1))
        band += 1
    return np.concatenate(out)


def _counted(parts: list[tuple[np.ndarray, np.ndarray]], most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes and summed counts; beyond ``most`` of them, less the largest count that no longer fits."""
    hashes, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    counts = np.bincount(place, weights=np.concatenate([p[1] for p in parts]), minlength=len(hashes)).astype(np.int64)
    if len(hashes) <= most:
        return hashes, counts, 0
    off = int(np.partition(counts, len(counts) - most - 1)[len(counts) - most - 1])
    keep = counts > off
    return hashes[keep], counts[keep] - off, off


def _summaries(shingle: int) -> Callable:
    """Counts of the documents of a task that have a shingle, cut to ``COUNTED`` shingles again and again.

    A row without a shingle holds what the cuts took off, which bounds the error of every count.
    """

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, gathered, slack = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))], 0, 0
        for batch in stream:
            for text in values(batch.column(0)):
                found = shingles(text, shingle)
                parts.append((found, np.ones(len(found), np.int64)))
                gathered += len(found)
                if gathered > GATHERED:
                    hashes, counts, off = _counted(parts, COUNTED)
                    parts, gathered, slack = [(hashes, counts)], 0, slack + off
        hashes, counts, off = _counted(parts, COUNTED)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*signed(hashes).tolist(), None], pa.int64()), pa.array([*counts.tolist(), slack + off], pa.int64())],
            names=["shingle", "n"],
        )

    return run


def common_shingles(texts: DataFrame, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of the shingles that surely stand in more documents than one in ``COUNTED`` of all shingles is.

    These are ``COUNTED`` at most, whatever the corpus; counts of tasks are summed by Spark.
    """
    counted = written(texts.select("text").mapInArrow(_summaries(shingle), "shingle bigint, n bigint"), "shingle-counts")
    slack = counted.where("shingle IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    summed = counted.where("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("n").alias("n"))
    found = summed.where(F.col("n") > max(slack, 1)).orderBy(F.desc("n"), "shingle").limit(COUNTED).toArrow()
    return np.sort(found["shingle"].to_numpy().astype(np.int64).view(np.uint64))


def _digest(shingle_hashes: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingle_hashes.tobytes(), digest_size=16).digest() if len(shingle_hashes) else None


def _sketches(shingle: int, similarity: tuple[int, int], common: np.ndarray) -> Callable:
    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in stream:
            digests, sizes, keys = [], [], []
            for text in values(batch.column(1)):
                found = shingles(text, shingle)
                digest = _digest(found)
                new = digest is not None and digest not in seen
                if new:
                    seen.add(digest)
                digests.append(digest)
                sizes.append(len(found))
                keys.append(segment_keys(found, similarity, common) if new else np.zeros(0, np.uint64))
            if len(seen) > REMEMBERED:
                seen.clear()
            offsets = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32)
            flat = signed(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), lists, batch.column(2), batch.column(3)],
                names=["doc_id", "digest", "n", "keys", "k1", "k2"],
            )

    return run


def _met(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (``key``, ``row``) in order, without those that are alone under their key.

    The first and last key of a range stay, as another range may hold them too. Only the last row is kept
    from one batch to the next.
    """
    schema = pa.schema([("key", pa.int64()), ("row", pa.int64())])
    held: list[np.ndarray] = [np.zeros(0, np.int64)] * 2
    first, shared = True, False  # whether the held row's key is the range's first, and has more rows
    for batch in stream:
        key, row = (np.concatenate((h, np.asarray(batch.column(k)))) for k, h in enumerate(held))
        if not len(key):
            continue
        new = np.concatenate(([False], key[1:] != key[:-1]))
        group = np.cumsum(new)
        many = np.bincount(group)[group] > 1
        if first or shared:
            many[group == 0] = True
        yield from batches(schema, [key[:-1][many[:-1]], row[:-1][many[:-1]]])
        first, shared = first and not new.any(), bool(many[-1])
        held = [key[-1:], row[-1:]]
    yield from batches(schema, held)


def _parity(shingle_hashes: np.ndarray) -> np.ndarray:
    """A sketch of ``PARITY`` bits, as bigints: the bits in which two differ are no more than the shingles."""
    bits = np.bincount((mix(shingle_hashes) % np.uint64(PARITY)).astype(np.int64), minlength=PARITY) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _sets(shingle: int) -> Callable:
    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            found = [shingles(t, shingle) for t in values(batch.column(1))]
            parities = pa.FixedSizeListArray.from_arrays(
                pa.array(np.concatenate([_parity(f) for f in found]) if found else [], pa.int64()), PARITY // 64
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f.tobytes() for f in found], pa.binary()), parities.cast(pa.list_(pa.int64()))],
                names=["node", "shingles", "parity"],
            )

    return run


def _linked_column(similarity: tuple[int, int]) -> Callable:
    @F.arrow_udf("boolean")
    def of(first: pa.Array, second: pa.Array) -> pa.Array:
        out = []
        for a, b in values(first, second):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            out.append(linked(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b), similarity))
        return pa.array(out, pa.bool_())

    return of


def _verified(pairs: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The pairs (``high``, ``low``) whose sets are linked; ``sets`` has ``node``, ``shingles``."""
    first = sets.select(F.col("node").alias("high"), F.col("shingles").alias("first"))
    second = sets.select(F.col("node").alias("low"), F.col("shingles").alias("second"))
    both = pairs.join(first, "high").join(second, "low")
    return written(both.where(_linked_column(similarity)("first", "second")).select("high", "low"), "links")


def _text_keys(text: str) -> list:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def _may_link(a: str, b: str, similarity: tuple[int, int]) -> Column:
    """Whether sizes and parities of two members allow a link; wrong only for some that have none."""
    low, high = similarity
    differ = reduce(Column.__add__, [F.bit_count(F.col(f"{a}.p{k}").bitwiseXOR(F.col(f"{b}.p{k}"))) for k in range(PARITY // 64)])
    n_a, n_b = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (differ * (high + low) <= (n_a + n_b) * (high - low)) & (F.least(n_a, n_b) * high >= F.greatest(n_a, n_b) * low)


def _tries(parts: DataFrame, number: int, similarity: tuple[int, int]) -> DataFrame:
    """For each member whose segments hold other components, one member that it may link with: that of most shared segments.

    Every segment offers its first and its last member in an order of its own for each round.
    """
    order = F.struct(F.xxhash64("node", "key", F.lit(number)).alias("h"), "part", "node", "m")
    ends = parts.groupBy("key").agg(
        F.min("part").alias("low"), F.max("part").alias("high"), F.min(order).alias("one"), F.max(order).alias("two")
    ).where("low < high")
    met = parts.join(ends.select("key", "one", "two"), "key")
    other = [F.when((F.col(f"{e}.part") != F.col("part")) & _may_link("m", f"{e}.m", similarity), F.col(f"{e}.node")) for e in ("one", "two")]
    met = met.select("node", F.explode(F.array(*other)).alias("other")).where("other IS NOT NULL")
    best = met.groupBy("node", "other").agg(F.count("*").alias("n")).groupBy("node").agg(F.max(F.struct("n", "other")).alias("best"))
    return best.select(F.greatest("node", "best.other").alias("high"), F.least("node", "best.other").alias("low")).distinct()


def _groups_once(parts: DataFrame) -> DataFrame:
    """The rows of one key of all that have the same members, of keys whose members are of different components.

    Long texts that share a passage share many segments, and under each of them the same members meet. Groups
    are told apart by 128 bits, their number of members, and their ends.
    """
    hashes = [F.bit_xor(F.xxhash64("node")).alias("h1"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("h2")]
    groups = parts.groupBy("key").agg(
        F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("n"),
        F.min("node").alias("first"), F.max("node").alias("last"), *hashes,
    ).where("low < high")
    once = groups.groupBy("n", "first", "last", "h1", "h2").agg(F.min("key").alias("key"))
    return parts.join(once.select("key"), "key", "left_semi")


def _opened(parts: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Pairs ``high``, ``low`` of members under one key that are of different components and may link.

    Members that share one key mostly share many. Each takes its ``LEAST`` first keys along, in an order common
    to all, and a pair is not opened under a key if these hold an earlier one of both: it is opened there. Only a pair
    whose common keys are not among these comes more than once.
    """
    order = F.xxhash64("key")
    least = parts.groupBy("node").agg(F.slice(F.array_sort(F.collect_set(order)), 1, LEAST).alias("least"))
    rows = parts.join(least, "node")
    one, two = (rows.select("key", F.struct("node", "part", "m", "least").alias(name)) for name in ("one", "two"))
    earliest = F.array_min(F.array_intersect("one.least", "two.least"))
    wanted = (F.col("one.part") < F.col("two.part")) & _may_link("one.m", "two.m", similarity) & (F.coalesce(earliest, order) >= order)
    met = one.join(two, "key").where(wanted)
    return met.select(F.greatest("one.node", "two.node").alias("high"), F.least("one.node", "two.node").alias("low"))


def _links(held: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Links that connect all that is connected, of the members ``node`` met under ``key``, with sizes and parities ``m``.

    Components grow by rounds of one pair a member, as long as a round finds a link for one member in
    ``YIELD``. Then all pairs of different components that the parities allow are opened and verified, under few of the keys
    that they share.
    """
    members, parts, links, tried = sets.count(), held.withColumn("part", F.col("node")), None, None
    for number in itertools.count():
        pairs = written(_tries(parts, number, similarity), "tries")
        found = _verified(pairs, sets, similarity)
        tried = pairs if tried is None else tried.union(pairs)
        links = found if links is None else links.union(found)
        root = written(components(links).withColumnRenamed("root", "part"), "roots")
        parts = held.join(root, "node", "left").withColumn("part", F.coalesce("part", "node"))
        if found.count() * YIELD <= members:
            break
    pairs = _opened(written(_groups_once(parts), "apart"), similarity).distinct()
    return links.union(_verified(pairs.join(tried, ["high", "low"], "left_anti"), sets, similarity))


def jaccard_components(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
    similarity: tuple[int, int] = SIMILARITY,
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` of every row.

    ``component_id`` is the least id reachable over links, the row's own included; two sets link when their
    similarity is at least the fraction ``similarity``. A null or blank text has no shingles and no links. A
    row with a null id takes part and gives no component id; repeated rows are returned as often as they
    come; other columns are ignored; an empty table gives no rows. Sets are told apart by 128 bits, shingles
    by 64.
    """
    kind = documents.schema[id_col].dataType.simpleString()
    texts = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sketched = texts.select("doc_id", "text", *_text_keys("text")).mapInArrow(
        _sketches(shingle, similarity, common_shingles(texts, shingle)),
        f"doc_id {kind}, digest binary, n bigint, keys array<bigint>, k1 bigint, k2 bigint",
    )
    prints = written(sketched.withColumn("row", F.monotonically_increasing_id()), "sketches")
    members = prints.where("digest IS NOT NULL").groupBy("digest")
    members = written(members.agg(F.min("row").alias("node"), F.min("doc_id").alias("least")), "members")

    index = prints.select(F.explode("keys").alias("key"), "row")
    ordered = index.repartitionByRange("key", "row").sortWithinPartitions("key", "row")
    met = written(ordered.mapInArrow(_met, "key bigint, row bigint"), "met")
    # Copies that were cut in different tasks give way to the one that stands for their set.
    rows = prints.select("row", "digest").join(met.select("row").distinct(), "row")
    rows = rows.join(members.select("digest", "node"), "digest").select("row", "node")
    held = met.join(rows, "row").select("key", "node").distinct()
    shared = held.groupBy("key").agg(F.count("*").alias("members")).where("members > 1").select("key")
    held = written(held.join(shared, "key", "left_semi"), "held")

    live = prints.select(F.col("row").alias("node"), "k1", "k2").join(held.select("node").distinct(), "node")
    once = texts.select("text", *_text_keys("text")).dropDuplicates(["k1", "k2"])
    sets = once.join(live, ["k1", "k2"]).select("node", "text")
    sets = written(sets.mapInArrow(_sets(shingle), "node bigint, shingles binary, parity array<bigint>"), "shingles")
    bits = [F.col("parity")[k].alias(f"p{k}") for k in range(PARITY // 64)]
    sized = sets.select("node", F.struct(F.expr("length(shingles) DIV 8").alias("n"), *bits).alias("m"))
    links = _links(written(held.join(sized, "node"), "members"), sets, similarity)

    roots = components(links).select("node", "root")
    named = written(members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "named")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select("digest", "component_id")
    full = prints.where("digest IS NOT NULL").join(named, "digest")
    blank = prints.where("digest IS NULL").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", F.col("n").alias("n_shingles"), "component_id"]
    return full.select(*columns).union(blank.select(*columns))
