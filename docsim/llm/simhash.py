"""Near copies by SimHash: one-wildcard variants of two half fingerprints, joined by equality.

Two fingerprints that differ in three bits or fewer have a half (32 bits) that differs in at most one
bit. Each half is indexed once as it is and once for each of its bits with that bit cleared; under a
cleared bit only fingerprints with the bit off meet those with the bit on, so a pair meets at most once
per half. Candidates are verified on all 64 bits inside the join.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsim.llm.graph import components
from docsim.llm.words import lower_words, signed, values
from docsim.session import written

SHINGLE = 3
SEED = 42
MAX_DISTANCE = 3
HOT_BUCKET = 4096
BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint: a bit is set where more than half of the shingle hashes have it."""
    parts = lower_words(text)
    if not parts:
        return 0
    whole = b" ".join(parts)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(shingle, len(parts))
    starts, ends = starts[: len(parts) - width + 1], ends[width - 1 :]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), BLOCK):
        a, b = starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist()
        hashes = np.fromiter((xxhash.xxh64_intdigest(whole[i:j], SEED) for i, j in zip(a, b)), "<u8", len(a))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << k for k in np.flatnonzero(2 * counts > len(starts)).tolist())


def fingerprint_column(text: str):
    """Fingerprint of a text column as a bigint; a null or empty text has 0."""

    @F.arrow_udf("bigint")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(signed(np.fromiter(map(fingerprint, values(texts)), np.uint64, len(texts))))

    return of(F.col(text))


def _variants(codes: DataFrame) -> DataFrame:
    """66 index rows per fingerprint: ``variant`` 0-31 and 32 for one half, 33-64 and 65 for the other."""
    rows = codes.select("code", F.explode(F.sequence(F.lit(0), F.lit(65))).alias("variant"))
    rows = rows.selectExpr(
        "code",
        "variant",
        "cast(variant % 33 as int) AS place",
        "CASE WHEN variant < 33 THEN code & 4294967295L ELSE shiftrightunsigned(code, 32) END AS half",
        "CASE WHEN variant < 33 THEN shiftrightunsigned(code, 32) ELSE code & 4294967295L END AS other",
    )
    return rows.selectExpr(
        "code",
        "place",
        "other",
        "CASE WHEN place = 32 THEN 0 ELSE cast(shiftrightunsigned(half, place) & 1L as int) END AS bit",
        "shiftleft(cast(variant as bigint), 32) | (CASE WHEN place = 32 THEN half ELSE half & ~shiftleft(1L, place) END) AS key",
    )


def _hot_keys(codes: DataFrame, limit: int) -> DataFrame:
    """Keys that more than ``limit`` fingerprints may share, from counts of whole halves."""
    halves = codes.selectExpr("explode(array(struct(0 AS at, code & 4294967295L AS half), struct(33 AS at, shiftrightunsigned(code, 32) AS half))) AS h")
    many = halves.groupBy("h.at", "h.half").count().where(F.col("count") > limit)
    keys = many.select("at", "half", F.explode(F.sequence(F.lit(0), F.lit(32))).alias("place"))
    return keys.selectExpr(
        "shiftleft(cast(at + place as bigint), 32) | (CASE WHEN place = 32 THEN half ELSE half & ~shiftleft(1L, place) END) AS key"
    ).distinct()


def near_codes(codes: DataFrame, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """Pairs (``high``, ``low``) of distinct fingerprints ``code`` at three bits or fewer.

    A key shared by more than ``hot_bucket`` fingerprints is cut by the four bytes of the other half:
    with three bits at most between them, two fingerprints agree in one of these bytes.
    """
    hot = written(_hot_keys(codes, hot_bucket).withColumn("hot", F.lit(True)), "hot-keys")
    rows = _variants(codes).join(hot, "key", "left")
    rows = rows.select(
        "code",
        "place",
        "bit",
        "key",
        "other",
        F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(3))).otherwise(F.array(F.lit(-1)))).alias("byte"),
    ).selectExpr(
        "code", "place", "bit", "key", "byte", "CASE WHEN byte < 0 THEN 0L ELSE shiftrightunsigned(other, 8 * byte) & 255L END AS cut"
    )
    off = rows.where("bit = 0").select("key", "byte", "cut", "place", F.col("code").alias("a"))
    on = rows.where("bit = 1 OR place = 32").select("key", "byte", "cut", F.col("code").alias("b"))
    # Spark takes the 33 rows and more of a code for one row when it looks for a side to broadcast
    pairs = off.join(on.hint("merge"), ["key", "byte", "cut"]).where(f"bit_count(a ^ b) <= {MAX_DISTANCE} AND (place < 32 OR a < b)")
    return pairs.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct()


def code_components(prints: DataFrame) -> DataFrame:
    """``code``, ``root`` for each distinct fingerprint of ``prints``; a fingerprint without links is its own root."""
    codes = written(prints.select("code").distinct(), "codes")
    roots = components(near_codes(codes)).select(F.col("node").alias("code"), "root")
    return codes.join(roots, "code", "left").select("code", F.coalesce("root", "code").alias("root"))


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``: the least id reachable over links.

    Null and blank texts have fingerprint 0 and link like any other; rows with a null id take part and
    give no component id; repeated rows are returned as often as they come. Other columns are ignored.
    """
    prints = written(
        documents.select(F.col(id_col).alias("doc_id"), fingerprint_column(text_col).alias("code")), "fingerprints"
    )
    least = prints.groupBy("code").agg(F.min("doc_id").alias("least"))
    members = written(code_components(prints).join(least, "code"), "code-components")
    groups = members.groupBy("root").agg(F.min("least").alias("component_id"))
    named = members.join(groups, "root").select("code", "component_id")
    return prints.join(named, "code").select(
        "doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``documents`` with one row of each component: the least id, then the first read.

    Rows with a null id give way to rows with one. All columns are kept as they are.
    """
    taken = set(documents.columns)
    code, row = (next(n for n in (f"{x}{k or ''}" for k in range(len(taken) + 1)) if n not in taken) for x in ("near_code", "near_row"))
    numbered = written(
        documents.withColumn(code, fingerprint_column(text_col)).withColumn(row, F.monotonically_increasing_id()),
        "numbered",
    )
    prints = numbered.select(F.col(code).alias("code"), F.col(row).alias("row"), F.col(id_col).alias("id"))
    first = prints.groupBy("code").agg(F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first"))
    members = code_components(prints).join(first, "code")
    kept = members.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias(row))
    return numbered.join(kept, row, "left_semi").select(*[numbered[f"`{c}`"] for c in documents.columns])
