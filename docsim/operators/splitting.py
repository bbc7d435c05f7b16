"""Stratified split into training and test rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TEST_SHARE = 0.2
SEED = 42
# Digits counted at a time, digits of a digest, and most rows that are ranked.
DIGITS = 4
DIGEST_LENGTH = 32
RANKED_ROWS = 100_000


def _bucket_of_cut(rows: DataFrame, prefix: str, rank: int) -> tuple[str, int, int]:
    """The next digits of the digest that hold the row of this rank: longer prefix, rank inside it, rows in it."""
    upward = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # at most 65,536 rows
    counts = (
        rows.groupBy(F.substring("digest", len(prefix) + 1, DIGITS).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("through", F.sum("n").over(upward))
    )
    found = counts.where(F.col("through") >= rank).orderBy("bucket").first()
    return prefix + found["bucket"], rank - (found["through"] - found["n"]), found["n"]


def stratified_split(
    pairs: DataFrame, test_share: float = TEST_SHARE, seed: int = SEED, id_col: str = "pair_id", ranked: int = RANKED_ROWS
) -> DataFrame:
    """Add ``is_test``: per label, the given share of rows (rounded) in the order of a digest.

    The same rows and seed give the same split; rows of one label and id stay together. There are only two
    labels, so ranking a whole label would put half of the table into one task. Instead the place of the cut
    is found digit by digit: rows are counted by the next digits of the digest, and the counts of the bucket
    that holds the cut are refined until it has ``ranked`` rows or fewer, which are ranked.
    """
    keyed = pairs.withColumn("digest", F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"|{seed}"))))
    slim = keyed.select("label", "digest", F.col(id_col).alias("id"))
    place = F.struct("digest", F.col(id_col).alias("id"))
    is_test = F.lit(False)
    totals = slim.where("label IS NOT NULL").groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()
    for label, n in totals:
        prefix, rank = "", math.floor(n * test_share + 0.5)
        if not rank:
            continue
        own = slim.where(F.col("label") == label)
        while n > ranked and len(prefix) < DIGEST_LENGTH:
            prefix, rank, n = _bucket_of_cut(own.where(F.col("digest").startswith(prefix)), prefix, rank)
        within = Window.orderBy("digest", "id")
        inside = own.where(F.col("digest").startswith(prefix)).withColumn("place", F.row_number().over(within))
        cut = inside.where(F.col("place") == rank).select("digest", "id").first()
        last = F.struct(F.lit(cut["digest"]).alias("digest"), F.lit(cut["id"]).cast(slim.schema["id"].dataType).alias("id"))
        is_test = is_test | ((F.col("label") == label) & (place <= last))
    return keyed.withColumn("is_test", F.coalesce(is_test, F.lit(False))).select(*pairs.columns, "is_test")
