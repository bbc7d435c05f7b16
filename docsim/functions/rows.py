"""Choosing rows by their index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def head_rows(rows: DataFrame, limit: int, index_col: str = "row_idx") -> DataFrame:
    """The first ``limit`` rows by their 0-based row index; there is no upper bound."""
    if limit < 1:
        raise ValueError("limit must be at least 1")
    return rows.where(F.col(index_col) < limit)
