"""Run registered queries and their SQL side by side and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    return value


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(repr([_value(row[k]) for k in order]) for row in rows)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else a description of the first difference."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    wanted = _rows(result.fetchall(), names)
    got = _rows([tuple(row) for row in spark_df.collect()], spark_df.columns)
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    if len(wanted) != len(got):
        return f"{len(got)} rows, expected {len(wanted)}"
    for g, w in zip(got, wanted):
        if g != w:
            return f"got {g[:700]}\nexpected {w[:700]}"
    return None
