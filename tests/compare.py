"""Run a registered query in Spark and its SQL in DuckDB and compare rows."""

from __future__ import annotations

import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as from '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, decimal.Decimal):
        raise TypeError("decimal in a result")
    if isinstance(v, float):
        if math.isnan(v):
            raise ValueError("NaN in a result")
        return ("f", repr(v))
    return (type(v).__name__, repr(v))


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return df.columns, [tuple(r) for r in df.collect()]


def differences(con, df, sql: str) -> list[str]:
    names_a, rows_a = spark_rows(df)
    rel = con.execute(sql)
    names_b = [d[0] for d in rel.description]
    rows_b = rel.fetchall()
    if sorted(names_a) != sorted(names_b):
        return [f"columns {sorted(names_a)} != {sorted(names_b)}"]
    if len(rows_a) != len(rows_b):
        return [f"row counts {len(rows_a)} != {len(rows_b)}"]
    a, b = _rows(names_a, rows_a), _rows(names_b, rows_b)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return [f"{len(bad)} of {len(a)} rows differ, e.g. {bad[0][0]} != {bad[0][1]}"] if bad else []
