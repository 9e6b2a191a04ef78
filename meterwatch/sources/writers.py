"""Sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", **options: object) -> str:
    df.write.mode(mode).options(header=True, **options).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", compression: str = "snappy") -> str:
    df.write.mode(mode).option("compression", compression).parquet(path)
    return path
