"""Named queries with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from meterwatch.functions.scalar import fixed
from meterwatch.plans.views import Views, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Floats to ``digits`` decimals, so that summation order does not show."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}
    return df.select([fixed(F.col(c), digits).alias(c) if c in floats else F.col(c) for c in df.columns])


def r(expr: str, digits: int = 6) -> str:
    """The same rounding in SQL."""
    return f"(round(cast({expr} as double), {digits}) + 0e0)"


def query(key: str, sql: str | None = None, digits: int = 6, ctes: dict[str, str] | None = None):
    """Register ``fn(views)`` under ``key``; ``sql`` may name any view."""
    def add(fn: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = lambda spark, sf_dir: rounded(fn(Views(spark, sf_dir)), digits)
        if sql is not None:
            ORACLES[key] = with_views(sql, ctes)
        return fn
    return add
