"""The one place for missing-value rules.

The engine knows NULL only: NaN and infinities are turned into NULL at ingest,
because Spark orders NaN above every number and a NaN score would rank first.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def finite_or(col: Column, default: float = 0.0) -> Column:
    """Infinite, NaN and NULL become ``default``."""
    bad = F.isnan(col) | (F.abs(col) == F.lit(float("inf")))
    return F.coalesce(F.when(~bad, col), F.lit(default))


def clean_floats(df: DataFrame) -> DataFrame:
    """NaN to NULL in every floating column."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}
    return df.select([nan_to_null(F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns])


def all_present(names: Iterable[str]) -> Column:
    """True where none of the columns is NULL."""
    cond = F.lit(True)
    for name in names:
        cond = cond & F.col(name).isNotNull()
    return cond


def is_in(col: Column, values: Iterable[object]) -> Column:
    """Membership where NULL is simply not a member."""
    return F.coalesce(col.isin(list(values)), F.lit(False))


def not_equal(col: Column, value: object) -> Column:
    """Inequality where NULL differs from every value."""
    return F.coalesce(col != F.lit(value), F.lit(True))
