"""Scans: CSV, tab-separated text, Parquet, wide reports.

Every text scan takes a declared schema; nothing is inferred.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from meterwatch.functions.nulls import clean_floats
from meterwatch.functions.scalar import parse_date, parse_number


def scan_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | str,
             names: Sequence[str] | None = None, **options: object) -> DataFrame:
    """CSV with a header; ``names`` replace the header by position."""
    paths = [path] if isinstance(path, str) else list(path)
    df = clean_floats(spark.read.schema(schema).options(header=True, **options).csv(paths))
    return df.toDF(*names) if names else df


def scan_tab_text(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str],
                  keep: Sequence[str]) -> DataFrame:
    """Latin-1 tab-separated files as text; only ``keep`` is parsed out."""
    schema = StructType([StructField(c, StringType()) for c in columns])
    return scan_csv(spark, path, schema, sep="\t", encoding="ISO-8859-1").select(*keep)


def scan_parquet(spark: SparkSession, path: str, has_nan: bool = False) -> DataFrame:
    """``has_nan`` cleans files of other writers; it costs float filter pushdown."""
    df = spark.read.parquet(path)
    return clean_floats(df) if has_nan else df


def scan_available(spark: SparkSession, path: str, wanted: Sequence[str], has_nan: bool = False) -> DataFrame:
    """Only those wanted columns that the file has; the scan reads no others."""
    df = spark.read.parquet(path)
    df = df.select([c for c in wanted if c in df.columns])
    return clean_floats(df) if has_nan else df


def months_to_rows(wide: DataFrame, id_columns: Sequence[str], rename: Mapping[str, str] | None = None,
                   time_col: str = "period", value: str = "value",
                   patterns: Sequence[str] = ("dd/MM/yyyy",)) -> DataFrame:
    """One row per (ids, month) from one column per month.

    Month headers are read day first; a header that is no date gives NULL.
    """
    if rename:
        wide = wide.withColumnsRenamed(dict(rename))
    months = [c for c in wide.columns if c not in id_columns]
    typed = wide.select(*[F.col(f"`{c}`") for c in id_columns],
                        *[parse_number(F.col(f"`{c}`").cast("string")).alias(c) for c in months])
    long = typed.unpivot(list(id_columns), [F.col(f"`{c}`") for c in months], "__header", value)
    return long.select(*id_columns, parse_date(F.col("__header"), patterns).alias(time_col), value)
