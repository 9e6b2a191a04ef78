"""Window work inside one series.

A series is one id with at most one row per period (``relational.best_reading``
sees to that), so a window over an id is bounded by the number of periods and
one shuffle on the id serves every function here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from meterwatch.functions.nulls import finite_or
from meterwatch.session import spread


def by_series(id_col: str = "series_id", time_col: str = "period") -> WindowSpec:
    return Window.partitionBy(id_col).orderBy(time_col)


def add_lag(
    df: DataFrame, columns: Sequence[str], rows: int = 4,
    id_col: str = "series_id", time_col: str = "period",
) -> DataFrame:
    """``<column>_prev``: the value ``rows`` rows earlier in the same series."""
    w = by_series(id_col, time_col)
    return df.select("*", *[F.lag(c, rows).over(w).alias(f"{c}_prev") for c in columns])


def percent_change(value: str = "value", id_col: str = "series_id", time_col: str = "period") -> Column:
    """Change against the previous row; gaps carry the last value forward.

    The first row, a change from zero and unknown values count as 0.
    """
    w = by_series(id_col, time_col)
    filled = F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    previous = F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return finite_or(F.try_divide(filled, previous) - 1)


def add_index(df: DataFrame, name: str = "t", id_col: str = "series_id", time_col: str = "period") -> DataFrame:
    """Position in the series, from 0."""
    return df.withColumn(name, F.row_number().over(by_series(id_col, time_col)) - 1)


def running_sum(value: str, id_col: str = "series_id", time_col: str = "period") -> Column:
    return F.sum(value).over(by_series(id_col, time_col).rowsBetween(Window.unboundedPreceding, 0))


def interpolate(
    df: DataFrame, value: str = "value", id_col: str = "series_id", time_col: str = "period",
    method: str = "linear",
) -> DataFrame:
    """Fill gaps inside a series and continue it at both ends.

    ``linear`` joins the two neighbours; ``quadratic`` lays a parabola through
    the three nearest known points. Both work on the row position; a series
    with one known value becomes constant, one with none stays NULL.
    """
    indexed = add_index(df, "__i", id_col, time_col)
    whole = Window.partitionBy(id_col)
    i, v = F.col("__i"), F.col(value)
    if method == "quadratic":
        known = F.collect_list(F.when(v.isNotNull(), F.struct(i.alias("i"), v.cast("double").alias("v")))).over(whole)
        near = F.transform(F.col("__known"), lambda k: F.struct(
            F.abs(k["i"] - i).alias("d"), k["i"].alias("i"), k["v"].alias("v")))
        near = F.slice(F.array_sort(near), 1, 3)

        def weight(a: int, b: int, c: int) -> Column:
            p = [F.col("__near")[j]["i"] for j in (a, b, c)]
            return F.col("__near")[a]["v"] * ((i - p[1]) * (i - p[2])) / ((p[0] - p[1]) * (p[0] - p[2]))

        def straight() -> Column:
            a, b = F.col("__near")[0], F.col("__near")[1]
            return a["v"] + (b["v"] - a["v"]) * (i - a["i"]) / (b["i"] - a["i"])

        size = F.size("__near")
        fill = (F.when(size >= 3, weight(0, 1, 2) + weight(1, 0, 2) + weight(2, 0, 1))
                .when(size == 2, straight())
                .when(size == 1, F.col("__near")[0]["v"]))
        return (indexed.withColumn("__known", known)
                .withColumn("__near", F.when(v.isNull(), near))
                .withColumn(value, F.when(v.isNull(), fill).otherwise(v))
                .select(*df.columns))
    if method != "linear":
        raise ValueError(f"unknown method {method}")

    w = by_series(id_col, time_col)
    back = w.rowsBetween(Window.unboundedPreceding, 0)
    ahead = w.rowsBetween(0, Window.unboundedFollowing)
    point = F.when(v.isNotNull(), F.struct(i.alias("i"), v.cast("double").alias("v")))
    marked = (
        indexed
        .withColumn("__p", F.last(point, ignorenulls=True).over(back))
        .withColumn("__n", F.first(point, ignorenulls=True).over(ahead))
        .withColumn("__seen", F.count(value).over(back))
        .withColumn("__all", F.count(value).over(whole))
    )

    def nth(k: Column) -> Column:
        return F.max(F.when(v.isNotNull() & (F.col("__seen") == k), point)).over(whole)

    marked = (
        marked
        .withColumn("__a1", nth(F.lit(1))).withColumn("__a2", nth(F.lit(2)))
        .withColumn("__z1", nth(F.col("__all"))).withColumn("__z2", nth(F.col("__all") - 1))
    )

    def line(a: Column, b: Column) -> Column:
        return a["v"] + (b["v"] - a["v"]) * (i - a["i"]) / (b["i"] - a["i"])

    p, n = F.col("__p"), F.col("__n")
    fill = (
        F.when(p.isNotNull() & n.isNotNull(), line(p, n))
        .when(F.col("__all") == 1, F.coalesce(p["v"], n["v"]))
        .when(n.isNotNull(), line(F.col("__a1"), F.col("__a2")))
        .when(p.isNotNull(), line(F.col("__z2"), F.col("__z1")))
    )
    return marked.withColumn(value, F.when(v.isNull(), fill).otherwise(v)).select(*df.columns)


def train_test_part(train_len: int, test_len: int, id_col: str = "series_id", time_col: str = "period") -> Column:
    """``train``, ``test`` or NULL by position."""
    n = F.row_number().over(by_series(id_col, time_col))
    return F.when(n <= train_len, F.lit("train")).when(n <= train_len + test_len, F.lit("test"))


def standardise_in_group(df: DataFrame, group: Sequence[str], columns: Sequence[str], suffix: str = "_z") -> DataFrame:
    """(x - mean) / population deviation per group; no spread divides by 1.

    Statistics are aggregated and joined back, so a group may be of any size.
    """
    stats = df.groupBy(*group).agg(
        *[F.avg(c).alias(f"__m_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"__s_{c}") for c in columns])
    scaled = []
    for c in columns:
        spread = F.when(F.col(f"__s_{c}") > 0, F.col(f"__s_{c}")).otherwise(F.lit(1.0))
        scaled.append(((F.col(c) - F.col(f"__m_{c}")) / spread).alias(f"{c}{suffix}"))
    return df.join(stats, list(group)).select(*[F.col(c) for c in df.columns], *scaled)


def minmax_in_group(df: DataFrame, group: Sequence[str], value: str, out: str, negate: bool = False) -> DataFrame:
    """Scale to [0, 1] per group; a constant group becomes 0."""
    x = -F.col(value) if negate else F.col(value)
    span = df.groupBy(*group).agg(F.min(x).alias("__lo"), F.max(x).alias("__hi"))
    width = F.col("__hi") - F.col("__lo")
    scaled = F.when(width > 0, (x - F.col("__lo")) / width).otherwise(F.lit(0.0))
    return df.join(span, list(group)).select(*[F.col(c) for c in df.columns], scaled.alias(out))


def ordered_arrays(df: DataFrame, value: str = "value", id_col: str = "series_id", time_col: str = "period") -> DataFrame:
    """One row per id with its periods and values in order, spread for heavy work."""
    df = spread(df.select(id_col, time_col, value), id_col)
    packed = F.sort_array(F.collect_list(F.struct(F.col(time_col).alias("p"), F.col(value).cast("double").alias("v"))))
    return df.groupBy(id_col).agg(packed.alias("__s")).select(
        id_col, F.col("__s.p").alias("periods"), F.col("__s.v").alias("values"))
