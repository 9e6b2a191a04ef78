"""Structural change: CUSUM of the residuals of a linear trend."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterwatch.functions.scalar import fixed
from meterwatch.functions.stats import kolmogorov_p
from meterwatch.operators.ordering import global_rank
from meterwatch.operators.series import add_index, by_series

MIN_LENGTH = 10


def cusum_break(
    df: DataFrame, alpha: float = 0.01, id_col: str = "series_id", time_col: str = "period", value: str = "value",
) -> DataFrame:
    """Statistic, p-value and flag per series.

    Series shorter than ten or with a missing value are left out; one without
    any residual gets NULL. Everything runs on one shuffle by id.
    """
    whole = Window.partitionBy(id_col)
    t, y = F.col("t").cast("double"), F.col(value)
    rows = add_index(df, "t", id_col, time_col).select(
        id_col, time_col, "t", value,
        F.count(F.lit(1)).over(whole).alias("n"), F.count(value).over(whole).alias("known"),
    ).filter((F.col("n") >= MIN_LENGTH) & (F.col("known") == F.col("n")))
    rows = rows.select(
        "*", F.regr_slope(y, t).over(whole).alias("slope"), F.avg(y).over(whole).alias("mean_y"),
        F.avg(t).over(whole).alias("mean_t"))
    residual = y - F.col("mean_y") - F.col("slope") * (t - F.col("mean_t"))
    rows = rows.select(id_col, time_col, value, residual.alias("r"))
    upto = by_series(id_col, time_col).rowsBetween(Window.unboundedPreceding, 0)
    path = rows.select(id_col, value, "r", F.sum("r").over(upto).alias("c"))
    # residuals below rounding of the values count as none
    stats = path.groupBy(id_col).agg(
        F.sum(F.col("r") * F.col("r")).alias("ss"), F.max(F.abs("c")).alias("top"),
        F.sum(y * y).alias("scale"))
    flat = F.col("ss") <= F.lit(1e-20) * F.col("scale")
    stat = F.when(~flat, F.col("top") / F.sqrt(F.col("ss")))
    return (stats.select(id_col, stat.alias("cusum_stat"))
            .withColumn("cusum_pval", kolmogorov_p(F.col("cusum_stat")))
            .withColumn("structural_change", F.col("cusum_pval") < alpha))


def cusum_ranking(breaks: DataFrame, id_col: str = "series_id") -> DataFrame:
    """Smallest p-value first."""
    return global_rank(breaks, [fixed(F.col("cusum_pval")).asc_nulls_last(), F.col(id_col).asc()])
