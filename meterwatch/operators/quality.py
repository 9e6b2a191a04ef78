"""Which series and clients are fit for analysis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterwatch.functions.scalar import ordered_mean
from meterwatch.operators.ordering import exact_quantiles
from meterwatch.operators.relational import drop_ids
from meterwatch.operators.series import interpolate
from meterwatch.session import persist_table

FLAT_VARIANCE = 1e-6
# fixed values: reasons for exclusion
TOO_MANY_NULLS = "Demasiados nulos"
NO_VARIANCE = "Serie sin varianza"
NO_METER_CHANGE = "SIN CAMBIO MEDIDOR"


def _spread(df: DataFrame, id_col: str, value: str) -> DataFrame:
    return df.groupBy(id_col).agg(
        F.var_samp(value).alias("variance"),
        F.count_if(F.col(value).isNull()).alias("nulls"),
        F.count(value).alias("present"),
    )


def invalid_series_strict(df: DataFrame, id_col: str = "series_id", value: str = "value", max_nulls: float = 0.2) -> DataFrame:
    """One reason per id: nulls against all rows first, else no variance."""
    share = F.col("nulls") / (F.col("nulls") + F.col("present"))
    rows = _spread(df, id_col, value).withColumn("null_share", share)
    reason = (F.when(F.col("null_share") > max_nulls, TOO_MANY_NULLS)
              .when(F.col("variance") < FLAT_VARIANCE, NO_VARIANCE))
    return (rows.withColumn("reason", reason).filter("reason is not null")
            .select(id_col, "null_share", "variance", "reason"))


def invalid_series(df: DataFrame, id_col: str = "series_id", value: str = "value", max_nulls: float = 0.4) -> DataFrame:
    """A row per id and reason; the null ratio is against present values.

    An id without any present value counts as having too many nulls.
    """
    rows = _spread(df, id_col, value)
    ratio = F.try_divide(F.col("nulls").cast("double"), F.col("present"))
    flat = F.when(F.col("variance") < FLAT_VARIANCE, F.lit(NO_VARIANCE))
    gaps = F.when((ratio > max_nulls) | ((F.col("present") == 0) & (F.col("nulls") > 0)), F.lit(TOO_MANY_NULLS))
    return rows.select(id_col, F.explode(F.array_compact(F.array(flat, gaps))).alias("reason"))


def ids_with_low(df: DataFrame, threshold: float, id_col: str, value: str) -> DataFrame:
    low = df.groupBy(id_col).agg(F.min(value).alias("__low"))
    return low.filter(F.col("__low") <= threshold).select(id_col)


def exclude_low(df: DataFrame, threshold: float = 0.0, id_col: str = "series_id", value: str = "value") -> DataFrame:
    """Drop a whole client if any period is at or below the threshold."""
    return drop_ids(df, ids_with_low(df, threshold, id_col, value), [id_col])


def last_period(df: DataFrame, time_col: str) -> Column:
    """The latest period of the table, as a scalar subquery."""
    return df.agg(F.max(time_col)).scalar()


def exclude_recent(
    df: DataFrame, change_col: str, months: int = 24, no_change: str = NO_METER_CHANGE,
    id_col: str = "series_id", time_col: str = "period",
) -> DataFrame:
    """Drop clients whose meter changed within ``months`` before the last period."""
    changed = F.when(F.col(change_col).cast("string") != no_change, F.col(change_col).cast("string"))
    first_allowed = F.add_months(last_period(df, time_col), -months)
    recent = df.filter(F.try_to_timestamp(changed).cast("date") >= first_allowed).select(id_col).distinct()
    return drop_ids(df, recent, [id_col])


def exclude_high(
    df: DataFrame, class_col: str, quantile: float = 0.95, id_col: str = "series_id", value: str = "value",
) -> DataFrame:
    """Drop clients whose mean is above the quantile of their class.

    The cut is often a client's own mean, or one that many clients share, so means do not
    depend on the order of the rows and are written down once, when this is called: computed twice,
    they could differ in the last digit and drop a client that is not above.
    """
    means = persist_table(df.filter(F.col(class_col).isNotNull())
                          .groupBy(class_col, id_col).agg(ordered_mean(F.col(value)).alias("__mean")))
    cuts = exact_quantiles(means, "__mean", {"__cut": quantile}, [class_col])
    high = means.join(cuts, [class_col]).filter(F.col("__mean") > F.col("__cut")).select(id_col)
    return drop_ids(df, high, [id_col])


def trailing_months(df: DataFrame, months: int = 24, time_col: str = "period") -> DataFrame:
    """Rows strictly later than the last period minus ``months``."""
    return df.filter(F.col(time_col) > F.add_months(last_period(df, time_col), -months))


def balanced(df: DataFrame, periods: int, id_col: str = "series_id", time_col: str = "period") -> DataFrame:
    """Clients with exactly ``periods`` distinct periods."""
    full = (df.groupBy(id_col).agg(F.countDistinct(time_col).alias("__n"))
            .filter(F.col("__n") == periods).select(id_col))
    return df.join(full, id_col, "left_semi")


def filter_customers(
    df: DataFrame, months: int = 24, id_col: str = "series_id", time_col: str = "period", value: str = "value",
    change_col: str | None = None, drop_recent: bool = True, drop_low: bool = True, low_threshold: float = 0.0,
    class_col: str | None = None, drop_high: bool = True, high_quantile: float = 0.95,
    only_balanced: bool = False, fill: str | None = "linear",
) -> DataFrame:
    """The cleaning chain: fill, low, recent, high, trailing months, balanced.

    Filling has already placed each series in one partition, so the tests on
    one client are windows there and cost no shuffle of their own. The steps after
    them ask for the latest period of what is left, so the filled and tested panel
    is written down once when this is called.
    """
    own = Window.partitionBy(id_col)
    out = interpolate(df, value, id_col, time_col, fill) if fill else df
    if drop_low:
        low = F.min(value).over(own)
        out = out.withColumn("__low", low).filter(F.coalesce(F.col("__low") > low_threshold, F.lit(True))).drop("__low")
    out = persist_table(out)
    if drop_recent and change_col:
        out = exclude_recent(out, change_col, months, id_col=id_col, time_col=time_col)
    if drop_high and class_col:
        out = persist_table(exclude_high(out, class_col, high_quantile, id_col, value))
    out = trailing_months(out, months, time_col)
    if only_balanced:
        periods = F.size(F.collect_set(time_col).over(own))
        out = out.withColumn("__n", periods).filter(F.col("__n") == months).drop("__n")
    return out


def completeness(df: DataFrame, id_col: str = "series_id") -> DataFrame:
    """Histogram of rows per client, the longest length and the count short of it."""
    lengths = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("months"))
    histogram = lengths.groupBy("months").agg(F.count(F.lit(1)).alias("clients"))
    longest = lengths.agg(F.max("months")).scalar()
    return histogram.withColumn("expected", longest).withColumn(
        "complete", F.col("months") == F.col("expected"))


def coerce(df: DataFrame, numbers: Sequence[str] = (), dates: Sequence[str] = ()) -> DataFrame:
    """Text to double / date; what does not parse is NULL."""
    def as_date(c: str) -> Column:
        return F.try_to_timestamp(F.trim(c)).cast("date")

    for c in numbers:
        df = df.withColumn(c, F.trim(c).try_cast("double"))
    for c in dates:
        df = df.withColumn(c, as_date(c))
    return df
