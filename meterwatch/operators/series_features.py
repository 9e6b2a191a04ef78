"""Shape features of a series, one row per id.

All functions read an *indexed* series (``index_series``): position ``t`` from
0, length ``n`` and whole-series moments, laid down by one shuffle on the id.
Most features are a ``Part``: window columns over that partitioning and one
aggregate by id, so any number of parts shares one pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterwatch.functions.nulls import nan_to_null
from meterwatch.functions.stats import student_p_integer
from meterwatch.operators.relational import first_per_key
from meterwatch.session import persist_table, spread

# fixed values: parameters of the feature catalogue
PEAK_SUPPORTS = (1, 3, 5, 10, 50)
QUANTILE_GRID = (0.0, 0.2, 0.4, 0.6, 0.8, 1.0)
AUTOCORRELATION_LAGS = tuple(range(10))
ENTROPY_TOLERANCE = 0.2
FOURIER_COEFFICIENTS = 100


def index_series(df: DataFrame, id_col: str = "series_id", time_col: str = "period", value: str = "value") -> DataFrame:
    """Columns ``t``, ``x``, ``n``, ``mean`` and ``std`` (population)."""
    whole = Window.partitionBy(id_col)
    order = whole.orderBy(time_col)
    return spread(df.select(id_col, time_col, value), id_col).filter(F.col(value).isNotNull()).select(
        id_col, F.col(value).cast("double").alias("x"),
        (F.row_number().over(order) - 1).alias("t"),
        F.count(F.lit(1)).over(whole).alias("n"),
        F.avg(value).over(whole).alias("mean"),
        F.stddev_pop(value).over(whole).alias("std"))


@dataclass(frozen=True)
class Part:
    """Window columns, aggregates over them, and result columns from those."""

    columns: list[Column] = field(default_factory=list)
    measures: list[Column] = field(default_factory=list)
    results: list[Column] = field(default_factory=list)


def aggregate_parts(s: DataFrame, parts: Sequence[Part], id_col: str = "series_id") -> DataFrame:
    """All parts in one window step and one aggregate by id."""
    rows = s.select("*", *[c for p in parts for c in p.columns])
    table = rows.groupBy(id_col).agg(*[m for p in parts for m in p.measures])
    return table.select(id_col, *[r for p in parts for r in p.results])


def _order(id_col: str):
    return Window.partitionBy(id_col).orderBy("t")


def _peaks_part(id_col: str, supports: Sequence[int] = PEAK_SUPPORTS) -> Part:
    w = _order(id_col)
    marks = [
        ((F.col("t") >= k) & (F.col("t") < F.col("n") - k)
         & (F.col("x") > F.max("x").over(w.rowsBetween(-k, -1)))
         & (F.col("x") > F.max("x").over(w.rowsBetween(1, k)))).alias(f"peak{k}")
        for k in supports
    ]
    names = [f"number_peaks_{k}" for k in supports]
    return Part(marks, [F.count_if(F.col(f"peak{k}")).alias(n) for k, n in zip(supports, names)],
                [F.col(n) for n in names])


def number_peaks(s: DataFrame, id_col: str = "series_id", supports: Sequence[int] = PEAK_SUPPORTS) -> DataFrame:
    """Points above their ``k`` neighbours on both sides."""
    return aggregate_parts(s, [_peaks_part(id_col, supports)], id_col)


def _entropy(x: np.ndarray, m: int, r: float) -> float:
    """-ln(A/B) with A and B the close pairs of templates of length m + 1 and m.

    Infinite without a pair of the longer kind, NaN without any.
    """
    n = len(x) - m + 1
    if n < 2:
        return np.nan
    close = np.abs(x[:, None] - x[None, :]) <= r
    pairs = close[:n, :n].copy()
    for step in range(1, m):
        pairs &= close[step:step + n, step:step + n]
    b = pairs.sum() - n
    longer = pairs[:n - 1, :n - 1] & close[m:, m:]
    a = longer.sum() - (n - 1)
    return np.nan if b == 0 else float(-np.log(a / b)) if a > 0 else np.inf


def sample_entropy(s: DataFrame, id_col: str = "series_id", m: int = 2, tolerance: float = ENTROPY_TOLERANCE) -> DataFrame:
    """-ln(A/B) over templates of length ``m + 1`` and ``m``.

    Quadratic in the length of one series, so its ordered values are compared
    as one small matrix inside the task; no pair becomes a row.
    """
    arrays = s.groupBy(id_col).agg(
        F.sort_array(F.collect_list(F.struct("t", "x"))).alias("s"), F.max("std").alias("std"))
    arrays = arrays.select(id_col, F.col("s.x").alias("x"), "std")
    kind = arrays.schema[id_col].dataType.simpleString()

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = [_entropy(np.asarray(x, float), m, tolerance * std) for x, std in zip(batch["x"], batch["std"])]
            yield pd.DataFrame({id_col: batch[id_col], "e": values})

    found = arrays.mapInPandas(compute, f"`{id_col}` {kind}, e double")
    return found.select(id_col, nan_to_null(F.col("e")).alias("sample_entropy"))


def _moments_part() -> Part:
    n = F.col("m_n").cast("double")
    measures = [F.count("x").alias("m_n"), F.skewness("x").alias("m_g1"), F.kurtosis("x").alias("m_g2"),
                F.try_divide(F.stddev_pop("x"), F.avg("x")).alias("variation_coefficient")]
    skew = F.when(n > 2, F.col("m_g1") * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("m_g2") + 6))
    return Part([], measures, [skew.alias("skewness"), kurt.alias("kurtosis"), F.col("variation_coefficient")])


def moments(s: DataFrame, id_col: str = "series_id") -> DataFrame:
    """Adjusted skewness and kurtosis, variation coefficient."""
    return aggregate_parts(s, [_moments_part()], id_col)


def recurring_share(s: DataFrame, id_col: str = "series_id") -> DataFrame:
    """Distinct values seen more than once against distinct values."""
    counted = s.groupBy(id_col, "x").agg(F.count(F.lit(1)).alias("c"))
    return counted.groupBy(id_col).agg(
        (F.count_if(F.col("c") > 1) / F.count(F.lit(1))).alias("recurring_share"))


def corridors(grid: Sequence[float] = QUANTILE_GRID) -> list[tuple[float, float]]:
    return list(combinations(grid, 2))


def _corridor_name(low: float, high: float, absolute: bool, kind: str) -> str:
    return f"change_quantiles_{round(low * 100)}_{round(high * 100)}_{'abs' if absolute else 'raw'}_{kind}"


def _corridor_part(id_col: str, grid: Sequence[float] = QUANTILE_GRID) -> Part:
    probs = F.array(*[F.lit(float(p)) for p in grid])
    columns = [F.lag("x").over(_order(id_col)).alias("q_x0"),
               F.percentile("x", probs).over(Window.partitionBy(id_col)).alias("q_at")]
    d = F.col("x") - F.col("q_x0")
    measures, results = [], []
    for low, high in corridors(grid):
        a, b = F.col("q_at")[grid.index(low)], F.col("q_at")[grid.index(high)]
        inside = F.col("x").between(a, b) & F.col("q_x0").between(a, b)
        for absolute in (False, True):
            step = F.when(inside, F.abs(d) if absolute else d)
            for kind, agg in (("mean", F.avg), ("var", F.var_pop)):
                name = _corridor_name(low, high, absolute, kind)
                measures.append(F.coalesce(agg(step), F.lit(0.0)).alias(name))
                results.append(F.col(name))
    return Part(columns, measures, results)


def change_quantiles(s: DataFrame, id_col: str = "series_id", grid: Sequence[float] = QUANTILE_GRID) -> DataFrame:
    """Mean and variance of the steps whose two ends lie in a quantile corridor.

    The quantiles are exact and per series, so their state is bounded.
    """
    return aggregate_parts(s, [_corridor_part(id_col, grid)], id_col)


def _autocorrelation_part(id_col: str, lags: Iterable[int] = AUTOCORRELATION_LAGS) -> Part:
    w = _order(id_col)
    c = F.col("x") - F.col("mean")
    lags = list(lags)
    products = [(c * (F.lead("x", k).over(w) - F.col("mean")) if k else c * c).alias(f"ac{k}") for k in lags]
    names = [f"autocorrelation_{k}" for k in lags]
    sums = [F.try_divide(F.sum(f"ac{k}"), (F.max("n") - k) * F.max("std") * F.max("std")).alias(n) for k, n in zip(lags, names)]
    return Part(products, sums, [F.col(n) for n in names])


def autocorrelation(s: DataFrame, id_col: str = "series_id", lags: Iterable[int] = AUTOCORRELATION_LAGS) -> DataFrame:
    """Products of deviations ``k`` apart over (n - k) variances."""
    return aggregate_parts(s, [_autocorrelation_part(id_col, lags)], id_col)


def _trend_part() -> Part:
    t = F.col("t").cast("double")
    varied = F.when(F.col("std") > 0, F.col("x"))  # a flat series has no r; asked for it, the aggregate divides by zero
    measures = [
        F.count("x").alias("r_n"), F.regr_slope("x", t).alias("trend_slope"), F.regr_intercept("x", t).alias("trend_intercept"),
        F.corr(varied, t).alias("trend_r"), F.var_pop("x").alias("r_vy"), F.var_pop(t).alias("r_vx")]
    dof = F.col("r_n") - 2
    r2 = F.col("trend_r") * F.col("trend_r")
    error = F.when(dof > 0, F.sqrt(F.try_divide((1 - r2) * F.col("r_vy"), F.col("r_vx") * dof)))
    p = F.when(F.col("trend_r").isNotNull(), student_p_integer(F.try_divide(F.col("trend_slope"), error), dof.cast("int")))
    return Part([], measures, [F.col("trend_slope"), F.col("trend_intercept"), F.col("trend_r"),
                               error.alias("trend_stderr"), p.alias("trend_p")])


def linear_trend(s: DataFrame, id_col: str = "series_id") -> DataFrame:
    """Least squares on the position: slope, intercept, r, error of the slope, p."""
    return aggregate_parts(s, [_trend_part()], id_col)


def _steps_part(id_col: str) -> Part:
    d = F.col("x") - F.lag("x").over(_order(id_col))

    def at(position: Column) -> Column:
        return F.max(F.when(F.col("t") == position, F.col("x")))

    n = F.max("n")
    ends = at(F.col("n") - 1) - at(F.col("n") - 2) - at(F.lit(1)) + at(F.lit(0))
    raw = F.sqrt(F.sum(F.col("s_d") * F.col("s_d")))
    measures = [
        raw.alias("cid_ce"), F.coalesce(F.try_divide(raw, F.max("std")), F.lit(0.0)).alias("cid_ce_normalised"),
        F.sum(F.abs("s_d")).alias("absolute_sum_of_changes"),
        F.try_divide(ends, 2 * (n - 2)).alias("mean_second_derivative_central")]
    names = ("cid_ce", "cid_ce_normalised", "absolute_sum_of_changes", "mean_second_derivative_central")
    return Part([d.alias("s_d")], measures, [F.col(c) for c in names])


def step_features(s: DataFrame, id_col: str = "series_id") -> DataFrame:
    """Complexity (raw and standardised), absolute change, second derivative."""
    return aggregate_parts(s, [_steps_part(id_col)], id_col)


def _first_maximum_part() -> Part:
    best = F.min_by(F.col("t"), F.struct(-F.col("x"), F.col("t")))
    return Part([], [(best / F.max("n")).alias("first_location_of_maximum")], [F.col("first_location_of_maximum")])


def first_maximum(s: DataFrame, id_col: str = "series_id") -> DataFrame:
    """Relative position of the first maximum."""
    return aggregate_parts(s, [_first_maximum_part()], id_col)


def streak_below_mean(s: DataFrame, id_col: str = "series_id") -> DataFrame:
    """Longest run of values below the mean."""
    below = F.col("x") < F.col("mean")
    above_so_far = F.sum(F.when(below, 0).otherwise(1)).over(
        _order(id_col).rowsBetween(Window.unboundedPreceding, 0))
    runs = s.select(id_col, below.alias("below"), above_so_far.alias("island"))
    sizes = runs.groupBy(id_col, "island").agg(F.count_if("below").alias("size"))
    return sizes.groupBy(id_col).agg(F.max("size").alias("longest_streak_below_mean"))


def _spectra(s: DataFrame, id_col: str) -> DataFrame:
    """id, re, im: the coefficients of each series in two arrays; many series of a length at once."""
    kind = s.schema[id_col].dataType.simpleString()

    def transform(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = np.empty(len(batch), object)
            lengths = np.array([len(v) for v in batch["values"]])
            for n in np.unique(lengths):
                at = np.flatnonzero(lengths == n)
                waves = np.fft.rfft(np.array([[np.nan if x is None else x for x in batch["values"].iloc[i]] for i in at], float), axis=1)
                for i, w in zip(at, waves):
                    found[i] = w
            yield pd.DataFrame({id_col: batch[id_col], "re": [w.real for w in found], "im": [w.imag for w in found]})

    ordered = F.array_sort(F.collect_list(F.struct("t", F.col("x").cast("double").alias("x"))))
    arrays = s.groupBy(id_col).agg(ordered.alias("pairs")).select(id_col, F.col("pairs.x").alias("values"))
    return arrays.mapInPandas(transform, f"`{id_col}` {kind}, re array<double>, im array<double>")


def _coefficient(re: Column, im: Column) -> dict[str, Column]:
    # noise around zero would flip the angle between -180 and 180
    x, y = F.round(re, 6) + F.lit(0.0), F.round(im, 6) + F.lit(0.0)
    return {"fft_real": re, "fft_imag": im, "fft_abs": F.sqrt(re * re + im * im), "fft_angle": F.degrees(F.atan2(y, x))}


def fourier(s: DataFrame, id_col: str = "series_id", coefficients: int = FOURIER_COEFFICIENTS) -> DataFrame:
    """Real, imaginary, modulus and angle (degrees) of each coefficient, long form."""
    zipped = F.slice(F.arrays_zip("re", "im"), 1, coefficients)
    rows = _spectra(s, id_col).select(id_col, F.posexplode(zipped).alias("k", "w"))
    return rows.select(id_col, "k", *[c.alias(name) for name, c in _coefficient(F.col("w.re"), F.col("w.im")).items()])


def fourier_wide(s: DataFrame, id_col: str = "series_id", coefficients: int | None = None) -> DataFrame:
    """The coefficients side by side, as many as the longest series has, at most ``FOURIER_COEFFICIENTS``.

    Unless their number is given, the longest series is looked up when this is called.
    """
    if coefficients is None:
        longest = s.agg(F.max("n")).first()[0] or 0
        coefficients = min(FOURIER_COEFFICIENTS, int(longest) // 2 + 1)
    cells = [c.alias(f"{name}_{k}") for k in range(coefficients)
             for name, c in _coefficient(F.get("re", F.lit(k)), F.get("im", F.lit(k))).items()]
    return _spectra(s, id_col).select(id_col, *cells)


def single_pass(s: DataFrame, id_col: str = "series_id") -> DataFrame:
    """Every feature that is a part, together."""
    return aggregate_parts(s, [
        _peaks_part(id_col), _moments_part(), _corridor_part(id_col), _autocorrelation_part(id_col), _trend_part(),
        _steps_part(id_col), _first_maximum_part()], id_col)


def missing_counts(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """column, missing, rows: for every column but those of ``keep``.

    Counts of parts of a table add up to those of the whole. NULL and NaN are missing; an
    infinity is a value, so a client whose entropy is infinite does not take a feature from
    all others.
    """
    floats = {f.name for f in df.schema.fields if f.dataType.simpleString() in ("float", "double")}
    names = [c for c in df.columns if c not in keep]
    if not names:
        return df.sparkSession.createDataFrame([], "column string, missing long, rows long")
    gone = {c: F.col(c).isNull() | F.isnan(c) if c in floats else F.col(c).isNull() for c in names}
    counts = df.agg(F.count("*").alias("__rows"), *[F.count_if(gone[c]).alias(c) for c in names])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing"), F.col("__rows").alias("rows")) for c in names])
    return counts.select(F.explode(cells).alias("c")).select("c.*")


def drop_incomplete_columns(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Drop the columns with a missing value anywhere; one aggregate finds them all."""
    gaps = {r["column"] for r in missing_counts(df, keep).filter("missing > 0").collect()}  # a row per column
    return df.select(*[c for c in df.columns if c in keep or c not in gaps])


def feature_table(
    df: DataFrame, metadata: DataFrame | None = None, id_col: str = "series_id",
    time_col: str = "period", value: str = "value", wanted: Sequence[str] | None = None, complete: bool = True,
    longest: int | None = None,
) -> DataFrame:
    """All features side by side, complete columns only, with metadata.

    ``wanted`` names the features that are asked for (all if not given); what they
    do not need is not computed. Without ``complete`` columns with missing values
    stay; ``longest`` is the length that the number of coefficients follows (that of the longest
    series if not given), for tables that are computed in parts. Every branch starts from the same shuffle on the id and stays in its
    partitioning, so neither the aggregates nor the joins move rows again; the
    table is written once before it is asked for missing values.
    """
    indexed = index_series(df, id_col, time_col, value)
    table = single_pass(indexed, id_col)
    waves = partial(fourier_wide, coefficients=longest and min(FOURIER_COEFFICIENTS, longest // 2 + 1))
    branches = {"sample_entropy": sample_entropy, "recurring_share": recurring_share, "longest_streak_below_mean": streak_below_mean,
                "fft_": waves}
    for prefix, compute in branches.items():
        if wanted is None or any(c.startswith(prefix) for c in wanted):
            table = table.join(compute(indexed, id_col), id_col, "left")
    if wanted is not None:
        unknown = [c for c in wanted if c not in table.columns]
        if unknown:
            raise ValueError(f"unknown features: {', '.join(unknown)}")
        table = table.select(id_col, *wanted)
    if complete:
        table = drop_incomplete_columns(persist_table(table), [id_col])
    if metadata is None:
        return table
    rest = [c for c in metadata.columns if c != id_col]
    return table.join(first_per_key(metadata, [id_col], rest), id_col)


def feature_columns(table: DataFrame, others: Sequence[str]) -> list[str]:
    return [c for c in table.columns if c not in others]
