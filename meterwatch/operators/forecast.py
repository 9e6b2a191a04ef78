"""Forecast checks: is the end of a series far from what its start predicts?

Three forecasters share one gate. The optimisers are replaced by forms that
run without a solver: exponential smoothing over a fixed parameter grid, a
first-order autoregression by regression sums or an order search by two rounds of
regressions, and a trend with seasonal waves and bends by ridge equations. Series are bounded by the number of months.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterwatch.functions.scalar import fixed
from meterwatch.operators.ordering import global_rank
from meterwatch.operators.series import by_series, ordered_arrays
from meterwatch.session import persist_table

FLAT_DEVIATION = 1e-3
SEASON = 12
GRID_STEPS = 9
BREAK_SHARE = 0.8  # of the training months in which a trend may bend
LEAST_BEND = 1e-3
BEND_ROUNDS = 8
#: (autoregressive, differences, moving average) orders that are tried, and lags of the long autoregression.
ORDERS = tuple((p, d, q) for d in (0, 1) for p in (0, 1, 2) for q in (0, 1, 2) if p + q <= 3)
LONG_LAGS = 2
SHORT_OR_FLAT = "Corta/plana"  # fixed value: reason of the gate


def _grid(seasonal: bool) -> np.ndarray:
    """Parameter rows (alpha, beta[, gamma]) in ascending order."""
    fine = np.arange(1, GRID_STEPS + 1) / (GRID_STEPS + 1)
    if not seasonal:
        return np.array([(a, b) for a in fine for b in fine])
    coarse = np.array([0.1, 0.3, 0.5, 0.7, 0.9])
    return np.array([(a, b, g) for a in coarse for b in coarse for g in coarse])


def smooth_trend(train: np.ndarray, test_len: int) -> tuple[np.ndarray, ...]:
    """Additive trend over the grid: (alpha, beta, forecast) of the least error.

    ``train`` is (series, months); ties keep the smaller alpha, then beta.
    """
    grid = _grid(False)
    alpha, beta = grid[:, 0], grid[:, 1]
    shape = (train.shape[0], grid.shape[0])
    level = np.broadcast_to(train[:, :1], shape).copy()
    trend = np.broadcast_to((train[:, 1] - train[:, 0])[:, None], shape).copy()
    sse = np.zeros(shape)
    for m in range(1, train.shape[1]):
        error = train[:, m:m + 1] - (level + trend)
        level = level + trend + alpha * error
        trend = trend + alpha * beta * error
        sse = sse + error * error
    best = np.argmin(sse, axis=1)
    rows = np.arange(train.shape[0])
    ahead = np.arange(1, test_len + 1)
    forecast = level[rows, best][:, None] + ahead * trend[rows, best][:, None]
    return alpha[best], beta[best], forecast


def smooth_seasonal(train: np.ndarray, test_len: int) -> tuple[np.ndarray, ...]:
    """Additive trend and season of twelve months over a coarser grid."""
    grid = _grid(True)
    alpha, beta, gamma = grid.T
    first, second = train[:, :SEASON].mean(1), train[:, SEASON:2 * SEASON].mean(1)
    shape = (train.shape[0], grid.shape[0])
    level = np.broadcast_to(first[:, None], shape).copy()
    trend = np.broadcast_to(((second - first) / SEASON)[:, None], shape).copy()
    season = np.broadcast_to((train[:, :SEASON] - first[:, None])[:, None, :], (*shape, SEASON)).copy()
    sse = np.zeros(shape)
    for m in range(train.shape[1]):
        s = season[:, :, m % SEASON]
        error = train[:, m:m + 1] - (level + trend + s)
        level = level + trend + alpha * error
        trend = trend + alpha * beta * error
        season[:, :, m % SEASON] = s + gamma * (1 - alpha) * error
        sse = sse + error * error
    best = np.argmin(sse, axis=1)
    rows = np.arange(train.shape[0])
    ahead = np.arange(1, test_len + 1)
    waves = season[rows, best][:, (train.shape[1] + ahead - 1) % SEASON]
    forecast = level[rows, best][:, None] + ahead * trend[rows, best][:, None] + waves
    return alpha[best], beta[best], forecast


def fourier_forecast(train: np.ndarray, train_month: np.ndarray, test_month: np.ndarray,
                     pairs: int, ridge: float, knots: int = 0, break_penalty: float = 0.05, rounds: int = 1) -> np.ndarray:
    """Trend and ``pairs`` yearly waves by ridge normal equations, per series.

    The trend may bend at ``knots`` places, evenly over the first ``BREAK_SHARE`` of the
    training months. Bends are penalised by their square, and from the second round on by
    their size: each round divides the penalty of a bend by what it was, so that few bends
    stay. All series are solved as one batch.
    """
    start = train_month[:, :1]
    length = np.maximum(train_month[:, -1:] - start, 1)

    def design(month: np.ndarray) -> np.ndarray:
        t = (month - start) / length
        columns = [np.ones_like(month), t]
        columns += [np.maximum(t - BREAK_SHARE * k / (knots + 1), 0) for k in range(1, knots + 1)]
        for k in range(1, pairs + 1):
            angle = 2 * np.pi * k * month / SEASON
            columns += [np.sin(angle), np.cos(angle)]
        return np.stack(columns, axis=2)

    x = design(train_month)
    penalty = np.full((len(train), x.shape[2]), ridge)
    penalty[:, 0] = 0.0
    bends = slice(2, 2 + knots)
    penalty[:, bends] = break_penalty
    scale = np.abs(train).mean(1, keepdims=True)
    scale[scale == 0] = 1.0
    lhs = np.einsum("nti,ntj->nij", x, x)
    rhs = np.einsum("nti,nt->ni", x, train / scale)
    at = np.arange(x.shape[2])
    for _ in range(max(1, rounds)):
        system = lhs.copy()
        system[:, at, at] += penalty
        weights = np.linalg.solve(system, rhs[:, :, None])[:, :, 0]
        penalty[:, bends] = break_penalty / (np.abs(weights[:, bends]) + LEAST_BEND)
    return np.einsum("nti,ni->nt", design(test_month), weights) * scale


def _solve(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least squares of many series at once, the first column being ones: (coefficients, residuals).

    Columns are centred first; one without spread gets next to nothing.
    """
    means, level = x[:, :, 1:].mean(1), y.mean(1)
    centred, rest = x[:, :, 1:] - means[:, None, :], y - level[:, None]
    lhs = np.einsum("nti,ntj->nij", centred, centred)
    at = np.arange(lhs.shape[1])
    lhs[:, at, at] += 1e-12 * np.maximum(np.trace(lhs, axis1=1, axis2=2), 1e-12)[:, None]
    w = np.linalg.solve(lhs, np.einsum("nti,nt->ni", centred, rest)[:, :, None])[:, :, 0]
    constant = level - (means * w).sum(1)
    return np.concatenate([constant[:, None], w], axis=1), rest - np.einsum("nti,ni->nt", centred, w)


def _lags(z: np.ndarray, lags: int, rows: int) -> list[np.ndarray]:
    """The last ``rows`` values one, two, ... steps back."""
    length = z.shape[1]
    return [z[:, length - rows - k:length - k] for k in range(1, lags + 1)]


def search_orders(train: np.ndarray, test_len: int, orders: Sequence[tuple[int, int, int]] = ORDERS) -> tuple[np.ndarray, np.ndarray]:
    """(number of the chosen order, forecast) for many series (series, months).

    Hannan and Rissanen: a long autoregression gives the shocks, then every order is one
    regression on past values and past shocks. All orders are fitted to the same last
    months, so their AICc can be compared; one whose autoregression is not stationary is
    out. Ties go to the order that is named first.
    """
    n, length = train.shape
    long = LONG_LAGS if any(q for _, _, q in orders) else 0
    deepest = max(max(p, q) for p, _, q in orders)
    rows = length - max(d for _, d, _ in orders) - long - deepest
    best, criterion, ahead = np.zeros(n, int), np.full(n, np.inf), np.zeros((n, test_len))
    shocks: dict[int, np.ndarray] = {}
    for number, (p, d, q) in enumerate(orders):
        z = np.diff(train, d, axis=1)
        if q and d not in shocks:
            seen = z.shape[1] - LONG_LAGS
            x = np.stack([np.ones((n, seen)), *_lags(z, LONG_LAGS, seen)], axis=2)
            shocks[d] = np.concatenate([np.zeros((n, LONG_LAGS)), _solve(x, z[:, LONG_LAGS:])[1]], axis=1)
        e = shocks.get(d)
        x = np.stack([np.ones((n, rows)), *_lags(z, p, rows), *(_lags(e, q, rows) if q else [])], axis=2)
        w, residual = _solve(x, z[:, -rows:])
        k = p + q + 2
        if rows - k - 1 <= 0:
            continue
        score = rows * np.log(np.maximum((residual ** 2).sum(1), 1e-9) / rows) + 2 * k + 2 * k * (k + 1) / (rows - k - 1)
        phi = np.concatenate([w[:, 1:1 + p], np.zeros((n, 2 - p))], axis=1)
        stable = (np.abs(phi[:, 1]) < 1) & (phi[:, 0] + phi[:, 1] < 1) & (phi[:, 1] - phi[:, 0] < 1)
        score = np.where(stable, np.round(score, 6), np.inf)
        past, left = z[:, z.shape[1] - p:][:, ::-1].copy(), residual[:, residual.shape[1] - q:][:, ::-1].copy() if q else np.zeros((n, 0))
        steps = []
        for _ in range(test_len):
            step = w[:, 0] + (w[:, 1:1 + p] * past).sum(1) + (w[:, 1 + p:] * left).sum(1)
            steps.append(step)
            past = np.concatenate([step[:, None], past], axis=1)[:, :p]
            left = np.concatenate([np.zeros((n, 1)), left], axis=1)[:, :q]
        path = np.stack(steps, axis=1)
        path = train[:, -1:] + np.cumsum(path, axis=1) if d else path
        wins = score < criterion
        best[wins], criterion[wins], ahead[wins] = number, score[wins], path[wins]
    return best, ahead


def _gated(df: DataFrame, train_len: int, test_len: int, id_col: str, time_col: str, value: str,
           need_longer: bool) -> DataFrame:
    """Ordered arrays with the mean and flatness of the training part."""
    arrays = ordered_arrays(df, value, id_col, time_col)
    train = F.slice("values", 1, train_len)
    n = F.size("values")
    total = F.aggregate(train, F.lit(0.0), lambda s, v: s + v)
    mean = total / F.least(n, F.lit(train_len))
    spread = F.aggregate(train, F.lit(0.0), lambda s, v: s + (v - F.col("__mean")) * (v - F.col("__mean")))
    magnitude = F.aggregate(train, F.lit(0.0), lambda s, v: s + F.abs(v)) / F.least(n, F.lit(train_len))
    rows = arrays.withColumn("__mean", mean).withColumn("magnitude", magnitude)
    deviation = F.sqrt(spread / F.least(n, F.lit(train_len)))
    used = F.slice("values", 1, train_len + test_len)
    enough = (n >= train_len + test_len) & (deviation >= FLAT_DEVIATION) & ~F.exists(used, lambda v: v.isNull())
    if need_longer:
        enough = enough & (n > train_len)
    return rows.withColumn("enough", F.coalesce(enough, F.lit(False))).drop("__mean")


def _error_and_flag(mae: Column, limit: float) -> Column:
    return F.when(mae.isNotNull(), mae > F.lit(limit) * F.col("magnitude"))


def _reason(enough: Column) -> Column:
    return F.when(enough, F.lit("")).otherwise(F.lit(SHORT_OR_FLAT))


def ets_check(
    df: DataFrame, train_len: int = 24, test_len: int = 4, limit: float = 0.95,
    id_col: str = "series_id", time_col: str = "period", value: str = "value",
) -> DataFrame:
    """Exponential smoothing: error on the test months against the limit.

    A season needs two years of training. Too short or flat series get a
    reason and NULL results.
    """
    gated = _gated(df, train_len, test_len, id_col, time_col, value, need_longer=True)
    kind = gated.schema[id_col].dataType.simpleString()
    smooth = smooth_seasonal if train_len >= 2 * SEASON else smooth_trend

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = pd.DataFrame({id_col: batch[id_col], "magnitude": batch["magnitude"], "enough": batch["enough"]})
            out["alpha"] = out["beta"] = out["mae_ets"] = np.nan
            ok = np.flatnonzero(batch["enough"].to_numpy())
            if len(ok):
                y = np.array([np.asarray(v, float)[:train_len + test_len] for v in batch["values"].iloc[ok]])
                alpha, beta, forecast = smooth(y[:, :train_len], test_len)
                at = out.index[ok]
                out.loc[at, "alpha"], out.loc[at, "beta"] = alpha, beta
                out.loc[at, "mae_ets"] = np.abs(y[:, train_len:] - forecast).mean(1)
            yield out

    schema = f"`{id_col}` {kind}, magnitude double, enough boolean, alpha double, beta double, mae_ets double"
    fitted = gated.select(id_col, "values", "magnitude", "enough").mapInPandas(fit, schema)
    numbers = [F.when(F.col("enough"), F.col(c)).alias(c) for c in ("alpha", "beta", "mae_ets")]
    fitted = fitted.select(id_col, "magnitude", "enough", *numbers)
    return fitted.select(
        id_col, F.col("enough").alias("enough_data"),
        _reason(F.col("enough")).alias("reason"),
        "alpha", "beta", "mae_ets", _error_and_flag(F.col("mae_ets"), limit).alias("anomaly_ets"))


def ar_check(
    df: DataFrame, train_len: int = 24, test_len: int = 4, limit: float = 0.6,
    id_col: str = "series_id", time_col: str = "period", value: str = "value",
) -> DataFrame:
    """First-order autoregression on levels or on steps, chosen by AICc.

    Both fits are regression sums over one window partition; the forecast of
    ``h`` steps is the closed form of the recursion.
    """
    w, whole = by_series(id_col, time_col), Window.partitionBy(id_col)
    rows = df.select(
        id_col, time_col, F.col(value).cast("double").alias("y"),
        F.row_number().over(w).alias("i"), F.count(F.lit(1)).over(whole).alias("n"),
        F.lag(F.col(value).cast("double")).over(w).alias("y1"),
        F.lag(F.col(value).cast("double"), 2).over(w).alias("y2"),
    ).filter(F.col("i") <= train_len + test_len)
    train = F.col("i") <= train_len
    step, step1 = F.col("y") - F.col("y1"), F.col("y1") - F.col("y2")

    def sums(target: Column, past: Column, tag: str) -> list[Column]:
        x, y = F.when(train, past), F.when(train, target)
        return [F.regr_slope(y, x).alias(f"phi_{tag}"), F.regr_intercept(y, x).alias(f"c_{tag}"),
                F.regr_count(y, x).alias(f"n_{tag}"), F.regr_syy(y, x).alias(f"syy_{tag}"),
                F.regr_sxy(y, x).alias(f"sxy_{tag}"), F.avg(F.when(x.isNotNull(), y)).alias(f"m_{tag}")]

    fitted = rows.groupBy(id_col).agg(
        F.max("n").alias("n"), F.stddev_pop(F.when(train, F.col("y"))).alias("deviation"),
        F.avg(F.when(train, F.abs("y"))).alias("magnitude"),
        F.count_if(F.col("y").isNull()).alias("gaps"),
        F.max(F.when(F.col("i") == train_len, F.col("y"))).alias("last_y"),
        F.max(F.when(F.col("i") == train_len, step)).alias("last_step"),
        *sums(F.col("y"), F.col("y1"), "level"), *sums(step, step1, "step"),
        F.sort_array(F.collect_list(F.when(~train, F.struct("i", "y")))).alias("test"),
    )

    def phi(tag: str) -> Column:  # a past without spread predicts nothing
        return F.greatest(F.least(F.coalesce(F.col(f"phi_{tag}"), F.lit(0.0)), F.lit(0.99)), F.lit(-0.99))

    def start(tag: str) -> Column:
        return F.coalesce(F.col(f"c_{tag}"), F.col(f"m_{tag}"))

    def aicc(tag: str) -> Column:
        n = F.col(f"n_{tag}").cast("double")
        sse = F.greatest(F.col(f"syy_{tag}") - F.coalesce(F.col(f"phi_{tag}"), F.lit(0.0)) * F.coalesce(
            F.col(f"sxy_{tag}"), F.lit(0.0)), F.lit(1e-9))
        return n * F.ln(F.try_divide(sse, n)) + F.lit(6.0) + F.try_divide(F.lit(24.0), n - 4)  # three parameters

    enough = ((F.col("n") >= train_len + test_len) & (F.col("deviation") >= FLAT_DEVIATION) & (F.col("gaps") == 0))
    chosen = F.when(fixed(aicc("level"), 6) <= fixed(aicc("step"), 6), F.lit("level")).otherwise(F.lit("step"))
    rows = fitted.select(
        id_col, "magnitude", "last_y", "last_step", "test", enough.alias("enough"), chosen.alias("model"),
        phi("level").alias("p_level"), start("level").alias("c_level"),
        phi("step").alias("p_step"), start("step").alias("c_step"))

    def forecast(h: Column) -> Column:
        p, c = F.col("p_level"), F.col("c_level")
        level = F.col("last_y") * F.pow(p, h) + c * (1 - F.pow(p, h)) / (1 - p)
        q, d = F.col("p_step"), F.col("c_step")
        mean = d / (1 - q)
        total = h * mean + (F.col("last_step") - mean) * q * (1 - F.pow(q, h)) / (1 - q)
        return F.when(F.col("model") == "level", level).otherwise(F.col("last_y") + total)

    error = F.aggregate("test", F.lit(0.0), lambda s, e: s + F.abs(e["y"] - forecast((e["i"] - train_len).cast("double"))))
    rows = rows.withColumn("mae_ar", F.when(F.col("enough"), error / test_len))
    return rows.select(id_col, _reason(F.coalesce("enough", F.lit(False))).alias("reason_ar"),
                       F.when(F.col("enough"), F.col("model")).alias("model"), "mae_ar",
                       _error_and_flag(F.col("mae_ar"), limit).alias("anomaly_ar"))


def arima_check(
    df: DataFrame, train_len: int = 24, test_len: int = 4, limit: float = 0.6,
    id_col: str = "series_id", time_col: str = "period", value: str = "value", orders: Sequence[tuple[int, int, int]] = ORDERS,
) -> DataFrame:
    """Autoregression, differences and moving average with the order searched per series.

    Same columns as ``ar_check``; ``model`` is the chosen order. Orders have one difference
    and two lags of a kind at most; seasonal orders are not searched.
    """
    if any(not (0 <= p <= 2 and 0 <= d <= 1 and 0 <= q <= 2) for p, d, q in orders):
        raise ValueError("orders have at most two lags of a kind and one difference")
    gated = _gated(df, train_len, test_len, id_col, time_col, value, need_longer=False)
    kind = gated.schema[id_col].dataType.simpleString()
    names = np.array([str(o).replace(" ", "") for o in orders], object)

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = pd.DataFrame({id_col: batch[id_col], "magnitude": batch["magnitude"], "enough": batch["enough"]})
            out["model"], out["mae_ar"] = pd.Series([None] * len(batch), index=out.index, dtype=object), np.nan
            ok = np.flatnonzero(batch["enough"].to_numpy())
            if len(ok):
                y = np.array([np.asarray(v, float)[:train_len + test_len] for v in batch["values"].iloc[ok]])
                number, ahead = search_orders(y[:, :train_len], test_len, orders)
                out.loc[out.index[ok], "model"] = names[number]
                out.loc[out.index[ok], "mae_ar"] = np.abs(y[:, train_len:] - ahead).mean(1)
            yield out

    fitted = gated.select(id_col, "values", "magnitude", "enough").mapInPandas(
        fit, f"`{id_col}` {kind}, magnitude double, enough boolean, model string, mae_ar double")
    fitted = fitted.withColumn("mae_ar", F.when(~F.isnan("mae_ar"), F.col("mae_ar")))
    return fitted.select(id_col, _reason(F.col("enough")).alias("reason_ar"), "model", "mae_ar", _error_and_flag(F.col("mae_ar"), limit).alias("anomaly_ar"))


def fourier_check(
    df: DataFrame, train_len: int = 24, test_len: int = 4, limit: float = 0.6, pairs: int = 2, ridge: float = 0.1,
    id_col: str = "series_id", time_col: str = "period", value: str = "value", knots: int = 0, rounds: int = 1,
) -> DataFrame:
    """Trend with yearly waves: error on the test months against the limit.

    With ``knots`` the trend may bend, see ``fourier_forecast``.
    """
    gated = _gated(df, train_len, test_len, id_col, time_col, value, need_longer=False)
    months = F.transform("periods", lambda d: (F.year(d) * 12 + F.month(d)).cast("double"))
    gated = gated.select(id_col, "values", months.alias("months"), "magnitude", "enough")
    kind = gated.schema[id_col].dataType.simpleString()
    used = train_len + test_len

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = pd.DataFrame({id_col: batch[id_col], "magnitude": batch["magnitude"], "enough": batch["enough"]})
            out["mae_fourier"] = np.nan
            ok = np.flatnonzero(batch["enough"].to_numpy())
            if len(ok):
                y = np.array([np.asarray(v, float)[:used] for v in batch["values"].iloc[ok]])
                m = np.array([np.asarray(v, float)[:used] for v in batch["months"].iloc[ok]])
                forecast = fourier_forecast(y[:, :train_len], m[:, :train_len], m[:, train_len:], pairs, ridge, knots, rounds=rounds)
                out.loc[out.index[ok], "mae_fourier"] = np.abs(y[:, train_len:] - forecast).mean(1)
            yield out

    fitted = gated.mapInPandas(fit, f"`{id_col}` {kind}, magnitude double, enough boolean, mae_fourier double")
    fitted = fitted.withColumn("mae_fourier", F.when(~F.isnan("mae_fourier"), F.col("mae_fourier")))
    return fitted.select(id_col, _reason(F.col("enough")).alias("reason_fourier"), "mae_fourier", _error_and_flag(F.col("mae_fourier"), limit).alias("anomaly_fourier"))


def consensus(flags: DataFrame, columns: tuple[str, ...] = ("anomaly_ets", "anomaly_ar", "anomaly_fourier"),
              needed: int = 2) -> DataFrame:
    """True where at least ``needed`` flags are true; NULL is no vote."""
    votes = sum((F.coalesce(F.col(c), F.lit(False)).cast("int") for c in columns), F.lit(0))
    return flags.withColumn("votes", votes).withColumn("anomaly_final", F.col("votes") >= needed)


def confirmed_anomalies(
    df: DataFrame, train_len: int = 15, test_len: int = 4, first_limit: float = 0.9, limit: float = 0.6,
    id_col: str = "series_id", time_col: str = "period", value: str = "value", search: bool = False, knots: int = 0,
) -> DataFrame:
    """Only clients that the first forecaster flags go through the other two.

    Those are written down when this is called, as they are read three times. With
    ``search`` the second forecaster searches its order, with ``knots`` the third one bends.
    """
    flagged = persist_table(ets_check(df, train_len, test_len, first_limit, id_col, time_col, value).filter("anomaly_ets"))
    rest = df.join(flagged.select(id_col), id_col, "left_semi")
    names = (id_col, time_col, value)
    ar = (arima_check if search else ar_check)(rest, train_len, test_len, limit, *names)
    waves = fourier_check(rest, train_len, test_len, limit, id_col=id_col, time_col=time_col, value=value, knots=knots, rounds=BEND_ROUNDS if knots else 1)
    return consensus(flagged.join(ar, id_col, "left").join(waves, id_col, "left"))


def forecast_ranking(errors: DataFrame, columns: tuple[str, ...] = ("mae_ets", "mae_ar", "mae_fourier"),
                     id_col: str = "series_id") -> DataFrame:
    """Largest errors first, missing ones last."""
    return global_rank(errors, [*[fixed(F.col(c)).desc_nulls_last() for c in columns], F.col(id_col).asc()])
