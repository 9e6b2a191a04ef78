"""Two-regime switching test per series.

Each regime is a line through the origin of time (slope only) with its own
variance; regimes follow a Markov chain fitted by expectation-maximisation from several starts.
The observations of the two regimes are then compared by a mean or rank test.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwatch.functions.stats import normal_two_sided, student_p
from meterwatch.operators.series import ordered_arrays

MAX_ROUNDS = 100
TOLERANCE = 1e-6
MIN_VARIANCE_SHARE = 1e-4
LEAST_CHANCE = 1e-10
#: Pairs of values that the rank test holds at a time.
PAIRS = 4_000_000
COLUMNS = {"regime_means": "array<double>", "p_value": "double", "regimes": "array<int>", "slope": "array<double>",
           "variance": "array<double>", "chain": "array<double>", "first": "array<double>", "log_likelihood": "double"}


def _expect(y: np.ndarray, present: np.ndarray, slope: np.ndarray, variance: np.ndarray,
            chain: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(smoothed probabilities, expected moves, log-likelihood).

    Forward filtering and backward smoothing step through time with all
    series side by side; absent cells carry no evidence.
    """
    length = y.shape[1]
    t = np.arange(1, length + 1, dtype=float)[None, :]
    residual = y[:, :, None] - slope[:, None, :] * t[:, :, None]
    log_density = -0.5 * (np.log(2 * np.pi * variance)[:, None, :] + residual ** 2 / variance[:, None, :])
    log_density = np.where(present[:, :, None], log_density, 0.0)
    shift = log_density.max(2, keepdims=True)
    density = np.exp(log_density - shift)
    filtered, predicted = np.empty_like(density), np.empty_like(density)
    likelihood, ahead = shift[:, :, 0].sum(1), first
    for s in range(length):
        predicted[:, s] = ahead
        joint = ahead * density[:, s]
        total = joint.sum(1, keepdims=True)
        likelihood = likelihood + np.log(total[:, 0])
        filtered[:, s] = joint / total
        ahead = (filtered[:, s, :, None] * chain).sum(1)
    smoothed = np.empty_like(filtered)
    smoothed[:, -1] = filtered[:, -1]
    moves = np.zeros_like(chain)
    for s in range(length - 2, -1, -1):
        back = smoothed[:, s + 1] / np.maximum(predicted[:, s + 1], 1e-300)
        pair = filtered[:, s, :, None] * chain * back[:, None, :]
        moves += np.where(present[:, s + 1, None, None], pair, 0.0)  # what lies behind a series' end moves nothing
        smoothed[:, s] = pair.sum(2)
    return smoothed, moves, likelihood


@dataclass
class Regimes:
    """What was fitted to each series, and the log-likelihood of these very parameters."""
    prob: np.ndarray
    slope: np.ndarray
    variance: np.ndarray
    chain: np.ndarray
    first: np.ndarray
    value: np.ndarray
    history: np.ndarray


def _starts(y: np.ndarray, present: np.ndarray, regimes: int) -> list[np.ndarray]:
    """First responsibilities: by the ratio to time, by position, and by the distance from the mean."""
    n, length = y.shape
    count = present.sum(1, keepdims=True)
    position = np.cumsum(present, axis=1) - 1
    mean = np.where(present, y, 0).sum(1, keepdims=True) / count

    def ranked(x: np.ndarray) -> np.ndarray:
        x = np.where(present, x, np.nan)
        cuts = np.nanquantile(x, np.arange(1, regimes) / regimes, axis=1).T
        return (x[:, :, None] > cuts[:, None, :]).sum(2)

    members = [ranked(y / np.arange(1, length + 1)[None, :]), np.minimum(position * regimes // count, regimes - 1), ranked(np.abs(y - mean))]
    out = []
    for member in members:
        prob = np.stack([(member == k) for k in range(regimes)], axis=2) * 0.9 + 0.1 / regimes
        out.append(np.where(present[:, :, None], prob, 1.0 / regimes))
    return out


def _open(p: np.ndarray) -> np.ndarray:
    """Chances with none so small that a filter could run out of them."""
    p = np.maximum(p, LEAST_CHANCE)
    return p / p.sum(-1, keepdims=True)


def _climb(y: np.ndarray, present: np.ndarray, prob: np.ndarray) -> Regimes:
    """Expectation-maximisation from the responsibilities given; a series that has settled leaves the rounds."""
    n, length, regimes = prob.shape
    prob = prob.copy()
    t = np.arange(1, length + 1, dtype=float)[None, :]
    count = present.sum(1)
    mean = np.where(present, y, 0).sum(1) / count
    floor = np.maximum(MIN_VARIANCE_SHARE * (np.where(present, y - mean[:, None], 0) ** 2).sum(1) / count, 1e-12)
    stay = 0.9
    chain = np.full((n, regimes, regimes), (1 - stay) / max(regimes - 1, 1))
    chain[:, np.arange(regimes), np.arange(regimes)] = stay
    first = np.full((n, regimes), 1.0 / regimes)
    used = Regimes(prob, np.zeros((n, regimes)), np.ones((n, regimes)), chain.copy(), first.copy(), np.full(n, -np.inf), np.zeros((0, n)))

    history: list[np.ndarray] = []
    on = np.arange(n)
    while len(on) and len(history) < MAX_ROUNDS:
        yo, po = y[on], present[on]
        weight = np.where(po[:, :, None], prob[on], 0.0)
        slope = (weight * (t * yo)[:, :, None]).sum(1) / np.maximum((weight * (t * t)[:, :, None]).sum(1), 1e-12)
        residual = yo[:, :, None] - slope[:, None, :] * t[:, :, None]
        variance = (weight * residual ** 2).sum(1) / np.maximum(weight.sum(1), 1e-12)
        variance = np.maximum(variance, floor[on, None])
        used.slope[on], used.variance[on], used.chain[on], used.first[on] = slope, variance, chain[on], first[on]
        prob[on], moves, value = _expect(yo, po, slope, variance, chain[on], first[on])
        first[on] = _open(prob[on, 0])
        left = moves.sum(2, keepdims=True)
        chain[on] = _open(np.where(left > 0, moves / np.maximum(left, 1e-300), chain[on]))
        latest = history[-1].copy() if history else np.full(n, -np.inf)
        settled = np.abs(value - latest[on]) < TOLERANCE * np.abs(value)
        latest[on] = value
        used.value[on] = value
        history.append(latest)
        on = on[~settled]
    used.prob, used.history = prob, np.array(history)
    return used


def best_regimes(y: np.ndarray, present: np.ndarray, regimes: int = 2) -> Regimes:
    """Many series at once, each with the best likelihood of several starts; the first of equal ones.

    ``y`` and ``present`` are (series, time).
    """
    runs = [_climb(y, present, prob) for prob in _starts(y, present, regimes)]
    values = np.stack([r.value for r in runs])
    best = (values >= values.max(0) - 1e-9 * np.abs(values.max(0))).argmax(0)
    rounds = max(len(r.history) for r in runs)
    rows = np.arange(len(y))

    def pick(arrays: list[np.ndarray]) -> np.ndarray:
        return np.stack(arrays)[best, rows]

    histories = [np.concatenate([r.history, np.repeat(r.history[-1:], rounds - len(r.history), axis=0)]).T for r in runs]
    return Regimes(*(pick([getattr(r, f) for r in runs]) for f in ("prob", "slope", "variance", "chain", "first", "value")),
                   history=pick(histories).T)


def fit_regimes(y: np.ndarray, present: np.ndarray, regimes: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """(smoothed probabilities, log-likelihood per round) of the best start."""
    found = best_regimes(y, present, regimes)
    return found.prob, found.history


def _welch(y: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """p-value of each row: do the means under the two masks differ?"""
    with np.errstate(invalid="ignore", divide="ignore"):
        na, nb = a.sum(1), b.sum(1)
        ma, mb = (np.where(m, y, 0).sum(1) / m.sum(1) for m in (a, b))
        va, vb = ((np.where(m, y - c[:, None], 0) ** 2).sum(1) / (m.sum(1) - 1) / m.sum(1) for m, c in ((a, ma), (b, mb)))
        dof = (va + vb) ** 2 / (va ** 2 / (na - 1) + vb ** 2 / (nb - 1))
        t = (ma - mb) / np.sqrt(va + vb)
    out = np.full(len(y), np.nan)
    ok = (na >= 2) & (nb >= 2) & (va + vb > 0)
    out[ok] = student_p(t[ok], dof[ok])
    return out


def _rank_test(y: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Mann-Whitney of each row by the normal limit with tie and continuity correction.

    Ranks are counts of smaller and equal values, so rows are compared side by side.
    """
    out = np.full(len(y), np.nan)
    ok = np.flatnonzero(a.any(1) & b.any(1))
    step = max(1, PAIRS // max(1, y.shape[1] ** 2))
    for start in range(0, len(ok), step):
        at = ok[start:start + step]
        v, one, two = y[at], a[at], b[at]
        both = one | two
        below = ((v[:, None, :] < v[:, :, None]) & both[:, None, :]).sum(2)
        equal = ((v[:, None, :] == v[:, :, None]) & both[:, None, :]).sum(2)
        rank = below + (equal + 1) / 2
        na, nb = one.sum(1), two.sum(1)
        n = na + nb
        u = np.where(one, rank, 0).sum(1) - na * (na + 1) / 2
        ties = np.where(both, equal.astype(float) ** 2 - 1, 0).sum(1)  # t^3 - t over groups of t equal values
        spread = np.sqrt(na * nb / 12 * ((n + 1) - ties / np.maximum(n * (n - 1), 1)))
        z = np.maximum(np.abs(u - na * nb / 2) - 0.5, 0) / np.where(spread > 0, spread, 1)
        out[at] = np.where(spread > 0, normal_two_sided(z), 1.0)
    return out


def regime_filter(
    df: DataFrame, slope: Sequence[Column], variance: Sequence[Column], stay: Column | float = 0.9,
    first: Column | float = 0.5, values: str = "values",
) -> DataFrame:
    """Log-likelihood of ordered arrays under two regimes whose parameters are given, and how many months the second holds.

    The forward filter as a fold over each array, in log space; nothing is fitted.
    ``stay`` is the chance to stay in a regime, ``first`` that of beginning in the first one.
    Adds ``log_likelihood`` and ``months_second``; an empty array has likelihood 0.
    """
    stay, first = (F.lit(p) if isinstance(p, float) else p for p in (stay, first))

    def bound(value: Column, use: Callable[[Column], Column]) -> Column:
        """``use`` of a value that is computed once."""
        return F.transform(F.array(value), use)[0]

    def both(x: Column, y: Column) -> Column:
        return bound(F.struct(x.alias("x"), y.alias("y"), F.greatest(x, y).alias("top")),
                     lambda v: v["top"] + F.ln(F.exp(v["x"] - v["top"]) + F.exp(v["y"] - v["top"])))

    def moved(state: Column, j: Column) -> Column:
        low, high = j["j0"] - j["total"], j["j1"] - j["total"]
        return F.struct((state["t"] + 1).alias("t"), both(low + F.ln(stay), high + F.ln(1 - stay)).alias("a0"),
                        both(low + F.ln(1 - stay), high + F.ln(stay)).alias("a1"), (state["ll"] + j["total"]).alias("ll"),
                        (state["n"] + (high > low).cast("int")).alias("n"))

    def step(state: Column, x: Column) -> Column:
        joint = [(state[f"a{k}"] - F.lit(0.5) * (F.ln(F.lit(2 * np.pi) * variance[k]) + (x - slope[k] * state["t"]) ** 2 / variance[k])).alias(f"j{k}")
                 for k in (0, 1)]
        return bound(F.struct(*joint), lambda j: bound(
            F.struct(j["j0"].alias("j0"), j["j1"].alias("j1"), both(j["j0"], j["j1"]).alias("total")), lambda v: moved(state, v)))

    begin = F.struct(F.lit(1.0).alias("t"), F.ln(first).alias("a0"), F.ln(1 - first).alias("a1"), F.lit(0.0).alias("ll"), F.lit(0).alias("n"))
    folded = F.aggregate(F.transform(values, lambda v: v.cast("double")), begin, step, lambda s: F.struct(s["ll"].alias("ll"), s["n"].alias("n")))
    return df.withColumn("__f", folded).select(*[F.col(c) for c in df.columns], F.col("__f.ll").alias("log_likelihood"), F.col("__f.n").alias("months_second"))


def regime_test(
    df: DataFrame, test: str = "ttest", alpha: float = 0.05, regimes: int = 2,
    id_col: str = "series_id", time_col: str = "period", value: str = "value", parameters: bool = False,
) -> DataFrame:
    """Regime means, labels, p-value and flag per series (NULL below two values).

    Of several starts the one with the best likelihood is kept. With ``parameters`` the
    slopes, variances, chain (row by row), first shares and log-likelihood are returned too.
    """
    if test not in ("ttest", "mannwhitney"):
        raise ValueError("test must be 'ttest' or 'mannwhitney'")
    arrays = ordered_arrays(df, value, id_col, time_col).select(id_col, F.filter("values", lambda v: v.isNotNull()).alias("values"))
    kind = arrays.schema[id_col].dataType.simpleString()
    compare = _welch if test == "ttest" else _rank_test

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = np.array([len(v) for v in batch["values"]], int)
            out = {c: np.full(len(batch), None, object) for c in ("regime_means", "regimes", "slope", "variance", "chain", "first")}
            p_value, likelihood = np.full(len(batch), np.nan), np.full(len(batch), np.nan)
            usable = np.flatnonzero(sizes >= 2)
            if len(usable):
                width = sizes.max()
                present = np.arange(width)[None, :] < sizes[usable, None]
                y = np.zeros(present.shape)
                y[present] = np.concatenate([np.asarray(v, float) for v in batch["values"].iloc[usable]])
                found = best_regimes(y, present, regimes)
                best = found.prob.argmax(2)
                masks = [present & (best == k) for k in range(regimes)]
                p_value[usable], likelihood[usable] = compare(y, masks[0], masks[1]), found.value
                with np.errstate(invalid="ignore"):
                    means = np.stack([np.where(m, y, 0).sum(1) / m.sum(1) for m in masks], axis=1)
                for row, i in enumerate(usable):
                    out["regime_means"][i] = [None if np.isnan(m) else float(m) for m in means[row]]
                    out["regimes"][i] = best[row, :sizes[i]].astype(np.int32)
                    for name in ("slope", "variance", "chain", "first"):
                        out[name][i] = getattr(found, name)[row].ravel()
            numbers = {name: pd.Series(x, dtype="float64").astype("Float64").mask(np.isnan(x)) for name, x in (("p_value", p_value), ("log_likelihood", likelihood))}
            yield pd.DataFrame({id_col: batch[id_col].to_numpy(), **out, **numbers})[[id_col, *COLUMNS]]

    schema = f"`{id_col}` {kind}, " + ", ".join(f"{c} {k}" for c, k in COLUMNS.items())
    fitted = arrays.mapInPandas(fit, schema)
    extra = ["slope", "variance", "chain", "first", "log_likelihood"] if parameters else []
    return fitted.select(id_col, "regime_means", "p_value", (F.col("p_value") < alpha).alias("anomaly"), "regimes", *extra)
