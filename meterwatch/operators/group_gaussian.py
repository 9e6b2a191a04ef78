"""Clients against their social, geographic and time group (2-D Gaussian)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwatch.functions.nulls import all_present
from meterwatch.functions.scalar import fixed, month_key, safe_log
from meterwatch.functions.stats import mahalanobis_2d
from meterwatch.operators.ordering import global_rank
from meterwatch.operators.relational import covariance_2d, latest_present
from meterwatch.operators.series import add_lag

ELLIPSE_POINTS = 200


def group_statistics(df: DataFrame, group: Sequence[str], x: str, y: str, min_size: int) -> DataFrame:
    return covariance_2d(df, group, x, y).filter(F.col("n") >= min_size)


def mahalanobis_scores(
    df: DataFrame, group: Sequence[str], x: str = "prev", y: str = "value",
    min_size: int = 3, null_policy: str = "skip",
) -> DataFrame:
    """Distance and Gaussian density of every row inside its group.

    Group moments are aggregated (map-side first) and joined back, so that a
    huge group is never gathered in one task. ``skip`` works on rows that have
    both values; ``propagate`` leaves the scores of a group NULL if any of its
    rows lacks one, like a mean that does not skip missing values.
    """
    rows = df.filter(all_present(group))
    if null_policy == "skip":
        rows = rows.filter(all_present([x, y]))
        stats = group_statistics(rows, group, x, y, min_size)
    elif null_policy == "propagate":
        whole = rows.groupBy(*group).agg(F.count_if(~all_present([x, y])).alias("__gaps"))
        stats = group_statistics(rows, group, x, y, min_size).join(whole, list(group))
        moments = ["mu_x", "mu_y", "var_x", "cov_xy", "var_y"]
        stats = stats.select(*group, "n", *[F.when(F.col("__gaps") == 0, F.col(m)).alias(m) for m in moments])
    else:
        raise ValueError(f"unknown null_policy {null_policy}")
    distance, density = mahalanobis_2d(
        F.col(x) - F.col("mu_x"), F.col(y) - F.col("mu_y"), F.col("var_x"), F.col("var_y"), F.col("cov_xy"))
    return rows.join(stats, list(group)).select(
        *[F.col(c) for c in df.columns], F.col("n").alias("group_size"),
        density.alias("density"), distance.alias("fraud_score"))


def consumption_features(
    df: DataFrame, lag_rows: int = 4, id_col: str = "series_id", time_col: str = "period", value: str = "value",
) -> DataFrame:
    """Logarithm, lagged value and lagged logarithm, month key."""
    logged = df.withColumn(f"{value}_log", safe_log(F.col(value)))
    lagged = add_lag(logged, [value, f"{value}_log"], lag_rows, id_col, time_col)
    return lagged.withColumn("year_month", month_key(F.col(time_col)))


def gaussian_ranking(
    df: DataFrame, group: Sequence[str], lag_rows: int = 4, min_size: int = 25,
    id_col: str = "series_id", time_col: str = "period", value: str = "value", null_policy: str = "skip",
) -> DataFrame:
    """The whole job: features, group scores, latest per client, rank."""
    features = consumption_features(df, lag_rows, id_col, time_col, value)
    scored = mahalanobis_scores(
        features, [*group, "year_month"], f"{value}_log_prev", f"{value}_log", min_size, null_policy)
    last = latest_present(scored, id_col, time_col, ["fraud_score", "density", "year_month"])
    return global_rank(last, [fixed(F.col("fraud_score")).desc_nulls_last(), F.col(id_col).asc()])


def flag_outliers(scores: DataFrame, score: str = "fraud_score", sigmas: float = 2.0) -> DataFrame:
    return scores.filter(F.col(score) > sigmas)


def group_profiles(
    scores: DataFrame, group: Sequence[str], id_col: str = "series_id", score: str = "fraud_score",
    sigmas: float = 2.0, latest_by: str | None = None,
) -> DataFrame:
    """Every client against its group: size, outliers, own mean distance, text.

    One aggregate per group serves all its clients; groups of one row are left
    out. ``latest_by`` keeps the latest group of each client only.
    """
    sizes = scores.groupBy(*group).agg(
        F.count(F.lit(1)).alias("group_size"), F.count_if(F.col(score) > sigmas).alias("outliers")
    ).filter("group_size >= 2")
    keys = list(dict.fromkeys([*group, *([latest_by] if latest_by else [])]))
    own = scores.groupBy(id_col, *keys).agg(F.avg(score).alias("own_distance"))
    if latest_by:
        last = F.max_by(F.struct(*[F.col(c) for c in [*keys, "own_distance"]]), F.col(latest_by))
        own = own.groupBy(id_col).agg(last.alias("__l")).select(id_col, *[f"__l.{c}" for c in [*group, "own_distance"]])
    text = F.concat_ws(" | ", *[F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in group])
    return own.join(sizes, list(group)).withColumn("description", text)


def client_group_profile(
    scores: DataFrame, client: int, group: Sequence[str], id_col: str = "series_id",
    score: str = "fraud_score", sigmas: float = 2.0, latest_by: str | None = None,
) -> DataFrame:
    """The profile of one client: only the groups it belongs to are counted."""
    own = scores.filter(F.col(id_col) == client).select(*group).distinct()
    near = scores.join(own, list(group), "left_semi")
    return group_profiles(near, group, id_col, score, sigmas, latest_by).filter(F.col(id_col) == client)


def _ellipse(stats: DataFrame, sigmas: float) -> DataFrame:
    vx, vy, cxy = F.col("var_x"), F.col("var_y"), F.col("cov_xy")
    half = (vx + vy) / 2
    gap = F.sqrt((vx - vy) * (vx - vy) / 4 + cxy * cxy)
    return stats.select(
        "*", (F.atan2(F.lit(2.0) * cxy, vx - vy) / 2).alias("angle"),
        (F.lit(sigmas) * F.sqrt(half + gap)).alias("axis_a"),
        (F.lit(sigmas) * F.sqrt(F.greatest(half - gap, F.lit(0.0)))).alias("axis_b"))


def ellipse_points(stats: DataFrame, group: Sequence[str], sigmas: float = 2.0, points: int = ELLIPSE_POINTS) -> DataFrame:
    """Boundary of the ``sigmas`` ellipse of every group (closed-form axes)."""
    shape = _ellipse(stats, sigmas)
    step = shape.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    t: Column = F.col("point") * F.lit(2 * math.pi / (points - 1))
    a, b, angle = F.col("axis_a"), F.col("axis_b"), F.col("angle")
    x = F.col("mu_x") + a * F.cos(t) * F.cos(angle) - b * F.sin(t) * F.sin(angle)
    y = F.col("mu_y") + a * F.cos(t) * F.sin(angle) + b * F.sin(t) * F.cos(angle)
    return step.select(*group, "point", "angle", "axis_a", "axis_b", x.alias("x"), y.alias("y"))
