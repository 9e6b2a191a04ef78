"""Segments, and what a visiting threshold earns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwatch.operators.ordering import arg_best, exact_quantiles

# fixed values: price of a kWh, cost of a visit, yearly rate, thresholds in percent
PRICE_KWH = 850.0
VISIT_COST = 50_000.0
YEARLY_RATE = 0.15
THRESHOLD_PERCENTS = tuple(range(10, 91, 5))


def horizon_months(yearly_rate: float = YEARLY_RATE) -> float:
    """Months that a recovered kWh keeps paying, discounted."""
    return 1.0 / ((1.0 + yearly_rate) ** (1.0 / 12.0) - 1.0)


def cluster_profile(df: DataFrame, cluster: str = "cluster", label: str = "label", value: str = "value") -> DataFrame:
    """Size, label counts and shares, mean by label, difference of medians
    (normal minus anomalous)."""
    anomalous, normal = F.col(label) == 1, F.col(label) == 0
    plain = df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(anomalous).alias("anomalous"), F.count_if(normal).alias("normal"),
        F.avg(F.when(anomalous, F.col(value))).alias("mean_anomalous"),
        F.avg(F.when(normal, F.col(value))).alias("mean_normal"))
    halves = exact_quantiles(df.filter(anomalous | normal), value, {"median": 0.5}, [cluster, label])
    medians = halves.groupBy(cluster).agg(
        F.max(F.when(normal, F.col("median"))).alias("__normal"),
        F.max(F.when(anomalous, F.col("median"))).alias("__anomalous"))
    return plain.join(medians, cluster, "left").select(
        cluster, "total", "anomalous", "normal",
        (F.col("anomalous") / F.col("total")).alias("share_anomalous"),
        (F.col("normal") / F.col("total")).alias("share_normal"),
        "mean_anomalous", "mean_normal",
        (F.col("__normal") - F.col("__anomalous")).alias("difference"))


def beneficial_clusters(profile: DataFrame) -> DataFrame:
    return profile.filter(F.col("difference") > 0)


def threshold_sweep(
    scored: DataFrame, profile: DataFrame, cluster: str = "cluster", label: str = "label", score: str = "score",
    percents: Sequence[int] = THRESHOLD_PERCENTS, price: float = PRICE_KWH, visit_cost: float = VISIT_COST,
    horizon: float | None = None,
) -> DataFrame:
    """Money and quality for every threshold, over the beneficial clusters.

    Counts for all thresholds come from one aggregate by cluster; thresholds
    are whole percents, so that a score on the border falls on the same side
    everywhere.
    """
    horizon = horizon_months() if horizon is None else horizon
    good = beneficial_clusters(profile).select(cluster, "difference")
    rows = scored.join(good, cluster)
    above = {p: F.col(score) > F.lit(p) / F.lit(100.0) for p in percents}
    counts = rows.groupBy(cluster).agg(
        F.max("difference").alias("difference"), F.count_if(F.col(label) == 1).alias("__p"),
        *[F.count_if(above[p] & (F.col(label) == 1)).alias(f"tp{p}") for p in percents],
        *[F.count_if(above[p] & (F.col(label) == 0)).alias(f"fp{p}") for p in percents])
    cells = F.array(*[
        F.struct(F.lit(p).alias("percent"), F.col(f"tp{p}").alias("tp"), F.col(f"fp{p}").alias("fp")) for p in percents])
    per = counts.select("difference", "__p", F.explode(cells).alias("c")).select("difference", "__p", "c.*")
    sums = per.groupBy("percent").agg(
        F.sum(F.col("tp") * F.col("difference")).alias("__kwh"), F.sum("tp").alias("tp"),
        F.sum("fp").alias("fp"), F.sum("__p").alias("__p"))
    visits = F.col("tp") + F.col("fp")
    gross = F.col("__kwh") * F.lit(horizon) * F.lit(price)
    cost = visits * F.lit(visit_cost)
    precision = F.coalesce(F.try_divide(F.col("tp").cast("double"), visits), F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("__p")), F.lit(0.0))
    table = sums.select(
        (F.col("percent") / F.lit(100.0)).alias("threshold"), gross.alias("benefit"), cost.alias("cost"),
        (gross - cost).alias("net_benefit"), precision.alias("precision"), recall.alias("recall"), visits.alias("visits"))
    f1 = F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return table.withColumn("f1", F.coalesce(f1, F.lit(0.0)))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """Threshold of the largest net benefit, the lower one on ties."""
    return arg_best(sweep, [F.round("net_benefit", 0).desc(), F.col("threshold").asc()]).select(
        "threshold", "net_benefit", "visits")
