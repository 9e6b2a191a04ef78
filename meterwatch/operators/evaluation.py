"""Rankings against field inspections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterwatch.operators.ordering import ordered_prefix

# fixed values: list lengths of the summary and of the evaluated head
SUMMARY_KS = (50, 100, 500, 1000, 2000, 3000, 4000, 5000)
TOP_K = 5000


def _relevant(labels: DataFrame, id_col: str, label: str) -> DataFrame:
    return labels.filter(F.col(label) == 1).select(id_col).distinct().withColumn("__hit", F.lit(1))


def _with_hits(ranked: DataFrame, labels: DataFrame, id_col: str, label: str) -> DataFrame:
    hits = ranked.join(_relevant(labels, id_col, label), id_col, "left")
    return hits.withColumn("hit", F.coalesce("__hit", F.lit(0))).drop("__hit")


def ranked_hits(
    ranking: DataFrame, labels: DataFrame, by: str = "detector", id_col: str = "series_id",
    score: str = "score", label: str = "label",
) -> DataFrame:
    """Every detector's list with rank, hit and hits so far, largest score first."""
    marked = _with_hits(ranking, labels, id_col, label)
    return ordered_prefix(
        marked, [F.col(score).desc_nulls_last(), F.col(id_col).asc()], [by],
        rank="rank", sums={"hits": "hit"})


def count_relevant(labels: DataFrame, id_col: str = "series_id", label: str = "label") -> Column:
    """Number of relevant ids as a scalar subquery."""
    return labels.filter(F.col(label) == 1).agg(F.countDistinct(id_col)).scalar()


def _check(k: int) -> None:
    if k <= 0:
        raise ValueError("k must be a positive integer")


def precision_at_k(hits: DataFrame, k: int, by: str = "detector", id_col: str = "series_id") -> DataFrame:
    """Distinct hits among the first ``k`` over ``k``, even if fewer were listed."""
    _check(k)
    found = F.countDistinct(F.when((F.col("rank") <= k) & (F.col("hit") == 1), F.col(id_col)))
    return hits.groupBy(by).agg((found / F.lit(k)).alias("precision"))


def recall_at_k(hits: DataFrame, k: int, relevant: Column, by: str = "detector", id_col: str = "series_id") -> DataFrame:
    """Distinct hits among the first ``k`` over all relevant ids; 0 if there are none."""
    found = F.countDistinct(F.when((F.col("rank") <= k) & (F.col("hit") == 1), F.col(id_col)))
    counted = hits.groupBy(by).agg(found.alias("__f")).withColumn("__r", relevant)
    return counted.select(by, F.coalesce(F.try_divide(F.col("__f").cast("double"), F.col("__r")), F.lit(0.0)).alias("recall"))


def average_precision(hits: DataFrame, relevant: Column, by: str = "detector") -> DataFrame:
    """Mean over the relevant ids of the precision at their position."""
    gain = F.sum(F.when(F.col("hit") == 1, F.col("hits") / F.col("rank")).otherwise(0.0))
    summed = hits.groupBy(by).agg(gain.alias("__g")).withColumn("__r", relevant)
    return summed.select(by, F.coalesce(F.try_divide(F.col("__g"), F.col("__r")), F.lit(0.0)).alias("ap"))


def pr_curve(hits: DataFrame, relevant: Column, step: int = 1, by: str = "detector") -> DataFrame:
    """Precision and recall at every ``step``-th position."""
    rows = hits.filter(F.col("rank") % step == 0).withColumn("__r", relevant)
    return rows.select(
        by, F.col("rank").alias("k"), (F.col("hits") / F.col("rank")).alias("precision"),
        F.coalesce(F.try_divide(F.col("hits").cast("double"), F.col("__r")), F.lit(0.0)).alias("recall"))


def _summary(hits: DataFrame, relevant: DataFrame | Column, by: str, ks: Sequence[int]) -> DataFrame:
    """P@k and R@k for the given list lengths and for the whole list, and AP.

    ``relevant`` is a count for all detectors, or one row per detector.
    """
    def at(k: Column) -> Column:
        return F.max(F.when(F.col("rank") <= k, F.col("hits")))

    tops = [at(F.lit(k)).alias(f"h{k}") for k in ks]
    gain = F.sum(F.when(F.col("hit") == 1, F.col("hits") / F.col("rank")).otherwise(0.0))
    table = hits.groupBy(by).agg(F.max("rank").alias("__n"), F.max("hits").alias("__all"), gain.alias("__g"), *tops)
    if isinstance(relevant, DataFrame):
        table = table.join(relevant, by)
    else:
        table = table.withColumn("relevant", relevant)
    cells = [F.when(F.col("__n") >= k, F.struct(F.lit(k).cast("long").alias("k"), F.col(f"h{k}").alias("h"))) for k in ks]
    cells.append(F.struct(F.col("__n").alias("k"), F.col("__all").alias("h")))
    long = table.select(by, "relevant", "__g", F.explode(F.array_compact(F.array(*cells))).alias("c"))

    def share(x: Column) -> Column:
        return F.coalesce(F.try_divide(x.cast("double"), F.col("relevant")), F.lit(0.0))

    return long.select(by, F.col("c.k").alias("k"), (F.col("c.h") / F.col("c.k")).alias("precision_at_k"),
                       share(F.col("c.h")).alias("recall_at_k"), share(F.col("__g")).alias("ap"))


def ranking_summary(hits: DataFrame, relevant: Column, by: str = "detector", ks: Sequence[int] = SUMMARY_KS) -> DataFrame:
    return _summary(hits, relevant, by, ks)


def compare_detectors(
    ranking: DataFrame, labels: DataFrame, by: str = "detector", id_col: str = "series_id",
    score: str = "score", label: str = "label", top: int = TOP_K, ks: Sequence[int] = SUMMARY_KS,
) -> DataFrame:
    """All detectors in one pass: inspected clients only, the first ``top`` of
    each list, and relevant means anomalous within that head."""
    inspected = labels.filter(F.col(label).isNotNull()).select(id_col).distinct()
    seen = ranking.join(inspected, id_col, "left_semi")
    # ranked by range partitions: no detector's whole list in one task
    ranked = ordered_prefix(seen, [F.col(score).desc_nulls_last(), F.col(id_col).asc()], [by], rank="rank")
    head = ranked.filter(F.col("rank") <= top)
    marked = _with_hits(head, labels, id_col, label)
    # at most ``top`` rows per detector from here on
    upto = Window.partitionBy(by).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    hits = marked.withColumn("hits", F.sum("hit").over(upto))
    relevant = hits.groupBy(by).agg(F.sum("hit").alias("relevant"))
    return _summary(hits, relevant, by, ks)


def evaluate_detector(ranking: DataFrame, labels: DataFrame, name: str, by: str = "detector", **names) -> DataFrame:
    return compare_detectors(ranking.filter(F.col(by) == name), labels, by, **names)
