"""Supervised scores: features, encoding, split, models, confusion and ROC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwatch.operators.bagging import Bagging, ForestModel, fit_forest
from meterwatch.operators.boosting import BoostedModel, Growth, fit_boosted
from meterwatch.operators.ordering import ordered_prefix
from meterwatch.operators.series import add_index, percent_change

NUMERIC = ("mean", "std", "min", "max", "last", "pct_mean", "pct_std", "trend")
MISSING_CATEGORY = "__missing"
TREES = 100


def supervised_features(
    df: DataFrame, categories: Sequence[str], label: str | None = "label",
    id_col: str = "series_id", time_col: str = "period", value: str = "value",
) -> DataFrame:
    """Static features per id: level, spread, relative change, trend, modes, label.

    Windows and aggregate share one shuffle on the id. The state of a mode is
    bounded by the months of one series; ties go to the lowest value.
    """
    change = percent_change(value, id_col, time_col)
    rows = add_index(df, "__t", id_col, time_col).withColumn("__pct", change)
    t = F.col("__t").cast("double")
    modes = [F.mode(c, True).alias(c) for c in [*categories, *([label] if label else [])]]
    return rows.groupBy(id_col).agg(
        F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.min(value).alias("min"),
        F.max(value).alias("max"), F.max_by(value, time_col).alias("last"),
        F.avg("__pct").alias("pct_mean"), F.stddev_pop("__pct").alias("pct_std"),
        F.coalesce(F.regr_slope(F.col(value), t), F.lit(0.0)).alias("trend"), *modes)


def encoder(numeric: Sequence[str], categories: Sequence[str]) -> list:
    """Index, one-hot and assemble; an unseen category is all zeros.

    The indexer keeps unseen values as a last slot, which the encoder drops.
    """
    index = StringIndexer(inputCols=list(categories), outputCols=[f"{c}__i" for c in categories], handleInvalid="keep")
    onehot = OneHotEncoder(inputCols=[f"{c}__i" for c in categories], outputCols=[f"{c}__v" for c in categories], dropLast=True)
    assemble = VectorAssembler(inputCols=[*numeric, *[f"{c}__v" for c in categories]], outputCol="features",
                               handleInvalid="keep")
    return [index, onehot, assemble]


def prepare(df: DataFrame, numeric: Sequence[str], categories: Sequence[str]) -> DataFrame:
    """No missing values reach the encoder."""
    return df.select("*").fillna(0.0, subset=list(numeric)).fillna(MISSING_CATEGORY, subset=list(categories))


def stratified_split(df: DataFrame, label: str = "label", id_col: str = "series_id", train_share: float = 0.8) -> DataFrame:
    """Column ``train``: the first share of each label in order of the id's hash.

    Exact and repeatable; ranks come from a range partitioning, so two huge
    labels do not mean two huge tasks.
    """
    keyed = df.withColumn("__h", F.md5(F.col(id_col).cast("string")))
    ranked = ordered_prefix(
        keyed.withColumn("__one", F.lit(1)), [F.col("__h").asc(), F.col(id_col).asc()], [label],
        rank="__r", totals={"__n": "__one"})
    # whole-number test: rank / n <= share
    share = round(train_share * 1000)
    return ranked.select(*df.columns, (F.col("__r") * 1000 <= F.col("__n") * share).alias("train"))


def boosting_growth(kind: str, trees: int) -> Growth:
    """Trees of three levels, or of 31 leaves grown best first with at least 20 rows each."""
    if kind == "gbt":
        return Growth(trees=trees, depth=3)
    if kind == "gbt_deep":
        return Growth(trees=trees, leaves=31, min_rows=20)
    raise ValueError(f"unknown model {kind}")


def train(df: DataFrame, kind: str, numeric: Sequence[str] = NUMERIC, categories: Sequence[str] = (),
          label: str = "label", seed: int = 42, trees: int = TREES, max_depth: int | None = None,
          id_col: str = "series_id") -> BoostedModel | ForestModel:
    """Bins and trees fitted on the rows given.

    ``gbt`` and ``gbt_deep`` are boosted trees on histograms; ``forest`` has trees of full
    depth, or of ``max_depth`` levels. The order of the rows, the files they come from and
    the number of partitions do not change the model.
    """
    ids = [id_col] if id_col in df.columns else ()
    if kind == "forest":
        return fit_forest(df, Bagging(trees=trees, depth=max_depth, seed=seed), numeric, categories, label, ids)
    return fit_boosted(df, boosting_growth(kind, trees), numeric, categories, label, ids)


def score(model: BoostedModel | ForestModel, df: DataFrame, out: str = "score") -> DataFrame:
    """Probability of label 1 next to the columns of ``df``."""
    return model.score(df, out)


def load_model(spark: SparkSession, kind: str, path: str) -> BoostedModel | ForestModel:
    return (ForestModel if kind == "forest" else BoostedModel).load(spark, path)


# --- quality of scores ---------------------------------------------------

def _per_score(df: DataFrame, label: str, score_col: str) -> DataFrame:
    """Positives and negatives per distinct score."""
    return df.groupBy(F.col(score_col).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))


def _cumulative(df: DataFrame, label: str, score_col: str) -> DataFrame:
    return ordered_prefix(
        _per_score(df, label, score_col), [F.col("score").desc()], rank="rank",
        sums={"tp": "pos", "fp": "neg"}, totals={"positives": "pos", "negatives": "neg"})


def roc_curve(df: DataFrame, label: str = "label", score_col: str = "score") -> DataFrame:
    """One point per distinct score, from the highest down."""
    rows = _cumulative(df, label, score_col)
    return rows.select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("fp").cast("double"), F.col("negatives")).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), F.col("positives")).alias("tpr"))


def roc_auc(df: DataFrame, label: str = "label", score_col: str = "score") -> DataFrame:
    """Share of (positive, negative) pairs in the right order, ties half."""
    rows = _cumulative(df, label, score_col)
    won = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / F.lit(2.0)))
    return rows.agg(F.try_divide(won, F.max("positives").cast("double") * F.max("negatives")).alias("auc"))


def trapezoid_area(curve: DataFrame, x: str = "fpr", y: str = "tpr", start: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """Area under stored curve points, from ``start``.

    Each point needs its predecessor only: points are placed in order, and the
    predecessor is found by rank.
    """
    placed = ordered_prefix(curve.select(x, y), [F.col(x).asc(), F.col(y).asc()], rank="__r")
    before = placed.select((F.col("__r") + 1).alias("__r"), F.col(x).alias("__x"), F.col(y).alias("__y"))
    pairs = placed.join(before, "__r", "left")
    x0, y0 = F.coalesce("__x", F.lit(start[0])), F.coalesce("__y", F.lit(start[1]))
    return pairs.agg(F.sum((F.col(x) - x0) * (F.col(y) + y0) / 2).alias("area"))


def confusion_matrix(df: DataFrame, label: str = "label", score_col: str = "score", threshold: float = 0.5) -> DataFrame:
    predicted = (F.col(score_col) >= threshold).cast("int").alias("predicted")
    return df.groupBy(F.col(label).alias("label"), predicted).agg(F.count(F.lit(1)).alias("count"))


def classification_report(matrix: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted.

    Works on the confusion counts, so on a handful of rows.
    """
    wide = matrix.agg(*[
        F.coalesce(F.sum(F.when((F.col("label") == a) & (F.col("predicted") == b), F.col("count"))), F.lit(0))
        .cast("double").alias(f"c{a}{b}") for a in (0, 1) for b in (0, 1)])

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    def measures(cls: int) -> Mapping[str, Column]:
        hit, other = F.col(f"c{cls}{cls}"), 1 - cls
        precision = ratio(hit, hit + F.col(f"c{other}{cls}"))
        recall = ratio(hit, hit + F.col(f"c{cls}{other}"))
        return {"precision": precision, "recall": recall,
                "f1": ratio(2 * precision * recall, precision + recall),
                "support": hit + F.col(f"c{cls}{other}")}

    zero, one = measures(0), measures(1)
    total = zero["support"] + one["support"]
    accuracy = ratio(F.col("c00") + F.col("c11"), total)
    names = ("precision", "recall", "f1")

    def row(name: str, values: Sequence[Column], support: Column) -> Column:
        return F.struct(F.lit(name).alias("class"), *[v.alias(n) for n, v in zip(names, values)],
                        support.cast("long").alias("support"))

    rows = F.array(
        row("0", [zero[n] for n in names], zero["support"]),
        row("1", [one[n] for n in names], one["support"]),
        row("accuracy", [accuracy] * 3, total),
        row("macro avg", [(zero[n] + one[n]) / 2 for n in names], total),
        row("weighted avg", [ratio(zero[n] * zero["support"] + one[n] * one["support"], total) for n in names], total),
    )
    return wide.select(F.explode(rows).alias("r")).select("r.*")
