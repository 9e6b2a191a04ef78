"""Joins, set operations, duplicates and plain aggregates."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwatch.operators.ordering import exact_quantiles

MATCH = "match"


# --- joins ---------------------------------------------------------------

def join_with_indicator(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join with a ``both`` / ``left_only`` column."""
    flagged = right.withColumn("__hit", F.lit(True))
    return left.join(flagged, list(on), "left").withColumn(
        MATCH, F.when(F.col("__hit"), F.lit("both")).otherwise(F.lit("left_only"))).drop("__hit")


def split_by_match(left: DataFrame, right: DataFrame, on: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(joined rows, left rows without a partner)."""
    return left.join(right, list(on), "inner"), left.join(right, list(on), "left_anti")


def keep_ids(df: DataFrame, ids: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(ids.select(*on), list(on), "left_semi")


def drop_ids(df: DataFrame, ids: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(ids.select(*on), list(on), "left_anti")


def enrich(left: DataFrame, right: DataFrame, on: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """Attach attributes; rows lacking a required one go."""
    joined = left.join(right, list(on), "left")
    return joined.dropna(subset=list(required)) if required else joined


def accumulate(results: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """One row per id with the columns of every detector.

    Same keys in every full join, so the partitioning carries over.
    """
    return reduce(lambda a, b: a.join(b, list(on), "full"), results)


# --- sets and duplicates -------------------------------------------------

def union_all(*tables: DataFrame) -> DataFrame:
    """Stack by column name; absent columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def ids_in_any(*tables: DataFrame) -> DataFrame:
    return union_all(*tables).distinct()


def overlap(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    return a.select(*on).distinct().join(b.select(*on), list(on), "left_semi")


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by ``order``, ties by the other columns.

    An aggregate, so that copies of one hot key shrink before the shuffle.
    """
    rest = [c for c in df.columns if c not in key]
    ranked = [*order, *[c for c in rest if c not in order]]
    packed = F.struct(*[F.col(c) for c in rest])
    best = F.min_by(packed, F.struct(*[F.col(c) for c in ranked])).alias("__row")
    return df.groupBy(*key).agg(best).select(*key, "__row.*").select(*df.columns)


def best_reading(df: DataFrame, key: Sequence[str], value: str = "value") -> DataFrame:
    """Per key the reading with the best quality; ties to the larger value.

    Quality counts one for a present value and two for a positive one.
    """
    quality = F.col(value).isNotNull().cast("int") + 2 * F.coalesce(F.col(value) > 0, F.lit(False)).cast("int")
    rest = [c for c in df.columns if c not in key]
    packed = F.struct(*[F.col(c) for c in rest])
    rank = F.struct(quality, *[F.col(c) for c in [value, *[c for c in rest if c != value]]])
    return (df.groupBy(*key).agg(F.max_by(packed, rank).alias("__row"))
            .select(*key, "__row.*").select(*df.columns))


def duplicate_groups(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    return df.groupBy(*(keys or df.columns)).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


# --- aggregates ----------------------------------------------------------

def value_counts(df: DataFrame, column: str, with_null: bool = False) -> DataFrame:
    rows = df if with_null else df.filter(F.col(column).isNotNull())
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def count_entities(df: DataFrame, id_col: str) -> DataFrame:
    return df.agg(F.countDistinct(id_col).alias("entities"))


def mean_and_median(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    means = df.groupBy(*group).agg(F.avg(value).alias("mean"))
    medians = exact_quantiles(df, value, {"median": 0.5}, group)
    return means.join(medians, list(group), "left")


def max_per_id(df: DataFrame, id_col: str, score: str) -> DataFrame:
    return df.groupBy(id_col).agg(F.max(score).alias(score))


def latest_present(df: DataFrame, id_col: str, time_col: str, columns: Iterable[str]) -> DataFrame:
    """Per id and column the latest value that is not NULL (months can differ)."""
    picks = [
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(time_col))).alias(c) for c in columns
    ]
    return df.groupBy(id_col).agg(*picks)


def describe_score(df: DataFrame, score: str) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles in one row."""
    plain = df.agg(
        F.count(score).alias("count"), F.avg(score).alias("mean"), F.stddev_samp(score).alias("std"),
        F.min(score).alias("min"), F.max(score).alias("max"),
    )
    quartiles = exact_quantiles(df, score, {"q25": 0.25, "median": 0.5, "q75": 0.75})
    three = quartiles.select(F.struct("*")).scalar()
    return plain.withColumn("__q", three).select("*", "__q.*").drop("__q")


def most_frequent(df: DataFrame, group: Sequence[str], column: str, weight: Column | None = None) -> DataFrame:
    """Most frequent value per group, smallest on ties, NULL if there is none.

    Counts first: the state per group is one candidate, not a value map.
    """
    n = F.count(column) if weight is None else F.sum(F.when(F.col(column).isNotNull(), weight).otherwise(0))
    counted = df.groupBy(*group, column).agg(n.alias("__n"))
    ties = counted.groupBy(*group, "__n").agg(F.min(column).alias(column))
    return ties.groupBy(*group).agg(
        F.max_by(F.col(column), F.when(F.col(column).isNotNull(), F.col("__n"))).alias(column))


def covariance_2d(df: DataFrame, group: Sequence[str], x: str, y: str) -> DataFrame:
    """Population mean vector and covariance per group."""
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.avg(x).alias("mu_x"), F.avg(y).alias("mu_y"),
        F.var_pop(x).alias("var_x"), F.covar_pop(x, y).alias("cov_xy"), F.var_pop(y).alias("var_y"),
    )


def date_range(df: DataFrame, column: str) -> DataFrame:
    low, high = F.min(column), F.max(column)
    return df.agg(low.alias("first"), high.alias("last")).select(
        "first", "last",
        F.date_format("first", "ddMMyy").alias("first_text"), F.date_format("last", "ddMMyy").alias("last_text"))


def coverage(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    missing = F.col(lat).isNull() | F.col(lon).isNull()
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if(missing).alias("missing"))


def base_rate(labels: DataFrame, id_col: str, label: str) -> DataFrame:
    """Inspected ids, ids ever labelled 1, and their ratio."""
    per_id = labels.groupBy(id_col).agg(F.max(F.col(label)).alias("__top"))
    return per_id.agg(
        F.count(F.lit(1)).alias("inspected"), F.count_if(F.col("__top") == 1).alias("anomalous"),
    ).withColumn("rate", F.try_divide(F.col("anomalous").cast("double"), F.col("inspected")))


def clients_by_category(
    categories: DataFrame, scores: DataFrame, id_col: str, category: str, score: str,
    top: int | None = None, only_id: object | None = None,
) -> DataFrame:
    """Distinct clients per category among the ``top`` scores."""
    best = scores.orderBy(F.desc_nulls_last(score), F.asc(id_col))
    best = best.limit(top) if top else best
    rows = categories.select(id_col, category).join(best.select(id_col), id_col, "left_semi")
    if only_id is not None:
        rows = rows.filter(F.col(id_col) == F.lit(only_id))
    rows = rows.filter(F.col(category).isNotNull() & (F.trim(category) != ""))
    return rows.groupBy(category).agg(F.countDistinct(id_col).alias("clients"))


def rename_by_alias(df: DataFrame, wanted: Mapping[str, Sequence[str]]) -> DataFrame:
    """Select columns by the first candidate name that exists.

    Names are compared stripped and in lower case.
    """
    by_name = {c.strip().lower(): c for c in df.columns}
    picked = []
    for target, candidates in wanted.items():
        found = next((by_name[c.lower()] for c in candidates if c.lower() in by_name), None)
        if found is None:
            raise ValueError(f"none of {list(candidates)} in {df.columns}")
        picked.append(F.col(f"`{found}`").alias(target))
    return df.select(*picked)


def drop_matching(df: DataFrame, part: str) -> DataFrame:
    """Drop the columns whose name contains ``part``."""
    return df.select([F.col(f"`{c}`") for c in df.columns if part not in c])
