"""Clusters of categorical attributes (k-modes) as Spark aggregates.

Equal attribute combinations are merged with a weight first; only the modes
(k rows) and a bounded list of candidates for the start travel to the driver between rounds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwatch.session import persist_table

MAX_ROUNDS = 100
#: Profiles that the start chooses among before it asks for more.
CANDIDATES = 2_000
Mode = tuple[str, ...]


@dataclass
class Clustering:
    modes: list[Mode]
    costs: list[int]  # after every round, never increasing

    @property
    def cost(self) -> int:
        return self.costs[-1]


def distinct_profiles(df: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Attribute combinations with their number of rows and their density.

    Density is the mean share of the values of a combination.
    """
    complete = df.dropna(subset=list(attributes))
    profiles = persist_table(complete.groupBy(*attributes).agg(F.count(F.lit(1)).alias("w")))
    rows = profiles.agg(F.sum("w")).scalar()
    dense = profiles
    for a in attributes:
        counts = profiles.groupBy(a).agg(F.sum("w").alias(f"__f_{a}"))
        dense = dense.join(counts, a)
    total = sum((F.col(f"__f_{a}") for a in attributes), F.lit(0))
    return persist_table(dense.select(
        *attributes, "w", (total / F.lit(float(len(attributes))) / rows).alias("density")))


def mismatches(attributes: Sequence[str], mode: Mode) -> Column:
    return sum(((F.col(a) != F.lit(v)).cast("int") for a, v in zip(attributes, mode)), F.lit(0))


def _table(modes: Sequence[Mode]) -> Column:
    """Modes as data, not code: nothing is compiled anew when they change."""
    return F.array(*[F.array(*[F.lit(v) for v in m]) for m in modes])


def _distance(attributes: Sequence[str], mode: Column) -> Column:
    return sum(((F.col(a).cast("string") != mode[i]).cast("int") for i, a in enumerate(attributes)), F.lit(0))


def initial_modes(profiles: DataFrame, attributes: Sequence[str], k: int) -> list[Mode]:
    """Densest profile first, then the one farthest and densest from those chosen.

    The list for a smaller ``k`` is the head of the list for a larger one. A profile's
    distance from the nearest chosen one can only fall, so its rank is a bound on all later
    ranks: a job brings the ``CANDIDATES`` best profiles, and choices go on among them
    until the best one no longer beats the bound of those that stayed behind. Fewer
    different profiles than ``k`` is an error.
    """
    modes: list[Mode] = []
    held: list[tuple[float, Mode]] = []
    behind: float | None = None  # rank that no other profile exceeds; None: all are held

    def rank(density: float, m: Mode) -> float:
        nearest = min((sum(x != y for x, y in zip(m, c)) for c in modes), default=len(attributes))
        return round(nearest * density, 9)

    while len(modes) < k:
        best = min(((-rank(d, m), m) for d, m in held), default=None)
        if best is None or (behind is not None and -best[0] <= behind):
            near = F.array_min(F.transform(_table(modes), lambda m: _distance(attributes, m))) if modes else F.lit(len(attributes))
            text = F.struct(*[F.col(a).cast("string").alias(a) for a in attributes])
            value = F.round(near * F.col("density"), 9)
            rows = profiles.select(value.alias("r"), "density", text.alias("m")).orderBy(F.desc("r"), "m").limit(CANDIDATES + 1).collect()
            behind = rows[-1]["r"] if len(rows) > CANDIDATES else None
            held = [(r["density"], tuple(r["m"])) for r in rows[:CANDIDATES]]
            best = min(((-rank(d, m), m) for d, m in held), default=None)
        if best is None or best[1] in modes:
            raise ValueError(f"{k} clusters need as many different profiles; there are {len(modes)}")
        modes.append(best[1])
    return modes


def assign(df: DataFrame, attributes: Sequence[str], modes: Sequence[Mode], out: str = "cluster") -> DataFrame:
    """Nearest mode by mismatches, the lower number on ties."""
    options = [F.struct(mismatches(attributes, m).alias("d"), F.lit(n).alias("c")) for n, m in enumerate(modes)]
    nearest = F.array_min(F.array(*options))
    return df.withColumn("__near", nearest).select(
        *[F.col(c) for c in df.columns], F.col("__near.c").alias(out), F.col("__near.d").alias("mismatch"))


def _round(profiles: DataFrame, attributes: Sequence[str], models: dict[int, list[Mode]]) -> dict[int, tuple[int, list[Mode]]]:
    """Per model its cost and the modes of the clusters it makes, in one pass."""
    cells = []
    for k, modes in models.items():
        near = F.array_min(F.transform(_table(modes), lambda m, n: F.struct(_distance(attributes, m).alias("d"), n.alias("c"))))
        cells.append(F.struct(F.lit(k).alias("k"), near.alias("near")))
    assigned = profiles.select(*attributes, "w", F.explode(F.array(*cells)).alias("m")).select(
        F.col("m.k").alias("k"), F.col("m.near.c").alias("cluster"), (F.col("m.near.d") * F.col("w")).alias("loss"), "w",
        F.explode(F.array(*[
            F.struct(F.lit(n).alias("a"), F.col(a).cast("string").alias("v")) for n, a in enumerate(attributes)
        ])).alias("cell"))
    counted = assigned.groupBy("k", "cluster", "cell.a", "cell.v").agg(F.sum("w").alias("n"), F.sum("loss").alias("loss"))
    # most frequent value, smallest on ties
    best = counted.groupBy("k", "cluster", "a").agg(
        F.min(F.struct((-F.col("n")).alias("n"), F.col("v").alias("v"))).alias("b"), F.sum("loss").alias("loss"))
    rows = best.select("k", "cluster", "a", "b.v", "loss").collect()  # k * attributes rows per model
    out = {}
    for k, modes in models.items():
        updated, cost = [list(m) for m in modes], 0
        for r in rows:
            if r["k"] == k:
                updated[r["cluster"]][r["a"]] = r["v"]
                cost += r["loss"] if r["a"] == 0 else 0
        out[k] = (int(cost), [tuple(m) for m in updated])
    return out


def fit(profiles: DataFrame, attributes: Sequence[str], ks: Sequence[int], start: Sequence[Mode] | None = None,
        max_rounds: int = MAX_ROUNDS) -> dict[int, Clustering]:
    """One clustering per ``k``; every round is one job for all of them."""
    start = initial_modes(profiles, attributes, max(ks)) if start is None else list(start)
    models = {k: Clustering(start[:k], []) for k in ks}
    active = list(ks)
    for _ in range(max_rounds):
        results = _round(profiles, attributes, {k: models[k].modes for k in active})
        for k, (cost, updated) in results.items():
            model = models[k]
            model.costs.append(cost)
            if updated == model.modes or (len(model.costs) > 1 and cost >= model.costs[-2]):
                active.remove(k)
            else:
                model.modes = updated
        if not active:
            break
    return models


def kmodes(df: DataFrame, attributes: Sequence[str], k: int = 10, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """``df`` (complete rows) with its cluster and mismatches."""
    model = fit(distinct_profiles(df, attributes), attributes, [k], max_rounds=max_rounds)[k]
    return assign(df.dropna(subset=list(attributes)), attributes, model.modes)


def elbow(df: DataFrame, attributes: Sequence[str], ks: Sequence[int] = tuple(range(5, 21)),
          max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """Cost for every ``k``; the start is searched once, for the largest."""
    models = fit(distinct_profiles(df, attributes), attributes, list(ks), max_rounds=max_rounds)
    rows = [(int(k), m.cost) for k, m in models.items()]
    return df.sparkSession.createDataFrame(rows, "k int, cost long")
