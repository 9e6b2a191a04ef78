"""Isolation forest inside each group, spread over the cluster.

Samples are drawn in Spark by hash order, trees are grown in blocks from at
most ``PSI`` rows each with draws that are digests of seed, tree and node, and rows are scored in chunks that meet a copy
of their group's trees; so neither a huge group nor many groups gather in one
place.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterwatch.functions.nulls import all_present, finite_or
from meterwatch.functions.scalar import fixed
from meterwatch.operators.ordering import exact_quantiles, global_rank
from meterwatch.operators.series import minmax_in_group, standardise_in_group
from meterwatch.session import persist_table, spread

TREES = 100
PSI = 256
CHUNK_ROWS = 20_000
SCORE_ROWS = 2_000  # rows in memory times trees
TREES_PER_BLOCK = 25
WHOLE_GROUP = -1  # block and tree number of groups that need no draw
# room above PSI in the pre-draw: eight standard deviations of its size
DRAW = PSI + 8 * int(math.sqrt(2 * PSI))
EULER = 0.5772156649015329
#: Numbers of ids and their places in a draw are below this prime.
PRIME = 2 ** 31 - 1


def expected_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    n = np.asarray(n, float)
    body = 2.0 * (np.log(np.maximum(n - 1, 1)) + EULER) - 2.0 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, body, np.where(n == 2, 1.0, 0.0))


@lru_cache(maxsize=4 * TREES)
def node_draws(seed: int, tree: int, depth: int) -> np.ndarray:
    """(inner nodes, 2) numbers in [0, 1) that choose feature and cut: the digest of seed, tree and node."""
    digests = [hashlib.md5(f"{seed}:{tree}:{node}".encode()).digest() for node in range(2 ** depth - 1)]
    return np.frombuffer(b"".join(d[:8] for d in digests), ">u4").reshape(-1, 2) / 2.0 ** 32


def tree_scrambles(seed: int, trees: int) -> list[tuple[int, int]]:
    """For each tree a multiplier and a summand that turn the number of an id into its place in the tree's draw."""
    out = []
    for tree in range(trees):
        digest = hashlib.md5(f"{seed}:tree:{tree}".encode()).digest()
        one, two = int.from_bytes(digest[:4], "big"), int.from_bytes(digest[4:8], "big")
        out.append((1 + one % (PRIME - 1), two % PRIME))
    return out


def grow_trees(x: np.ndarray, tree: np.ndarray, draws: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(feature, cut) of many trees, grown side by side level by level.

    ``tree`` says which tree each sample row belongs to, ``draws`` (trees, inner nodes, 2)
    what chooses feature and cut: of the features that vary in a node, the one at the
    first draw's share of them, and the cut at the second draw's share of its range.
    So a tree follows from its rows, and any other program can grow the same. Nodes lie in heap
    order, so the children of ``i`` are ``2i + 1`` and ``2i + 2``. A leaf has
    feature -1 and its depth plus the expected rest as cut; single or equal
    rows end early.
    """
    nodes, trees = 2 ** (depth + 1) - 1, len(draws)
    feature = np.full((trees, nodes), -1, np.int32)
    cut = np.zeros((trees, nodes))
    node = np.zeros(len(x), int)
    for level in range(depth + 1):
        if not len(x):
            break
        order = np.lexsort((node, tree))
        x, tree, node = x[order], tree[order], node[order]
        place = tree * nodes + node
        start = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        size = np.diff(np.r_[start, len(x)])
        low, high = np.minimum.reduceat(x, start), np.maximum.reduceat(x, start)
        varying = high > low
        inner = varying.any(1) & (level < depth)
        rows = np.arange(len(start))
        drawn = draws[tree[start], np.minimum(node[start], draws.shape[1] - 1)]
        place = np.floor(drawn[:, 0] * varying.sum(1))
        chosen = (np.cumsum(varying, axis=1) > place[:, None]).argmax(1)
        bottom, top = low[rows, chosen], high[rows, chosen]
        at = bottom + drawn[:, 1] * (top - bottom)
        at = np.where(at >= top, bottom, at)  # rounding, where the two are neighbours
        feature[tree[start], node[start]] = np.where(inner, chosen, -1)
        cut[tree[start], node[start]] = np.where(inner, at, level + expected_path(size))
        of = np.repeat(rows, size)
        keep = inner[of]
        right = x[np.arange(len(x)), chosen[of]] > at[of]
        x, tree, node = x[keep], tree[keep], (2 * node + 1 + right)[keep]
    return feature, cut


def path_lengths(x: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Path length of every row in every tree, (rows, trees)."""
    node = np.zeros((len(x), len(feature)), int)
    rows, which = np.arange(len(x))[:, None], np.arange(len(feature))[None, :]
    while True:
        f = feature[which, node]
        inner = f >= 0
        if not inner.any():
            return cut[which, node]
        right = x[rows, np.maximum(f, 0)] > cut[which, node]
        node = np.where(inner, 2 * node + 1 + right, node)


def isolation_forest(
    df: DataFrame, features: Sequence[str], group: Sequence[str], id_col: str = "series_id",
    min_size: int = 30, contamination: float = 0.05, only_anomalies: bool = False,
    trees: int = TREES, seed: int = 42, require_group: bool = False,
) -> DataFrame:
    """Score, scaled score (1 = most anomalous) and flag within each group.

    ``anomaly_score`` is low for anomalies: the forest score minus its
    ``contamination`` quantile in the group. ``require_group`` raises if no
    group reaches ``min_size``.
    """
    names = list(features)
    clean = df.filter(all_present(group)).select(
        id_col, *group, *[finite_or(F.col(c).cast("double")).alias(c) for c in names])
    sizes = clean.groupBy(*group).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= min_size)
    scaled = standardise_in_group(clean.join(sizes, list(group)), group, names, "__z")
    rows = persist_table(scaled.select(
        id_col, *group, "__n", F.array(*[f"{c}__z" for c in names]).alias("x")))
    if require_group and rows.isEmpty():
        raise ValueError(f"no group has {min_size} rows")

    # a group of at most PSI rows is the sample of all its trees; in a larger one a row enters
    # a tree if its hash falls under the group's rate, then exactly PSI rows by hash order
    group_key = list(group)
    small = rows.filter(F.col("__n") <= PSI).select(
        *group_key, F.lit(WHOLE_GROUP).alias("tree"), F.col(id_col).alias("__id"), "x")
    large = rows.filter(F.col("__n") > PSI)
    rate = F.least(F.lit(1.0), F.lit(float(DRAW)) / F.col("__n"))
    number = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"))), 1, 8), 16, 10).cast("bigint") % PRIME
    scrambles = F.array(*[F.struct(F.lit(t).alias("tree"), F.lit(m).cast("bigint").alias("m"), F.lit(c).cast("bigint").alias("c"))
                          for t, (m, c) in enumerate(tree_scrambles(seed, trees))])
    places = F.transform(scrambles, lambda t: F.struct(t["tree"].alias("tree"), ((F.col("__a") * t["m"] + t["c"]) % PRIME).alias("place")))
    hit = F.filter(places, lambda t: t["place"].cast("double") / PRIME < rate)
    order = Window.partitionBy(*group_key, "tree").orderBy("place", "__id")
    drawn = (large.withColumn("__a", number).select(*group_key, F.col(id_col).alias("__id"), "x", F.explode(hit).alias("__t"))
             .select(*group_key, "__id", "x", "__t.*").withColumn("__r", F.row_number().over(order))
             .filter(F.col("__r") <= PSI).select(*group_key, "tree", "__id", "x"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    key_schema = ", ".join(f"`{g}` {kinds[g]}" for g in group_key)

    def grow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["tree", "__id"])
        x, block = np.stack(pdf["x"].to_numpy()), int(key[-1])
        if block == WHOLE_GROUP:
            names_of, which = np.arange(trees), np.repeat(np.arange(trees), len(x))
            psi, x = len(x), np.tile(x, (trees, 1))
        else:
            names_of, which = np.unique(pdf["tree"].to_numpy(), return_inverse=True)
            psi = int(np.bincount(which).max())
        depth = math.ceil(math.log2(max(psi, 2)))
        feature, cut = grow_trees(x, which, np.stack([node_draws(seed, int(t), depth) for t in names_of]), depth)
        out = pd.DataFrame({"tree": names_of, "psi": psi, "feature": list(feature), "cut": list(cut)})
        for name, value in zip(group_key, key):
            out[name] = value
        return out

    # growing is Python work on little data: keep every core busy
    block = F.floor(F.col("tree") / TREES_PER_BLOCK).cast("int")  # WHOLE_GROUP stays -1
    blocks = spread(small.unionByName(drawn).withColumn("__block", block), *group_key, "__block")
    forest = persist_table(blocks.groupBy(*group_key, "__block").applyInPandas(
        grow, f"{key_schema}, tree int, psi int, feature array<int>, cut array<double>"))

    # score: chunks of a group meet one copy of its trees each
    chunks = F.greatest(F.ceil(F.col("__n") / CHUNK_ROWS), F.lit(1)).cast("int")
    rows_in_chunks = rows.withColumn(
        "__chunk", F.pmod(F.xxhash64(F.col(id_col), F.lit(seed + 1)), chunks).cast("int"))
    copies = (sizes.select(*group_key, F.explode(F.sequence(F.lit(0), chunks - 1)).alias("__chunk"))
              .join(forest, group_key))

    def score(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty:
            return pd.DataFrame({c: [] for c in [id_col, *group_key, "raw"]})
        right = right.sort_values("tree")  # fixed order of the float sums
        feature, cut = np.stack(right["feature"].to_numpy()), np.stack(right["cut"].to_numpy())
        x = np.stack(left["x"].to_numpy())
        mean = np.concatenate([
            path_lengths(x[i:i + SCORE_ROWS], feature, cut).mean(1) for i in range(0, len(x), SCORE_ROWS)])
        left = left[[id_col, *group_key]].copy()
        left["raw"] = -np.power(2.0, -mean / max(float(expected_path(right["psi"].iloc[0])), 1e-9))
        return left

    keys = [*group_key, "__chunk"]
    raw = persist_table(
        rows_in_chunks.select(id_col, *group_key, "__chunk", "x").transform(spread, *keys).groupBy(*keys)
        .cogroup(copies.transform(spread, *keys).groupBy(*keys))
        .applyInPandas(score, f"`{id_col}` {kinds[id_col]}, {key_schema}, raw double"))

    cuts = exact_quantiles(raw, "raw", {"__cut": contamination}, group_key)
    scored = raw.join(cuts, group_key).select(
        id_col, *group_key, (F.col("raw") - F.col("__cut")).alias("anomaly_score"))
    scored = minmax_in_group(scored, group_key, "anomaly_score", "anomaly_score_scaled", negate=True)
    scored = scored.withColumn("anomaly_bin", (F.col("anomaly_score") < 0).cast("int"))
    return scored.filter("anomaly_bin = 1") if only_anomalies else scored


def forest_ranking(scores: DataFrame, id_col: str = "series_id") -> DataFrame:
    """Most anomalous first."""
    return global_rank(scores, [fixed(F.col("anomaly_score_scaled")).desc_nulls_last(), F.col(id_col).asc()])
