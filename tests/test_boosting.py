"""The boosting engine against a plain one that splits a single leaf at a time."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterwatch.operators import boosting as G
from meterwatch.operators import classifiers as B


def plain_fit(x, y, numeric, grow, base):
    """Trees as nested tuples (feature, cut, low, high) or a value; splits by direct sums over rows."""
    score, trees = np.full(len(y), base), []

    def best(rows, g, h):
        found = None
        total = (g[rows].sum(), h[rows].sum(), len(rows))
        part = lambda a, b: float(a) ** 2 / G.GRAIN / max(b + grow.shrink * G.GRAIN, 1.0)
        for f in range(x.shape[1]):
            for cut in range(x[:, f].max() + 1):
                high = rows[x[rows, f] > cut] if f < numeric else rows[x[rows, f] == cut]
                r = (g[high].sum(), h[high].sum(), len(high))
                left = tuple(a - b for a, b in zip(total, r))
                if min(left[2], r[2]) < max(1, grow.min_rows) or min(left[1], r[1]) < grow.min_curvature * G.GRAIN:
                    continue
                gain = part(*left[:2]) + part(*r[:2]) - part(*total[:2])
                if gain > G.LEAST_GAIN and (found is None or gain > found[0]):
                    found = gain, f, cut, np.setdiff1d(rows, high), high
        return found

    for _ in range(grow.trees):
        p = 1 / (1 + np.exp(-score))
        g, h = np.rint((p - y) * G.GRAIN).astype(np.int64), np.rint(p * (1 - p) * G.GRAIN).astype(np.int64)
        leaves = [("", np.arange(len(y)))]
        splits = {"": best(leaves[0][1], g, h)}
        tree = {}
        while len(leaves) < (grow.leaves or 10 ** 9):
            open_ = [(-splits[q][0], len(q), q) for q, _ in leaves if splits[q] and (grow.depth is None or len(q) < grow.depth)]
            if not open_:
                break
            q = min(open_)[2]
            _, f, cut, low, high = splits[q]
            tree[q] = (f, cut)
            leaves = [z for z in leaves if z[0] != q] + [(q + "0", low), (q + "1", high)]
            splits |= {q + "0": best(low, g, h), q + "1": best(high, g, h)}
        for q, rows in leaves:
            value = -grow.rate * g[rows].sum() / max(h[rows].sum() + grow.shrink * G.GRAIN, 1.0)
            score[rows] += value
            tree[q] = float(value)
        trees.append(tree)
    return score, trees


def as_paths(t):
    out = {}

    def walk(node, path):
        if t.feature[node] < 0:
            out[path] = t.value[node]
        else:
            out[path] = (t.feature[node], t.cut[node])
            walk(t.left[node], path + "0")
            walk(t.right[node], path + "1")
    walk(0, "")
    return out


def same_tree(a, b):
    return a.keys() == b.keys() and all(a[k] == b[k] if isinstance(a[k], tuple) else np.isclose(a[k], b[k], atol=1e-12) for k in a)


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    n = 400
    a, b, c = rng.integers(0, 9, n), rng.normal(size=n).round(1), rng.choice(["n", "s", "e"], n)
    logit = 1.2 * (a > 5) - 1.5 * (b > 0.3) * (c == "s") + 0.4 * (c == "e")
    y = (rng.random(n) < 1 / (1 + np.exp(-logit))).astype(int)
    rows = [(i, float(a[i]), float(b[i]), str(c[i]), int(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, a double, b double, c string, y int").repartition(3)


@pytest.mark.parametrize("grow", [G.Growth(trees=3, depth=3), G.Growth(trees=3, leaves=9, min_rows=5), G.Growth(trees=2, leaves=6, depth=3, shrink=1.0)])
@pytest.mark.parametrize("local,task", [(10 ** 6, 10 ** 6), (60, 10 ** 6), (60, 130), (0, 130), (10 ** 6, 130)])
def test_same_trees_as_a_plain_version(table, monkeypatch, grow, local, task):
    """Wherever a node is grown and however many partitions there are, trees are the same."""
    monkeypatch.setattr(G, "LOCAL_ROWS", local)
    monkeypatch.setattr(G, "TASK_ROWS", task)
    monkeypatch.setattr(G, "FLUSH", 2)
    model = G.fit_boosted(table, grow, ["a", "b"], ["c"], "y", ["id"])
    held = sorted(table.collect())
    x = np.array([[np.searchsorted(model.bins.cuts[0], r.a), np.searchsorted(model.bins.cuts[1], r.b), model.bins.values[0].index(r.c)] for r in held])
    y = np.array([r.y for r in held])
    score, trees = plain_fit(x, y, 2, grow, model.base)
    assert len(model.trees) == len(trees) and all(same_tree(as_paths(t), q) for t, q in zip(model.trees, trees))
    got = {r.id: r.score for r in model.score(table).collect()}
    assert np.allclose([got[r.id] for r in held], 1 / (1 + np.exp(-score)))


def test_jobs_follow_the_trees(spark, table):
    """One job a tree while all rows fit in a task, whatever the number of leaves."""
    def jobs(trees, leaves):
        group = f"boost-{trees}-{leaves}"
        spark.sparkContext.setJobGroup(group, group)
        G.fit_boosted(table, G.Growth(trees=trees, leaves=leaves), ["a", "b"], ["c"], "y", ["id"])
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    few, many = jobs(2, 4), jobs(8, 4)
    assert many - few == 6 and jobs(8, 20) == many


def test_quality_on_unseen_rows(spark):
    """Held-out area under the curve is that of a plain version with exact cuts, and near the best there is."""
    rows = spark.range(6_000).select("id", *[((F.pmod(F.xxhash64("id", F.lit(k)), F.lit(100_003))) / 100_003.0).alias(f"x{k}") for k in range(5)])
    p = 1 / (1 + F.exp(-(4 * F.col("x0") - 3 * (F.col("x1") > 0.6).cast("int") * F.col("x2") - 1)))
    rows = rows.withColumn("y", (F.pmod(F.xxhash64("id", F.lit(99)), F.lit(100_003)) / 100_003.0 < p).cast("int")).withColumn("p", p)
    seen, unseen = rows.filter("id % 3 > 0"), rows.filter("id % 3 = 0")
    best = B.roc_auc(unseen, "y", "p").first()["auc"]
    for grow in (G.Growth(trees=60, depth=3), G.Growth(trees=60, leaves=31, min_rows=20)):
        model = G.fit_boosted(seen, grow, [f"x{k}" for k in range(5)], (), "y", ["id"])
        got = B.roc_auc(model.score(unseen), "y", "score").first()["auc"]
        assert got > best - 0.03


def test_odd_tables(spark, table):
    grow = G.Growth(trees=2, depth=2)
    fit = lambda df: G.fit_boosted(df, grow, ["a", "b"], ["c"], "y", ["id"])
    empty, ones = fit(table.limit(0)), fit(table.withColumn("y", F.lit(1)))
    assert {r.score for r in empty.score(table).collect()} == {0.5} and {round(r.score, 9) for r in ones.score(table).collect()} == {1.0}
    constant = fit(table.withColumns({"a": F.lit(1.0), "b": F.lit(None).cast("double"), "c": F.lit(None).cast("string")}))
    share = table.agg(F.avg("y")).first()[0]
    assert np.allclose([r.score for r in constant.score(table).collect()], share)
    odd = table.unionByName(spark.createDataFrame([(9_000, float("nan"), None, None, 1), (9_001, 1.0, 2.0, "n", None)], table.schema))
    model = fit(odd)
    scored = model.score(odd.withColumn("c", F.lit("never seen")))
    assert scored.count() == 402 and scored.filter("score is null or score < 0 or score > 1").isEmpty()


def test_saved_model_scores_alike(spark, table, tmp_path):
    model = G.fit_boosted(table, G.Growth(trees=3, leaves=5), ["a", "b"], ["c"], "y", ["id"])
    model.save(spark, str(tmp_path / "m"))
    again = B.load_model(spark, "gbt_deep", str(tmp_path / "m"))
    rows = lambda m: {r.id: r.score for r in m.score(table).collect()}
    assert rows(again) == rows(model)
    with pytest.raises(ValueError):
        G.Growth()


def test_equal_rows_are_one_cell(spark, table, monkeypatch):
    """Copies under other ids add to the counts of a cell, not to the work of a tree, and trees are those of all rows."""
    monkeypatch.setattr(G, "PACK_ROWS", 70)
    copies = table.join(spark.range(5).withColumnRenamed("id", "k")).withColumn("id", F.col("id") + 1_000 * F.col("k")).drop("k")
    grow = G.Growth(trees=3, leaves=9, min_rows=20)
    model = G.fit_boosted(copies, grow, ["a", "b"], ["c"], "y", ["id"])
    cells = G._cells(copies.select("a", "b", "c", "y"), model.bins, "y")
    assert cells.count() == table.select("a", "b", "c").distinct().count()
    assert cells.agg(F.sum("rows"), F.sum("ones")).first() == copies.agg(F.count("*"), F.sum("y")).first()
    held = sorted(copies.collect())
    x = np.array([[np.searchsorted(model.bins.cuts[0], r.a), np.searchsorted(model.bins.cuts[1], r.b), model.bins.values[0].index(r.c)] for r in held])
    _, trees = plain_fit(x, np.array([r.y for r in held]), 2, grow, model.base)
    assert all(same_tree(as_paths(t), q) for t, q in zip(model.trees, trees))
