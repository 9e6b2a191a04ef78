"""The full-depth forest against a plain recursion with the same weights and draws."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterwatch.operators import bagging as G
from meterwatch.operators import classifiers as B
from tests.test_boosting import as_paths, same_tree


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(6)
    n = 300
    a, b, c = rng.integers(0, 9, n), rng.normal(size=n).round(1), rng.choice(["n", "s", "e"], n)
    y = ((a > 5) ^ (rng.random(n) < 0.2)).astype(int)
    rows = [(i, float(a[i]), float(b[i]), str(c[i]), int(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, a double, b double, c string, y int").repartition(3)


def plain_tree(x, y, w, path, bag, numeric):
    """Paths of one tree, a node after the other."""
    out = {}

    def cut(rows, f, c):
        return rows[x[rows, f] > c] if f < numeric else rows[x[rows, f] == c]

    def walk(rows, path, name):
        wy, total = (w * y)[rows].sum(), w[rows].sum()
        best = None
        if 0 < wy < total and total >= 2 * bag.min_rows and (bag.depth is None or len(name) < bag.depth):
            tried = G.tried_features(np.array([path], np.int64), x.shape[1], max(1, int(x.shape[1] ** 0.5)))[0]
            for features in (np.flatnonzero(tried), range(x.shape[1])):
                for f in features:
                    for c in range(x[:, f].max() + 1):
                        high = cut(rows, f, c)
                        hy, hw = (w * y)[high].sum(), w[high].sum()
                        if min(hw, total - hw) >= bag.min_rows:
                            gain = hy ** 2 / max(hw, 1) + (wy - hy) ** 2 / max(total - hw, 1) - wy ** 2 / total
                            if gain > 1e-9 and (best is None or gain > best[0]):
                                best = gain, f, c
                if best:
                    break
        if not best:
            out[name] = wy / total
            return
        _, f, c = best
        out[name] = (int(f), int(c))
        high = cut(rows, f, c)
        one, two = (p[0] for p in G.child_paths(np.array([path], np.int64)))
        walk(np.setdiff1d(rows, high), one, name + "0")
        walk(high, two, name + "1")

    walk(np.flatnonzero(w > 0), path, "")
    return out


@pytest.mark.parametrize("local", [10 ** 6, 60, 0])
@pytest.mark.parametrize("bag", [G.Bagging(trees=3), G.Bagging(trees=2, depth=3, min_rows=4)])
def test_same_trees_as_a_plain_version(spark, table, monkeypatch, bag, local):
    monkeypatch.setattr(G, "LOCAL_ROWS", local)
    monkeypatch.setattr(G, "JOB_NODES", 5)
    model = G.fit_forest(table, bag, ["a", "b"], ["c"], "y", ["id"])
    held = sorted(table.withColumn("h", G.id_number("id")).collect())
    x = np.array([[np.searchsorted(model.bins.cuts[0], r.a), np.searchsorted(model.bins.cuts[1], r.b), model.bins.values[0].index(r.c)] for r in held])
    y, h = np.array([r.y for r in held]), np.array([r.h for r in held])
    for t, tree in enumerate(model.trees):
        want = plain_tree(x, y, G.bag_weights(h, bag.seed, t), G.root_paths(bag.seed, bag.trees)[t], bag, 2)
        found = {k: tuple(int(z) for z in v) if isinstance(v, tuple) else v for k, v in as_paths(tree).items()}
        assert same_tree(found, want)


def test_weights_are_poisson():
    w = G.bag_weights(np.random.default_rng(0).integers(0, G.PRIME, 200_000), 1, 3)
    assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.03 and abs((w == 0).mean() - np.exp(-1)) < 0.01


def test_odd_tables_and_saving(spark, table, tmp_path, monkeypatch):
    fit = lambda df, **k: G.fit_forest(df, G.Bagging(trees=3, **k), ["a", "b"], ["c"], "y", ["id"])
    assert {r.score for r in fit(table.limit(0)).score(table).collect()} == {0.0}
    assert {r.score for r in fit(table.withColumn("y", F.lit(1))).score(table).collect()} == {1.0}
    odd = table.unionByName(spark.createDataFrame([(9_000, float("nan"), None, None, 1), (9_001, 1.0, 2.0, "n", None)], table.schema))
    model = fit(odd)
    scored = {r.id: r.score for r in model.score(odd).collect()}
    assert len(scored) == 302 and all(0 <= s <= 1 for s in scored.values())
    model.save(spark, str(tmp_path / "m"))
    again = B.load_model(spark, "forest", str(tmp_path / "m"))
    assert {r.id: r.score for r in again.score(odd).collect()} == scored
    monkeypatch.setattr(G, "MOST_NODES", 5)
    with pytest.raises(ValueError, match="min_rows"):
        fit(table)


def test_full_depth_fits_what_it_saw(spark, table):
    """With enough trees every row is mostly in trees that saw it, so labels come back; depth follows the data."""
    model = G.fit_forest(table, G.Bagging(trees=40), ["a", "b"], ["c"], "y", ["id"])
    assert B.roc_auc(model.score(table), "y", "score").first()["auc"] > 0.97
    assert max(len(p) for t in model.trees for p in as_paths(t)) > 12


@pytest.mark.parametrize("local", [10 ** 6, 60])
def test_workers_hold_no_whole_forest(spark, table, monkeypatch, local):
    """The driver keeps the tops only; rows that go to the parts of the trees get the scores that the whole trees give."""
    monkeypatch.setattr(G, "LOCAL_ROWS", local)
    monkeypatch.setattr(G, "BLOCK_ROWS", 64)
    monkeypatch.setattr(G, "VISIT_ROWS", 50)
    model = G.fit_forest(table, G.Bagging(trees=5), ["a", "b"], ["c"], "y", ["id"])
    trees = model.trees
    held = sum(len(t.feature) for t in model.tops)
    assert held == 5 if local > 300 else held < sum(len(t.feature) for t in trees) / 2
    rows = sorted(table.collect())
    x = np.array([[np.searchsorted(model.bins.cuts[0], r.a), np.searchsorted(model.bins.cuts[1], r.b), model.bins.values[0].index(r.c)] for r in rows])
    want = sum(np.asarray(t.value)[t.nodes(x, 2)] for t in trees) / 5
    scored = model.score(table)
    assert scored.columns == [*table.columns, "score"]
    assert {r.id: r.score for r in scored.collect()} == dict(zip([r.id for r in rows], want.tolist()))
