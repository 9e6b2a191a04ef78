"""Invariants of the fitted detectors and models."""

import datetime as dt
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from meterwatch.functions.stats import student_p, student_p_integer
from meterwatch.operators import classifiers as B
from meterwatch.operators import forecast as T
from meterwatch.operators import forest as I
from meterwatch.operators import kmodes as KM
from meterwatch.operators import regimes as M
from meterwatch.operators import series_features as X
from meterwatch.plans.catalog import ORACLES, QUERIES
from meterwatch.plans.views import Views
from tests.compare import differences
from tests.conftest import SF_DIR

SERIES = "series_id long, period date, value double"


def month(n):
    return dt.date(2020 + n // 12, n % 12 + 1, 1)


def frame(spark, series):
    return spark.createDataFrame([(i, month(m), float(v)) for i, vs in series.items() for m, v in enumerate(vs)], SERIES)


def plain_holt(train, test_len):
    best = None
    for a in range(1, 10):
        for b in range(1, 10):
            alpha, beta = a / 10, b / 10
            level, trend, sse = train[0], train[1] - train[0], 0.0
            for y in train[1:]:
                e = y - (level + trend)
                level, trend, sse = level + trend + alpha * e, trend + alpha * beta * e, sse + e * e
            if best is None or sse < best[0]:
                best = (sse, [level + h * trend for h in range(1, test_len + 1)])
    return best[1]


def test_smoothing_equals_a_plain_loop(spark):
    rng = np.random.default_rng(0)
    series = {i: rng.gamma(4, 25, 19) for i in range(20)}
    got = {r.series_id: r.mae_ets for r in T.ets_check(frame(spark, series), 15, 4).collect()}
    for i, y in series.items():
        assert got[i] == pytest.approx(np.abs(y[15:] - plain_holt(list(y[:15]), 4)).mean())


def test_gate_and_season(spark):
    t = np.arange(28)
    wave = 100 + 40 * np.sin(2 * np.pi * t / 12)
    broken = np.r_[wave[:24], [900.0] * 4]
    df = frame(spark, {1: wave, 2: broken, 3: [5.0] * 28, 4: wave[:20]})
    got = {r.series_id: r for r in T.ets_check(df).collect()}
    assert got[1].anomaly_ets is False and got[1].mae_ets < 5
    assert got[2].anomaly_ets is True
    for i in (3, 4):
        assert got[i].enough_data is False and got[i].anomaly_ets is None and got[i].reason == T.SHORT_OR_FLAT
    waves = {r.series_id: r for r in T.fourier_check(df).collect()}
    assert waves[1].anomaly_fourier is False and waves[2].anomaly_fourier is True and waves[3].anomaly_fourier is None
    ar = {r.series_id: r for r in T.ar_check(df).collect()}
    assert ar[2].anomaly_ar is True and ar[4].anomaly_ar is None


def plain_orders(y, test_len, orders):
    """One series and one order after the other, with numpy's least squares."""
    long, deepest = (2 if any(q for _, _, q in orders) else 0), max(max(p, q) for p, _, q in orders)
    rows = len(y) - max(d for _, d, _ in orders) - long - deepest
    best = None
    for p, d, q in orders:
        z = np.diff(y, d)
        e = np.zeros(len(z))
        if q:
            x = np.array([[1, z[t - 1], z[t - 2]] for t in range(2, len(z))])
            e[2:] = z[2:] - x @ np.linalg.lstsq(x, z[2:], rcond=None)[0]
        at = range(len(z) - rows, len(z))
        x = np.array([[1, *[z[t - k] for k in range(1, p + 1)], *[e[t - k] for k in range(1, q + 1)]] for t in at])
        w = np.linalg.lstsq(x, z[-rows:], rcond=None)[0]
        left = z[-rows:] - x @ w
        k = p + q + 2
        score = round(rows * np.log(max((left ** 2).sum(), 1e-9) / rows) + 2 * k + 2 * k * (k + 1) / (rows - k - 1), 6)
        if p and (np.abs(np.roots([1, *-w[1:1 + p]])) >= 1).any():
            continue
        past, shock, path = list(z), [0.0] * (len(z) - rows) + list(left), []
        for _ in range(test_len):
            path.append(w[0] + sum(w[1 + k] * past[-1 - k] for k in range(p)) + sum(w[1 + p + k] * shock[-1 - k] for k in range(q)))
            past.append(path[-1])
            shock.append(0.0)
        if best is None or score < best[0]:
            best = score, (p, d, q), (y[-1] + np.cumsum(path) if d else np.array(path))
    return best[1:]


def test_order_search_equals_a_plain_one(spark):
    rng = np.random.default_rng(18)
    series = {}
    for i in range(30):
        e = rng.normal(0, 5, 30)
        z = np.zeros(30)
        for t in range(2, 30):
            z[t] = (0.7 if i % 3 == 0 else 0) * z[t - 1] + e[t] + (0.8 if i % 3 == 1 else 0) * e[t - 1]
        series[i] = 100 + (np.cumsum(z) if i % 2 else z)
    df = frame(spark, series)
    for orders in (T.ORDERS, ((0, 0, 0), (1, 1, 0), (2, 0, 0))):
        got = {r.series_id: r for r in T.arima_check(df, 24, 4, orders=orders).collect()}
        for i, y in series.items():
            order, ahead = plain_orders(y[:24], 4, orders)
            assert got[i].model == str(order).replace(" ", "")
            assert got[i].mae_ar == pytest.approx(np.abs(y[24:28] - ahead).mean(), rel=1e-4)
    assert len({r.model for r in T.arima_check(df, 24, 4).collect()}) > 2
    short = T.arima_check(frame(spark, {1: [5.0] * 28, 2: [1.0, 2.0]}), 24, 4).collect()
    assert all(r.model is None and r.mae_ar is None and r.anomaly_ar is None and r.reason_ar == T.SHORT_OR_FLAT for r in short)
    with pytest.raises(ValueError):
        T.arima_check(df, orders=((3, 0, 0),))


def test_trend_bends(spark):
    """A series with a kink is followed where a straight line is not; few bends stay."""
    t = np.arange(28)
    kink = np.where(t < 12, 100.0 + 0 * t, 100 + 8.0 * (t - 12)) + 3 * np.sin(2 * np.pi * t / 12)
    df = frame(spark, {1: kink, 2: 50 + 2.0 * t})
    straight = {r.series_id: r.mae_fourier for r in T.fourier_check(df).collect()}
    bent = {r.series_id: r.mae_fourier for r in T.fourier_check(df, knots=6, rounds=T.BEND_ROUNDS).collect()}
    assert bent[1] < 0.35 * straight[1] and bent[2] < straight[2] + 2
    voted = T.confirmed_anomalies(df, 24, 4, 0.0001, 0.6, search=True, knots=6)
    assert {r.series_id for r in voted.collect()} <= {1, 2} and "model" in voted.columns


def test_votes_ignore_null(spark):
    df = spark.createDataFrame([(True, None, True), (True, None, False), (None, None, None)],
                               "anomaly_ets boolean, anomaly_ar boolean, anomaly_fourier boolean")
    assert [(r.votes, r.anomaly_final) for r in T.consensus(df).collect()] == [(2, True), (1, False), (0, False)]


def test_regimes_find_the_switch(spark):
    rng = np.random.default_rng(3)
    t = np.arange(1, 61)
    calm = rng.normal(2.0 * t, 1.0)
    switched = np.where(t <= 30, 2.0 * t, 0.5 * t) + rng.normal(0, 0.5, 60)
    df = frame(spark, {1: switched, 2: calm, 3: [4.0]})
    got = {r.series_id: r for r in M.regime_test(df).collect()}
    labels = np.array(got[1].regimes)
    assert len(labels) == 60
    same = max((labels[30:] == labels[-1]).mean(), 0)
    assert same > 0.9 and (labels[10:28] != labels[-1]).mean() > 0.9
    assert got[3].p_value is None and got[3].regimes is None and got[3].anomaly is None
    ranked = {r.series_id: r for r in M.regime_test(df, test="mannwhitney").collect()}
    assert 0 <= ranked[1].p_value <= 1
    with pytest.raises(ValueError):
        M.regime_test(df, test="other")


def test_likelihood_never_falls():
    rng = np.random.default_rng(5)
    y = rng.gamma(3, 20, (6, 40))
    present = np.ones_like(y, bool)
    present[2, 30:] = False
    prob, history = M.fit_regimes(y, present)
    assert prob.shape == (6, 40, 2) and np.allclose(prob.sum(2), 1)
    assert (np.diff(history, axis=0) > -1e-6).all()


def test_best_start_and_its_likelihood(spark):
    """The best of several starts is kept, and the filter over its parameters gives its likelihood again."""
    rng = np.random.default_rng(15)
    t = np.arange(1, 41)
    series = {1: np.where(t <= 20, 2.0 * t, 0.5 * t) + rng.normal(0, 1, 40), 2: rng.gamma(3, 20, 40), 3: rng.normal(100, 1, 30), 4: [5.0, 7.0]}
    y, present = np.zeros((4, 40)), np.zeros((4, 40), bool)
    for row, v in enumerate(series.values()):
        y[row, :len(v)], present[row, :len(v)] = v, True
    best = M.best_regimes(y, present)
    singles = np.stack([M._climb(y, present, p).value for p in M._starts(y, present, 2)])
    assert len(singles) == 3 and np.allclose(best.value, singles.max(0))
    df = frame(spark, series)
    fitted = M.regime_test(df, parameters=True)
    got = {r.series_id: r.log_likelihood for r in fitted.collect()}
    assert [got[k] for k in series] == pytest.approx(best.value.tolist(), rel=1e-6)
    # parameters in which both regimes are left with the same chance can be filtered as they are
    arrays = spark.createDataFrame([(int(k), [float(x) for x in v]) for k, v in series.items()], "series_id long, values array<double>")
    rows = arrays.join(fitted, "series_id").select("series_id", "values", "slope", "variance", F.lit(0.8).alias("stay"), F.lit(0.3).alias("begin"))
    found = M.regime_filter(rows, [F.col("slope")[0], F.col("slope")[1]], [F.col("variance")[0], F.col("variance")[1]], F.col("stay"), F.col("begin"))
    chain, first = np.tile([[0.8, 0.2], [0.2, 0.8]], (4, 1, 1)), np.tile([0.3, 0.7], (4, 1))
    want = M._expect(y, present, best.slope, best.variance, chain, first)[2]
    assert [r.log_likelihood for r in found.orderBy("series_id").collect()] == pytest.approx(want.tolist(), rel=1e-6)


def test_tests_of_many_rows_equal_plain_ones():
    rng = np.random.default_rng(16)
    y = rng.integers(0, 9, (40, 17)).astype(float)
    y[0], y[1, :9] = 4.0, 2.0
    label, present = rng.integers(0, 2, y.shape), rng.random(y.shape) < 0.9
    label[2] = 0
    a, b = present & (label == 0), present & (label == 1)
    welch, ranks = M._welch(y, a, b), M._rank_test(y, a, b)
    for k in range(len(y)):
        p, q = y[k][a[k]], y[k][b[k]]
        if len(p) < 2 or len(q) < 2 or p.var() + q.var() == 0:
            assert np.isnan(welch[k])
        else:
            va, vb = p.var(ddof=1) / len(p), q.var(ddof=1) / len(q)
            dof = (va + vb) ** 2 / (va ** 2 / (len(p) - 1) + vb ** 2 / (len(q) - 1))
            assert welch[k] == pytest.approx(student_p(np.array([(p.mean() - q.mean()) / np.sqrt(va + vb)]), np.array([dof]))[0])
        if not len(p) or not len(q):
            assert np.isnan(ranks[k])
            continue
        u = sum((x > z) + 0.5 * (x == z) for x in p for z in q)
        n, counts = len(p) + len(q), np.unique(np.r_[p, q], return_counts=True)[1].astype(float)
        spread = np.sqrt(len(p) * len(q) / 12 * (n + 1 - (counts ** 3 - counts).sum() / (n * (n - 1))))
        z = max(abs(u - len(p) * len(q) / 2) - 0.5, 0) / spread if spread else 0
        assert ranks[k] == pytest.approx(math.erfc(z / math.sqrt(2)) if spread else 1.0, abs=2e-6)


def test_student_tails(spark):
    assert student_p(np.array([2.228, 12.706, 0.0]), np.array([10.0, 1.0, 5.5])) == pytest.approx([0.05, 0.05, 1.0], abs=2e-4)
    df = spark.createDataFrame([(2.228, 10), (2.201, 11), (12.706, 1), (4.303, 2), (0.0, 7)], "t double, d int")
    got = [r.p for r in df.select(student_p_integer(F.col("t"), F.col("d")).alias("p")).collect()]
    assert got == pytest.approx([0.05, 0.05, 0.05, 0.05, 1.0], abs=2e-4)


def test_forest_flags_the_outlier(spark):
    rng = np.random.default_rng(7)
    rows = [(int(i), "g", float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(400, 2)))]
    rows += [(1000, "g", 9.0, -9.0), (2000, "tiny", 0.0, 0.0), (3000, None, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "series_id long, grp string, a double, b double")
    out = I.isolation_forest(df, ["a", "b"], ["grp"], min_size=30)
    got = {r.series_id: r for r in out.collect()}
    assert len(got) == 401
    assert got[1000].anomaly_score_scaled == 1.0 and got[1000].anomaly_bin == 1
    assert all(0 <= r.anomaly_score_scaled <= 1 for r in got.values())
    assert abs(sum(r.anomaly_bin for r in got.values()) / 401 - 0.05) < 0.01
    again = {r.series_id: r.anomaly_score for r in I.isolation_forest(df, ["a", "b"], ["grp"], min_size=30).collect()}
    assert all(again[i] == pytest.approx(r.anomaly_score) for i, r in got.items())
    first = I.forest_ranking(out).filter("rank = 1").first()
    assert first.series_id == 1000
    with pytest.raises(ValueError):
        I.isolation_forest(df, ["a"], ["grp"], min_size=10_000, require_group=True)


def test_forest_chunks_do_not_change_the_scores(spark, monkeypatch):
    rng = np.random.default_rng(8)
    df = spark.createDataFrame([(int(i), "g", float(a)) for i, a in enumerate(rng.normal(size=300))], "series_id long, grp string, a double")
    whole = {r.series_id: r.anomaly_score for r in I.isolation_forest(df, ["a"], ["grp"]).collect()}
    monkeypatch.setattr(I, "CHUNK_ROWS", 40)
    split = {r.series_id: r.anomaly_score for r in I.isolation_forest(df, ["a"], ["grp"]).collect()}
    assert whole.keys() == split.keys() and all(whole[i] == pytest.approx(split[i]) for i in whole)


def test_forest_trees_isolate_every_sample():
    rng = np.random.default_rng(9)
    x = np.tile(rng.normal(size=(64, 3)), (5, 1))
    feature, cut = I.grow_trees(x, np.repeat(np.arange(5), 64), np.stack([I.node_draws(1, t, 6) for t in range(5)]), 6)
    depth = I.path_lengths(x[:64], feature, cut)
    assert depth.shape == (64, 5) and (depth >= 1).all() and depth.max() <= 6 + I.expected_path(64)


def test_kmodes_cost_never_rises_and_matches_brute_force(spark):
    v = Views(spark, SF_DIR)
    names = ["p_brand", "p_type", "size_band"]
    profiles = KM.distinct_profiles(v.categorical(), names)
    models = KM.fit(profiles, names, [3, 5, 8])
    for k, model in models.items():
        assert len(model.modes) == k and model.costs == sorted(model.costs, reverse=True)
    rows = [tuple(r) for r in v.categorical().select(*names).collect()]
    model = models[5]
    brute = sum(min(sum(a != b for a, b in zip(row, m)) for m in model.modes) for row in rows)
    assert brute <= model.cost
    assigned = KM.assign(v.categorical(), names, model.modes)
    assert assigned.agg(F.sum("mismatch")).first()[0] == brute


def test_kmodes_start_is_the_densest_then_the_farthest(spark):
    v = Views(spark, SF_DIR)
    names = ["p_brand", "p_type", "size_band"]
    profiles = KM.distinct_profiles(v.categorical(), names)
    known = [(tuple(r[n] for n in names), r["density"]) for r in profiles.collect()]
    modes = []
    while len(modes) < 6:
        modes.append(min((-round(d * min((sum(a != b for a, b in zip(m, c)) for c in modes), default=3), 9), m) for m, d in known)[1])
    assert KM.initial_modes(profiles, names, 6) == modes
    with pytest.raises(ValueError, match="different profiles"):
        KM.initial_modes(profiles.limit(2), names, 3)


def test_forest_does_not_follow_the_input_files(spark, tmp_path):
    v = Views(spark, SF_DIR)
    rows = B.supervised_features(v.group_panel().join(v.truth(), "series_id"), ["category", "zone"])
    scores = []
    for files in (1, 50):
        path = str(tmp_path / str(files))
        rows.repartition(files).write.parquet(path)
        table = spark.read.parquet(path)
        model = B.train(table, "forest", categories=["category", "zone"], trees=5)
        scores.append({r.series_id: round(r.score, 9) for r in B.score(model, table).collect()})
    assert scores[0] == scores[1]


def test_more_than_a_hundred_categories(spark):
    rows = spark.range(300).select(F.col("id").alias("series_id"), (F.col("id") % 150).cast("string").alias("category"),
                                   *[F.lit(1.0).alias(c) for c in B.NUMERIC])
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    encoded = Pipeline(stages=B.encoder(B.NUMERIC, ["category"])).fit(rows).transform(rows)
    values = [r[0] for r in encoded.select(vector_to_array("features")).collect()]
    assert {len(x) for x in values} == {len(B.NUMERIC) + 150} and all(sum(x[len(B.NUMERIC):]) == 1 for x in values)


def test_long_panels_keep_all_coefficients(spark):
    rows = spark.range(4).select(F.col("id").alias("series_id"), F.explode(F.sequence(F.lit(0), F.lit(82))).alias("t")).select(
        "series_id", F.add_months(F.lit("2015-01-01").cast("date"), F.col("t")).alias("period"),
        (10 + F.pmod(F.hash("series_id", "t"), F.lit(20))).cast("double").alias("value"))
    columns = X.feature_table(rows).columns
    assert "fft_abs_41" in columns and "fft_abs_42" not in columns


def test_models_score_every_row(spark):
    v = Views(spark, SF_DIR)
    rows = B.supervised_features(v.group_panel().join(v.truth(), "series_id"), ["category", "zone"])
    for kind in ("gbt", "gbt_deep", "forest"):
        model = B.train(rows, kind, categories=["category", "zone"], trees=3)
        unseen = rows.withColumn("zone", F.lit("never seen"))
        scored = B.score(model, unseen)
        assert scored.count() == rows.count()
        assert scored.filter("score < 0 or score > 1 or score is null").isEmpty()


def test_feature_table_drops_incomplete_columns(spark):
    rng = np.random.default_rng(11)
    df = frame(spark, {1: rng.normal(50, 9, 19), 2: rng.normal(50, 9, 19), 3: rng.normal(50, 9, 12)})
    table = X.feature_table(df)
    assert table.count() == 3 and "fft_real_6" in table.columns and "fft_real_9" not in table.columns
    assert not any(r is None for row in table.collect() for r in row)


def test_flat_series_has_no_correlation(spark):
    """A flat series has a slope of zero, but neither r nor what follows from it; the others keep theirs."""
    got = {r.series_id: r for r in X.linear_trend(X.index_series(frame(spark, {1: [5] * 8, 2: [0] * 8, 3: range(8), 4: [3]}))).collect()}
    assert [(got[k].trend_slope, got[k].trend_intercept) for k in (1, 2)] == [(0.0, 5.0), (0.0, 0.0)]
    assert {(got[k].trend_r, got[k].trend_stderr, got[k].trend_p) for k in (1, 2, 4)} == {(None, None, None)}
    assert got[3].trend_r == pytest.approx(1) and got[3].trend_stderr == pytest.approx(0, abs=1e-6) and got[3].trend_p == pytest.approx(0, abs=1e-6)


def test_feature_table_is_the_complete_part_of_its_sql(spark, tmp_path):
    """Supplier 0 is flat, supplier 1 has few months: what they lack is left out, all else equals the SQL."""
    con = duckdb.connect()
    con.sql(f"create table supplier as from '{SF_DIR}/supplier.parquet'")
    con.sql(f"""create table lineitem as select * replace (case when l_suppkey = 0 then 7.0 else l_quantity end as l_quantity)
        from '{SF_DIR}/lineitem.parquet' where l_suppkey <> 1 or l_shipdate > (select max(l_shipdate) - interval 12 month from '{SF_DIR}/lineitem.parquet')
        qualify l_suppkey <> 0 or row_number() over (partition by l_suppkey, date_trunc('month', l_shipdate) order by l_orderkey, l_linenumber) = 1""")
    for name in ("supplier", "lineitem"):
        con.sql(f"copy {name} to '{tmp_path}/{name}.parquet'")
    sql = ORACLES["feature_table"]
    columns = con.sql(sql).columns
    gaps = con.sql("select " + ", ".join(f"count(*) filter ({c} is null or isnan(cast({c} as double)))" for c in columns) + f" from ({sql})").fetchall()[0]
    kept = [c for c, n in zip(columns, gaps) if n == 0]
    assert {"trend_r", "fft_real_9"}.isdisjoint(kept) and {"trend_slope", "fft_real_5", "cid_ce"} <= set(kept)
    assert differences(con, QUERIES["feature_table"](spark, str(tmp_path)), f"select {', '.join(kept)} from ({sql})") == []


def test_one_client_does_not_take_a_feature_from_all(spark):
    """Without a pair of the longer templates the entropy is infinite, which is a value: the column stays."""
    rng = np.random.default_rng(21)
    lone = [0.0, 10, 20, 30, 0, 10, 40, 50, 60, 70, 80, 90]  # one close pair of two, none of three
    df = frame(spark, {1: rng.integers(0, 3, 19), 2: rng.integers(0, 3, 19), 3: lone})
    table = X.feature_table(df)
    got = {r.series_id: r.sample_entropy for r in table.select("series_id", "sample_entropy").collect()}
    assert np.isinf(got[3]) and np.isfinite([got[1], got[2]]).all()
    counts = {r["column"]: r["missing"] for r in X.missing_counts(X.feature_table(df, complete=False), ["series_id"]).collect()}
    assert counts["sample_entropy"] == 0 and counts["fft_real_9"] == 1 and "fft_real_9" not in table.columns


def test_choice_of_features(spark):
    df = frame(spark, {k: np.random.default_rng(k).normal(50, 9, 19) for k in range(4)})
    some = X.feature_table(df, wanted=["trend_slope", "fft_abs_3", "recurring_share"])
    assert some.columns == ["series_id", "trend_slope", "fft_abs_3", "recurring_share"]
    whole = {r.series_id: (r.trend_slope, r.fft_abs_3, r.recurring_share) for r in X.feature_table(df).collect()}
    assert {r.series_id: tuple(r)[1:] for r in some.collect()} == whole
    with pytest.raises(ValueError, match="unknown"):
        X.feature_table(df, wanted=["trend_slope", "no_such"])


def test_fourier_equals_numpy(spark):
    y = np.random.default_rng(12).normal(10, 3, 18)
    got = {r.k: (r.fft_real, r.fft_imag) for r in X.fourier(X.index_series(frame(spark, {1: y}))).collect()}
    want = np.fft.rfft(y)
    assert [got[k][0] for k in range(10)] == pytest.approx(want.real.tolist(), abs=1e-9)
    assert [got[k][1] for k in range(10)] == pytest.approx(want.imag.tolist(), abs=1e-9)


def test_sample_entropy_by_definition(spark):
    y = np.random.default_rng(13).integers(0, 6, 25).astype(float)
    r = 0.2 * y.std()

    def count(m):
        windows = np.array([y[i:i + m] for i in range(len(y) - m + 1)])
        return sum((np.abs(windows - w).max(1) <= r).sum() - 1 for w in windows)

    got = X.sample_entropy(X.index_series(frame(spark, {1: y}))).first().sample_entropy
    assert got == pytest.approx(-np.log(count(3) / count(2)))


def test_split_is_exact_per_label(spark):
    df = spark.range(1000).select(F.col("id").alias("series_id"), (F.col("id") % 4 == 0).cast("int").alias("label"))
    got = {(r.label, r.train): r.n for r in B.stratified_split(df).groupBy("label", "train").agg(F.count("*").alias("n")).collect()}
    assert got == {(0, True): 600, (0, False): 150, (1, True): 200, (1, False): 50}
