"""Hand-made frames for the cases that real tables rarely show."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from meterwatch.functions import address as A
from meterwatch.functions import nulls as N
from meterwatch.functions import scalar as S
from meterwatch.operators import classifiers as B
from meterwatch.operators import economics as K
from meterwatch.operators import evaluation as E
from meterwatch.operators import group_gaussian as G
from meterwatch.operators import labels as L
from meterwatch.operators import panel as P
from meterwatch.operators import quality as Q
from meterwatch.operators import relational as R
from meterwatch.operators import series as W
from meterwatch.operators import structural as D
from meterwatch.operators.ordering import exact_quantiles, global_rank, ordered_prefix
from meterwatch.sources import readers, stages

SERIES = "series_id long, period date, value double"


def month(n):
    return dt.date(2020 + (n - 1) // 12, (n - 1) % 12 + 1, 1)


def series(id_, values):
    return [(id_, month(i + 1), v) for i, v in enumerate(values)]


def values(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


# --- missing values -------------------------------------------------------

def test_nan_becomes_null_and_infinity_becomes_the_default(rows):
    df = rows("x double", [(float("nan"),), (float("inf"),), (1.0,), (None,)])
    assert values(N.clean_floats(df), "x") == [(None,), (math.inf,), (1.0,), (None,)]
    assert values(df.select(N.finite_or(F.col("x")).alias("x")), "x") == [(0.0,), (0.0,), (1.0,), (0.0,)]


def test_null_is_no_member_and_differs_from_everything(rows):
    df = rows("c string", [(None,), ("a",), ("b",)])
    assert values(df.select(N.is_in(F.col("c"), ["a"]).alias("x")), "x") == [(False,), (True,), (False,)]
    assert values(df.select(N.not_equal(F.col("c"), "a").alias("x")), "x") == [(True,), (False,), (True,)]


def test_null_code_is_kept_with_label_one(rows):
    df = rows("series_id long, visit_date date, code string", [
        (1, month(1), None), (0, month(1), "X"), (2, month(1), L.NOT_APPLICABLE_VISITS), (3, month(1), L.NO_IMPACT_VISITS[0])])
    assert sorted(values(L.label_no_impact(df), "series_id", "label")) == [(1, 1), (3, 0)]
    conform = L.label_conform(rows("series_id long, code string", [
        (1, L.CONFORMING_VISITS), (2, L.NOT_APPLICABLE_VISITS), (3, None)]))
    assert sorted(values(conform, "series_id", "label")) == [(1, 0), (2, None), (3, 1)]


# --- text -----------------------------------------------------------------

@pytest.mark.parametrize("raw, clean", [("100", "100"), ("10.0", "10"), (" nan ", None), ("", None), ("Sur", "Sur"), (None, None)])
def test_category_keeps_its_zeros(rows, raw, clean):
    assert values(rows("c string", [(raw,)]).select(S.clean_category(F.col("c")).alias("c")), "c") == [(clean,)]


@pytest.mark.parametrize("raw, clean", [
    ("calle 18 NORTE 2C-40", "CALLE 18 NORTE #2C-40"),
    ("Crr Belen 9 77", "CARRERA BELEN #9-77"),
    ("CLL 10  5 - 20 APT 3 (X)", "CALLE 10 #5-20"),
    ("AVE 3 4 5", "AVENIDA 3 #4-5"),
    ("AVENIDA CANAL BOGOTA 12 34", "AVENIDA CANAL BOGOTA #12-34"),
    ("CRR ANT BELEN 8A - 9", "CARRERA ANTIGUA BELEN #8A-9"),
    ("AVENIDA LIBERTADORES 1B - 22", "AVENIDA LIBERTADORES #1B-22"),
    ("PEÑÓN 4 5 - 6", "PEÑÓN 4 #5-6"),
    ("VEREDA (km 4)  LA  UNIÓN", "VEREDA LA UNIÓN"),
    (None, None),
])
def test_address_shapes(rows, raw, clean):
    df = rows("a string", [(raw,)]).select(A.standardise_a(F.col("a")).alias("a"))
    assert values(df, "a") == [(clean,)]


@pytest.mark.parametrize("raw, clean", [
    ("k 05 12 - 7 apto 301", "CARRERA 5 # 12 - 7, Cali, Colombia"),
    ("CL 70 NORTE 2 A - 10 BLOQUE 4", "CALLE 70 NORTE # 2 A - 10, Cali, Colombia"),
    ("AV 3 MACROMEDICION", "AVENIDA 3, Cali, Colombia"),
    ("VD LA FONDA 0000", "VEREDA LA FONDA 0, Cali, Colombia"),
    (None, None),
])
def test_second_address_format(rows, raw, clean):
    df = rows("a string", [(raw,)]).select(A.normalise_b(F.col("a")).alias("a"))
    assert values(df, "a") == [(clean,)]


def test_fallback_to_the_installation_address(rows):
    address, source = A.with_fallback(F.col("o"), F.col("i"))
    df = rows("o string, i string", [("K 1 2 - 3", None), (None, "CL 4"), (None, None)])
    assert values(df.select(address.alias("a"), source.alias("s")), "s") == [("direccion_oficial",), ("instalacion",), ("fallido",)]


def test_typed_id(rows):
    df = rows("id long", [(1,), (2,)])
    assert values(df.filter(S.matches_typed_id(F.col("id"), " 2.0 ")), "id") == [(2,)]
    assert df.filter(S.matches_typed_id(F.col("id"), "x")).count() == 2


def test_header_that_is_no_date_gives_null(rows):
    wide = rows("id long, `01/02/2024` string, `total` string", [(1, "2.5", "x")])
    assert sorted(values(readers.months_to_rows(wide, ["id"]), "period", "value"), key=str) == [
        (None, None), (dt.date(2024, 2, 1), 2.5)]


# --- order ----------------------------------------------------------------

def test_rank_breaks_ties_by_id_and_puts_null_last(rows):
    df = rows("id long, s double", [(3, 1.0), (1, 1.0), (2, None), (4, 5.0)])
    ranked = global_rank(df, [F.desc_nulls_last("s"), F.asc("id")])
    assert sorted(values(ranked, "rank", "id")) == [(1, 4), (2, 1), (3, 3), (4, 2)]


def test_prefix_over_many_partitions_with_one_huge_group(spark):
    """A third of the rows in one group, compared with a plain window."""
    from pyspark.sql import Window

    df = spark.range(30_000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 50).alias("g"),
        (F.col("id") * 7919 % 1000).alias("v"))
    order = [F.desc("v"), F.asc("id")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ordered_prefix(df, order, ["g"], sums={"run": "v"}, totals={"all": "v"})
        w = Window.partitionBy("g").orderBy(*order)
        want = df.select("id", F.row_number().over(w).alias("rank"),
                         F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("run"),
                         F.sum("v").over(Window.partitionBy("g")).alias("all"))
        assert got.select("id", "rank", "run", "all").exceptAll(want).isEmpty()
        assert got.count() == 30_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_quantiles_equal_the_builtin(spark):
    df = spark.range(5_000).select((F.col("id") % 7).alias("g"), (F.col("id") * 31 % 997 / 3).alias("v"))
    got = exact_quantiles(df, "v", {"a": 0.05, "b": 0.5, "c": 1.0}, ["g"])
    want = df.groupBy("g").agg(*[F.percentile("v", F.lit(p)).alias(n) for n, p in (("a", 0.05), ("b", 0.5), ("c", 1.0))])
    for x, y in zip(sorted(values(got, "g", "a", "b", "c")), sorted(values(want, "g", "a", "b", "c"))):
        assert x == pytest.approx(y)


# --- series ---------------------------------------------------------------

def test_linear_gaps_and_ends(rows):
    df = rows(SERIES, series(1, [None, 2.0, None, 4.0, None]) + series(2, [None, 7.0, None]) + series(3, [None, None]))
    got = {(i, p): v for i, p, v in values(W.interpolate(df), "series_id", "period", "value")}
    assert [got[1, month(m)] for m in range(1, 6)] == [1.0, 2.0, 3.0, 4.0, 5.0]
    assert [got[2, month(m)] for m in range(1, 4)] == [7.0] * 3
    assert got[3, month(1)] is None


def test_quadratic_gaps_restore_a_parabola(rows):
    true = [float(i * i - 3 * i) for i in range(8)]
    holed = [None if i in (0, 3, 4, 7) else v for i, v in enumerate(true)]
    df = W.interpolate(rows(SERIES, series(1, holed)), method="quadratic")
    assert [v for _, v in sorted(values(df, "period", "value"))] == pytest.approx(true)
    two = W.interpolate(rows(SERIES, series(1, [1.0, None, 3.0])), method="quadratic")
    assert [v for _, v in sorted(values(two, "period", "value"))] == [1.0, 2.0, 3.0]


def test_percent_change_from_zero_and_over_gaps(rows):
    df = rows(SERIES, series(1, [0.0, 5.0, None, 10.0])).select("period", W.percent_change().alias("c"))
    assert [c for _, c in sorted(values(df, "period", "c"))] == [0.0, 0.0, 0.0, 1.0]


def test_constant_group_has_no_spread(rows):
    df = rows("g string, x double", [("a", 5.0), ("a", 5.0)])
    assert values(W.standardise_in_group(df, ["g"], ["x"]), "x_z") == [(0.0,), (0.0,)]
    assert values(W.minmax_in_group(df, ["g"], "x", "m"), "m") == [(0.0,), (0.0,)]


def test_best_reading_prefers_positive_values(rows):
    df = rows(SERIES, [(1, month(1), None), (1, month(1), 0.0), (1, month(1), 3.0), (2, month(1), None)])
    assert sorted(values(R.best_reading(df, ["series_id", "period"]), "series_id", "value")) == [(1, 3.0), (2, None)]


def test_densify_keeps_attributes_null_unless_carried(rows):
    df = rows("series_id long, period date, value double, zone string", [(1, month(1), 1.0, "N"), (1, month(3), 3.0, "N"), (2, month(2), 2.0, "S")])
    assert P.densify(df).count() == 6
    assert sorted(values(P.densify(df).filter("value is null"), "zone")) == [(None,)] * 3
    assert P.densify(df, carry=["zone"]).filter("zone is null").isEmpty()
    wide = P.densify(df, F.lit(month(1)), F.lit(month(4)))
    assert wide.count() == 8


# --- quality --------------------------------------------------------------

def test_series_without_values_are_rejected(rows):
    df = rows(SERIES, series(1, [None, None]) + series(2, [4.0] * 3) + series(3, [1.0, 2.0]) + series(4, [7.0]) + series(5, [3.0, 3.0, None]))
    assert sorted(values(Q.invalid_series(df), "series_id", "reason")) == [
        (1, Q.TOO_MANY_NULLS), (2, Q.NO_VARIANCE), (5, Q.TOO_MANY_NULLS), (5, Q.NO_VARIANCE)]
    assert sorted(values(Q.invalid_series_strict(df), "series_id", "reason")) == [
        (1, Q.TOO_MANY_NULLS), (2, Q.NO_VARIANCE), (5, Q.TOO_MANY_NULLS)]


def test_recent_meter_and_high_consumers(rows):
    df = rows("series_id long, period date, value double, cls string, chg string", [
        (i, month(m), float(i * 10), "r", c) for i, c in ((1, "SIN CAMBIO MEDIDOR"), (2, "2020-11-01"), (3, "basura"), (4, "2000-01-01"))
        for m in range(1, 13)])
    assert {r[0] for r in values(Q.exclude_recent(df, "chg", 6), "series_id")} == {1, 3, 4}
    assert {r[0] for r in values(Q.exclude_high(df, "cls", 0.7), "series_id")} == {1, 2, 3}
    kept = Q.filter_customers(df, months=6, change_col="chg", class_col="cls", high_quantile=0.7, only_balanced=True)
    assert {r[0] for r in values(kept, "series_id")} == {1, 3} and kept.count() == 12


# --- labels ---------------------------------------------------------------

VISITS = "series_id long, visit_date date, code string, label int"


def test_reconcile_keeps_every_label_pair_once(rows):
    old = rows(VISITS, [(1, month(1), "a", 0), (1, month(2), "b", 1), (1, month(3), "c", 1), (2, month(1), "d", None), (3, month(1), "e", 0)])
    new = rows(VISITS, [(1, month(5), "n", 0), (4, month(6), "m", 1), (None, month(1), "x", 1)])
    got = sorted(values(L.reconcile(old, new), "series_id", "old_label", "new_label", "label", "code", "pairs"))
    assert got == [(1, 0, 0, 0, "n", 1), (1, 1, 0, 1, "c", 2), (3, 0, None, 0, "e", 1), (4, None, 1, 1, "m", 1)]


def test_integration_prefers_the_first_source(rows):
    a = rows(VISITS, [(1, month(1), "x", 1)])
    b = rows(VISITS, [(1, month(1), "x", 0), (1, month(1), "y", 0)])
    assert sorted(values(L.integrate({"a": a, "b": b}), "code", "source", "label")) == [("x", "a", 1), ("y", "b", 0)]


def test_latest_label_stops_the_fan_out(rows):
    df = rows(VISITS, [(1, month(1), "a", 1), (1, month(2), "b", 0), (2, month(1), "a", 0), (2, month(1), "b", 1), (3, month(1), "a", None)])
    assert sorted(values(L.latest_label(df), "series_id", "label")) == [(1, 0), (2, 1)]


# --- detectors ------------------------------------------------------------

def _group(rows, points, g="g"):
    return rows("series_id long, g string, prev double, value double", [(i, g, x, y) for i, (x, y) in enumerate(points)])


def test_collinear_group_and_null_key(rows):
    df = _group(rows, [(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)]).unionByName(_group(rows, [(1.0, 1.0)] * 4, None))
    got = values(G.mahalanobis_scores(df, ["g"]), "fraud_score", "density")
    assert len(got) == 3 and all(math.isfinite(a) and math.isfinite(b) for a, b in got)


def test_missing_value_in_a_group(rows):
    df = _group(rows, [(1.0, 2.0), (2.0, 1.0), (3.0, 5.0), (None, 4.0)])
    assert G.mahalanobis_scores(df, ["g"]).count() == 3
    spoiled = values(G.mahalanobis_scores(df, ["g"], null_policy="propagate"), "fraud_score")
    assert spoiled == [(None,)] * 4
    assert G.mahalanobis_scores(df, ["g"], min_size=4).isEmpty()


def test_distance_equals_the_matrix_form(rows):
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 2)) @ np.array([[2.0, 0.5], [0.0, 1.0]])
    got = dict(values(G.mahalanobis_scores(_group(rows, [tuple(map(float, p)) for p in x]), ["g"]), "series_id", "fraud_score"))
    d = x - x.mean(0)
    want = np.sqrt(np.einsum("ij,jk,ik->i", d, np.linalg.inv(np.cov(x, rowvar=False, ddof=0)), d))
    assert [got[i] for i in range(40)] == pytest.approx(want.tolist())


def test_cusum_skips_short_and_incomplete_series(rows):
    step = [1.0] * 15 + [9.0] * 15
    df = rows(SERIES, series(1, step) + series(2, [1.0] * 9) + series(3, [None, *step]) + series(4, [2.0] * 12)
              + series(5, [1.0, 2.0] * 15))
    got = {i: (p, c) for i, p, c in values(D.cusum_break(df, 0.1), "series_id", "cusum_pval", "structural_change")}
    assert set(got) == {1, 4, 5}
    assert got[4] == (None, None) and got[1][1] is True and got[5][1] is False


def test_kolmogorov_table(rows):
    from meterwatch.functions.stats import kolmogorov_p

    df = rows("s double", [(1.63,), (1.36,), (1.22,), (0.5,), (0.0,), (None,)]).select(F.round(kolmogorov_p(F.col("s")), 4).alias("p"))
    assert [p for (p,) in values(df, "p")] == [0.0098, 0.0495, 0.1019, 0.9639, 1.0, None]


# --- evaluation -----------------------------------------------------------

RANKING = "series_id long, detector string, score double"


def _brute_ap(ids, relevant):
    hits = total = 0
    for k, i in enumerate(ids, 1):
        if i in relevant:
            hits += 1
            total += hits / k
    return total / len(relevant) if relevant else 0.0


def test_average_precision_by_definition(rows):
    ids, relevant = [5, 3, 9, 1, 7], {3, 1, 100}
    ranking = rows(RANKING, [(i, "d", float(-n)) for n, i in enumerate(ids)])
    truth = rows("series_id long, label int", [(i, 1) for i in relevant] + [(5, 0)])
    hits, n = E.ranked_hits(ranking, truth), E.count_relevant(truth)
    assert values(E.average_precision(hits, n), "ap")[0][0] == pytest.approx(_brute_ap(ids, relevant))
    assert values(E.precision_at_k(hits, 10), "precision") == [(0.2,)]
    assert values(E.recall_at_k(hits, 2, n), "recall")[0][0] == pytest.approx(1 / 3)
    with pytest.raises(ValueError):
        E.precision_at_k(hits, 0)


def test_no_relevant_ids_give_zero(rows):
    ranking, truth = rows(RANKING, [(1, "d", 1.0)]), rows("series_id long, label int", [(1, 0)])
    hits, n = E.ranked_hits(ranking, truth), E.count_relevant(truth)
    assert values(E.average_precision(hits, n), "ap") == [(0.0,)]
    assert values(E.recall_at_k(hits, 1, n), "recall") == [(0.0,)]
    assert values(E.compare_detectors(ranking, truth), "recall_at_k", "ap") == [(0.0, 0.0)]


def test_evaluation_takes_relevance_within_the_head(rows):
    ranking = rows(RANKING, [(i, "d", float(-i)) for i in range(1, 7)])
    truth = rows("series_id long, label int", [(1, 0), (2, 1), (4, 1), (6, 1)])
    got = values(E.compare_detectors(ranking, truth, top=3), "k", "precision_at_k", "recall_at_k", "ap")
    assert got == [(3, pytest.approx(2 / 3), 1.0, pytest.approx((1 / 2 + 2 / 3) / 2))]


def test_published_confusion_counts(rows):
    matrix = rows("label int, predicted int, count long", [(0, 0, 923), (0, 1, 165), (1, 0, 426), (1, 1, 300)])
    report = {r["class"]: r for r in B.classification_report(matrix).collect()}
    assert round(report["accuracy"]["precision"], 3) == 0.674
    assert round(report["1"]["recall"], 3) == 0.413 and round(report["1"]["precision"], 3) == 0.645


def test_thresholds_are_strict_and_the_matrix_is_not(rows):
    scored = rows("series_id long, cluster string, label int, value double, score double", [
        (1, "a", 1, 10.0, 0.5), (2, "a", 0, 30.0, 0.5), (3, "b", 1, 50.0, 0.9), (4, "b", 0, 10.0, 0.9)])
    profile = K.cluster_profile(scored)
    assert values(K.beneficial_clusters(profile), "cluster", "difference") == [("a", 20.0)]
    visits = dict(values(K.threshold_sweep(scored, profile), "threshold", "visits"))
    assert visits[0.45] == 2 and visits[0.5] == 0 and len(visits) == 17
    assert values(B.confusion_matrix(scored).filter("predicted = 1").agg(F.sum("count").alias("n")), "n") == [(4,)]


def test_auc_against_the_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    df = spark.range(500).select((F.col("id") % 3 == 0).cast("double").alias("label"),
                                 ((F.col("id") * 37 % 101) / 100).alias("score"))
    want = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    assert values(B.roc_auc(df), "auc")[0][0] == pytest.approx(want)
    area = B.trapezoid_area(B.roc_curve(df))
    assert values(area, "area")[0][0] == pytest.approx(want)


# --- stages ---------------------------------------------------------------

def test_half_written_stage_is_built_again(spark, tmp_path):
    path = str(tmp_path / "stage")
    spark.range(3).write.parquet(path)
    (tmp_path / "stage" / "_SUCCESS").unlink()
    assert stages.reuse_or_build(spark, path, lambda: spark.range(5).toDF("id")).count() == 5


def test_resume_computes_only_what_is_missing(spark, tmp_path):
    path, seen = str(tmp_path / "out"), []

    def compute(todo):
        seen.append(sorted(r.id for r in todo.collect()))
        return todo.withColumn("x", F.col("id") * 2)

    stages.resume(spark, path, spark.range(3), ["id"], compute)
    done = stages.resume(spark, path, spark.range(5), ["id"], compute)
    assert seen == [[0, 1, 2], [3, 4]] and done.count() == 5


def test_resume_keeps_every_committed_range(spark, tmp_path):
    """A run that fails in its third range leaves two; the next run computes the rest only."""
    path, calls = str(tmp_path / "out"), []
    table = spark.range(400).select((F.col("id") % 100).alias("id"), F.col("id").alias("x"))
    table = table.unionByName(spark.createDataFrame([(None, 1), (None, 2)], "id long, x long"))

    def compute(rows):
        calls.append({r.id for r in rows.select("id").distinct().collect()})
        if len(calls) == 3:
            raise RuntimeError("the machine is gone")
        return rows.filter("id is null or id <> 7").groupBy("id").agg(F.sum("x").alias("total"))

    with pytest.raises(RuntimeError):
        stages.resume(spark, path, table, ["id"], compute, keys_per_range=26)
    kept = stages.committed(spark, path)
    assert [c["folder"] for c in kept] == ["commit-000000", "commit-000001"] and kept[0]["high"] == kept[1]["low"]
    first = calls[0] | calls[1]
    assert {r.id for r in stages.committed_rows(spark, path).collect()} == first - {7} and sum(c["keys"] for c in kept) == len(first)
    calls.append(set())
    done = stages.resume(spark, path, table, ["id"], compute, keys_per_range=26)
    again = set().union(*calls[4:])
    assert not again & first and again | first == {*range(100), None}
    plain = {r.id: r.total for r in table.groupBy("id").agg(F.sum("x").alias("total")).collect()}
    assert {r.id: r.total for r in done.collect()} == {k: v for k, v in plain.items() if k != 7} and done.count() == 100
    before = len(calls)
    assert stages.resume(spark, path, table, ["id"], compute).count() == 100 and len(calls) == before


def test_resume_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "id long, x long")
    assert stages.resume(spark, str(tmp_path / "none"), empty, ["id"], lambda rows: rows).columns == ["id", "x"]


# --- empty input ----------------------------------------------------------

def test_empty_input_gives_the_declared_columns(rows):
    empty = rows(SERIES, [])
    assert W.interpolate(empty).columns == ["series_id", "period", "value"]
    assert Q.invalid_series(empty).isEmpty() and Q.trailing_months(empty, 3).isEmpty()
    assert P.densify(empty).isEmpty() and D.cusum_break(empty).isEmpty()
    assert global_rank(empty, [F.asc("series_id")]).columns == ["series_id", "period", "value", "rank"]
    assert exact_quantiles(empty, "value", {"m": 0.5}, ["series_id"]).isEmpty()


def test_intermediate_tables_go_to_the_folder_of_the_cluster(spark):
    from meterwatch.session import persist_table, shared_folder

    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark).startswith(base)
    kept = persist_table(spark.range(3))
    assert all(base in f for f in kept.inputFiles()) and kept.count() == 3


def test_clients_with_equal_values_share_the_cut(rows):
    """Means that are equal but for the order of the readings are equal, so nobody is above the cut."""
    turns = ([0.1, 0.2, 0.3], [0.3, 0.2, 0.1], [0.2, 0.3, 0.1])
    df = rows("series_id long, value double, cls string", [(i, x, "r") for i in range(30) for x in turns[i % 3]]).coalesce(1)
    assert Q.exclude_high(df, "cls", 0.5).count() == df.count()
    sums = df.groupBy("series_id").agg(S.exact_sum(F.col("value")).alias("s"), S.ordered_mean(F.col("value")).alias("m"))
    assert {(r.s, r.m) for r in sums.collect()} == {(0.6, (0.1 + 0.2 + 0.3) / 3)}
    assert rows("value double", [(None,), (None,)]).agg(S.ordered_mean(F.col("value")).alias("m")).first()["m"] is None


def test_the_source_of_an_address_needs_no_cleaning(rows):
    df = rows("a string, b string", [("CL 1 2 - 3", "x"), ("", None), ("APTO", "K 1"), (None, "K 01 2 - 3 APTO 4"), (None, "  "), (None, None)])
    address, source = A.with_fallback(F.col("a"), F.col("b"))
    assert "regexp" not in df.select(source.alias("s"))._jdf.queryExecution().optimizedPlan().toString().lower()
    found = df.select(address.alias("t"), source.alias("s")).collect()
    assert [r.s for r in found] == ["direccion_oficial"] * 3 + ["instalacion"] * 2 + ["fallido"]
    assert [r.t is None for r in found] == [False] * 5 + [True]
