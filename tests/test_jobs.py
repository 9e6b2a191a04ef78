"""Whole jobs on a small panel, run twice."""

import csv
import glob

import pytest
from pyspark.sql import functions as F

from meterwatch.operators import classifiers
from meterwatch.operators.panel import COMMERCIAL_COLUMNS, CONSUMPTION_COLUMNS
from meterwatch.plans.jobs import Job, raw_labels, raw_panel
from meterwatch.plans.views import Views
from meterwatch.session import shared_folder
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def panel(spark, tmp_path_factory):
    """One group, 19 months and more, one client with a low month and one with gaps."""
    path = str(tmp_path_factory.mktemp("panel") / "panel")
    rows = Views(spark, SF_DIR).t("events").select(
        F.pmod("event_id", F.lit(60)).alias("series_id"),
        F.add_months(F.lit("2022-01-01").cast("date"), F.pmod(F.floor(F.col("event_id") / 60), F.lit(24)).cast("int")).alias("period"), "value")
    grid = rows.select("series_id").distinct().withColumn("period", F.explode(F.expr(
        "sequence(date'2022-01-01', date'2023-12-01', interval 1 month)")))
    spent = rows.groupBy("series_id", "period").agg(F.sum("value").alias("value"))
    value = 40 + F.coalesce("value", F.lit(0.0)) + F.pmod(F.hash("series_id", "period"), F.lit(20))
    value = F.when(F.col("series_id") == 1, F.lit(1.0)).when((F.col("series_id") == 2) & (F.month("period") < 7), None).otherwise(value)
    grid.join(spent, ["series_id", "period"], "left").select(
        "series_id", "period", value.alias("value"), F.lit("z").alias("zone"), F.lit("y").alias("zone2")).write.parquet(path)
    return path


@pytest.mark.parametrize("name", ["gaussian", "isolation", "structural"])
def test_job_writes_a_ranking_and_goes_on_from_its_stages(spark, panel, tmp_path, name):
    job = Job(spark, panel, str(tmp_path / "out"), ["zone"])
    first = {r.series_id: r["rank"] for r in getattr(job, name)().collect()}
    assert first and sorted(first.values()) == list(range(1, len(first) + 1))
    assert 1 not in first and 2 not in first
    again = {r.series_id: r["rank"] for r in getattr(job, name)().collect()}
    assert again == first
    written = [row for f in glob.glob(str(tmp_path / "out" / f"{name.replace('structural', 'cusum')}_ranking_csv" / "*.csv")) for row in csv.DictReader(open(f))]
    assert len(written) == len(first)


def test_sample_has_its_own_stages(spark, panel, tmp_path):
    whole = Job(spark, panel, str(tmp_path / "out"), ["zone"]).filtered()
    few = Job(spark, panel, str(tmp_path / "out"), ["zone"], sample=5)
    assert few.filtered().select("series_id").distinct().count() == 5 < whole.select("series_id").distinct().count()
    assert few.path("x") != f"{few.out}/x"


def test_labels_to_scores_to_money(spark, panel, tmp_path, monkeypatch):
    labels = str(tmp_path / "labels")
    spark.range(60).select(
        F.col("id").alias("series_id"), F.lit("2023-05-01").cast("date").alias("visit_date"),
        (F.col("id") % 3 == 0).cast("int").alias("label")).write.parquet(labels)
    job = Job(spark, panel, str(tmp_path / "out"), ["zone"])
    ranked = job.supervised(labels, trees=2)
    clients = job.filtered().select("series_id").distinct().count()
    assert ranked.count() == clients and ranked.filter("score is null").isEmpty()
    report = [row for f in glob.glob(str(tmp_path / "out" / "gbt_deep_report_csv" / "*.csv")) for row in csv.DictReader(open(f))]
    assert {r["class"] for r in report} == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert job.benefit(labels, k=1, trees=2).count() in (0, 17)
    fitted = []
    monkeypatch.setattr(classifiers, "train", lambda *a, **b: fitted.append(a))
    again = {r.series_id: r.score for r in job.supervised(labels, trees=2).collect()}
    assert not fitted and again == {r.series_id: r.score for r in ranked.collect()}


def test_other_parameters_have_their_own_stages(spark, panel, tmp_path):
    def scores(out, lag, group=("zone",)):
        rows = Job(spark, panel, str(tmp_path / out), list(group)).gaussian(lag).collect()
        return {r.series_id: round(r.fraud_score or 0, 9) for r in rows}

    one, two = scores("both", 1), scores("both", 2)
    assert one != two and two == scores("fresh", 2)
    assert scores("both", 1, ("zone", "zone2")) == one


def test_stage_folder_goes_and_is_asked_for_on_a_cluster(spark, panel, tmp_path, monkeypatch):
    job = Job(spark, panel, str(tmp_path / "out"), ["zone"])
    (tmp_path / "out" / "_stages" / "x").mkdir(parents=True)
    job.close()
    assert not (tmp_path / "out" / "_stages").exists()

    class Settings:
        def get(self, name, default=None):
            return "yarn" if name == "spark.master" else None

    class Session:
        conf = Settings()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_raw_files_to_filtered(spark, tmp_path):
    readings, clients = [], []
    for client in (1, 2, 3):
        clients.append({"producto": client, "localidad": "north", "categoria": "1"})
        readings += [{"producto": client, "ano": 2022 + m // 12, "mes": m % 12 + 1, "consumo": 50 + client + m % 5} for m in range(24)]
    readings += [{"producto": p, "ano": 2022, "mes": 5, "consumo": 900} for p in ("0", "", "x", "77") for _ in range(20)]
    readings += [dict(readings[0], consumo=""), dict(readings[0], consumo=-4), dict(readings[1])]
    clients += [dict(clients[0]), {"producto": "0"}, {"producto": ""}]
    for name, columns, rows in (("readings", CONSUMPTION_COLUMNS, readings), ("clients", COMMERCIAL_COLUMNS, clients)):
        lines = ["\t".join(columns), *["\t".join(str(r.get(c, "")) for c in columns) for r in rows]]
        (tmp_path / name).write_text("\n".join(lines), encoding="latin-1")
    panel, unmatched = raw_panel(spark, str(tmp_path / "readings"), str(tmp_path / "clients"))
    assert {r.series_id for r in unmatched.select("series_id").distinct().collect()} == {77}
    path = str(tmp_path / "panel")
    panel.write.parquet(path)
    table = spark.read.parquet(path)
    assert table.count() == 72 == table.select("series_id", "period").distinct().count()
    assert table.filter("value is null or localidad is null").isEmpty()
    kept = Job(spark, path, str(tmp_path / "out"), ["localidad"]).filtered()
    assert kept.select("series_id").distinct().count() == 3 and kept.groupBy("series_id").count().filter("count <> 19").isEmpty()


def test_individual_methods(spark, panel, tmp_path):
    found = {r.series_id: r for r in Job(spark, panel, str(tmp_path / "out"), ["zone"]).forecast().collect()}
    assert len(found) == 60
    ranks = sorted(r.rank_forecast for r in found.values() if r.rank_forecast)
    assert ranks == list(range(1, len(ranks) + 1)) and found[1].invalid == 1 and found[1].rank_forecast is None


def rows_of(tmp_path, name):
    return [row for f in glob.glob(str(tmp_path / "out" / f"{name}_csv" / "*.csv")) for row in csv.DictReader(open(f))]


def test_rankings_against_labels(spark, panel, tmp_path):
    labels = str(tmp_path / "labels")
    spark.range(60).select(F.col("id").alias("series_id"), F.lit("2023-05-01").cast("date").alias("visit_date"),
                           (F.col("id") % 3 == 0).cast("int").alias("label")).write.parquet(labels)
    job = Job(spark, panel, str(tmp_path / "out"), ["zone"])
    with pytest.raises(ValueError, match="no ranking"):
        job.evaluate(labels)
    whole = {r.series_id: r for r in job.consolidated().collect()}
    assert len(whole) == 60 and whole[1].invalid == 1 and whole[5].rank_forest and whole[5].rank_gaussian and whole[5].rank_cusum
    found = {(r.detector, r.k): r for r in job.evaluate(labels, top=20).collect()}
    assert {d for d, _ in found} == {"gaussian", "isolation", "forecast"}
    head = sorted((int(r["rank"]), int(r["series_id"])) for r in rows_of(tmp_path, "top_isolation"))
    assert [k for k, _ in head] == list(range(1, 21))
    last = max(k for d, k in found if d == "isolation")
    hits = sum(i % 3 == 0 for _, i in head)
    assert last == 20 and found["isolation", 20].precision_at_k == pytest.approx(hits / 20)
    other = {int(r["series_id"]) for r in rows_of(tmp_path, "top_gaussian")}
    both = {(r["detector"], r["other"]): int(r["both"]) for r in rows_of(tmp_path, "top_overlap")}
    assert both["gaussian", "isolation"] == len(other & {i for _, i in head})


def test_three_models_side_by_side(spark, panel, tmp_path):
    labels = str(tmp_path / "labels")
    spark.range(60).select(F.col("id").alias("series_id"), F.lit("2023-05-01").cast("date").alias("visit_date"),
                           (F.col("id") % 3 == 0).cast("int").alias("label")).write.parquet(labels)
    rows = Job(spark, panel, str(tmp_path / "out"), ["zone"]).compare_models(labels, ("gbt", "gbt_deep"), trees=2).collect()
    assert len(rows) == 10 and {r.model for r in rows} == {"gbt", "gbt_deep"} and all(0 <= r.auc <= 1 for r in rows)


def test_features_in_ranges_and_steps(spark, panel, tmp_path):
    plain = {r.series_id: r.anomaly_score for r in Job(spark, panel, str(tmp_path / "a"), ["zone"]).isolation().collect()}
    parts = {r.series_id: r.anomaly_score for r in Job(spark, panel, str(tmp_path / "b"), ["zone"]).isolation(keys_per_range=20).collect()}
    assert plain.keys() == parts.keys() and all(plain[i] == pytest.approx(parts[i]) for i in plain)
    few = Job(spark, panel, str(tmp_path / "b"), ["zone"]).isolation(["trend_slope", "cid_ce"])
    assert few.count() == len(plain)
    steps = Job(spark, panel, str(tmp_path / "c"), ["zone"], class_col="zone")
    assert 0 < len(plain) - steps.filtered().select("series_id").distinct().count() <= 4


def test_raw_files_to_labels(spark, panel, tmp_path):
    """Visits, findings and newer reports become one label per match, for clients with a series only."""
    def put(name, rows):
        (tmp_path / name).write_text("producto,fecha_visita,irregularidad\n" + "\n".join(",".join(r) for r in rows), encoding="utf-8")
        return str(tmp_path / name)

    visits = put("visits.csv", [("3", "2023-01-05", "CO - CONFORME"), ("4", "2023-01-06", "D_X - PUENTE"), ("5", "2023-01-07", "CO - CONFORME"),
                                ("6", "2023-02-01", "NA - NO APLICA"), ("4", "2023-01-06", "D_X - PUENTE"), ("0", "2023-02-01", "D_X - PUENTE"),
                                ("x", "2023-02-01", "D_X - PUENTE"), ("900", "2023-02-01", "D_X - PUENTE")])
    reports = put("reports.csv", [("5", "2023-03-01", "12 - DIRECTO"), ("3", "2023-03-02", "16 - OTRO"), ("7", "2023-03-03", "14 - CAMBIO DE USO O TARIFA INADECUADA AL TIPO DE CLIENTE")])
    findings = put("findings.csv", [("8", "2023-04-01", "ANY"), ("8", "2023-04-01", "ANY")])
    out = str(tmp_path / "labels")
    found = {r.series_id: (r.label, str(r.visit_date)) for r in raw_labels(spark, panel, visits, reports, out, findings).collect()}
    assert found == {3: (0, "2023-01-05"), 4: (1, "2023-01-06"), 5: (1, "2023-03-01"), 7: (0, "2023-03-03"), 8: (1, "2023-04-01")}
    assert raw_labels(spark, panel, visits, reports, out, findings).count() == 5
