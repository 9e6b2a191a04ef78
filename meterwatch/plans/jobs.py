"""Whole jobs from a panel on disk to a ranking on disk.

Every stage is a Parquet table that is used again if it is complete and was made
from the same input with the same parameters, so an interrupted job goes on at the
stage it had reached, and a job with other parameters builds its own.

    python -m meterwatch.plans.jobs gaussian --panel panel.parquet --out results --group zone category
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwatch.functions.scalar import fixed, parse_date, parse_number
from meterwatch.operators import classifiers, consolidate, economics, evaluation, forecast, forest, group_gaussian, kmodes, quality, structural
from meterwatch.operators import series_features as features
from meterwatch.operators.bagging import ForestModel
from meterwatch.operators.boosting import BoostedModel
from meterwatch.operators.evaluation import TOP_K
from meterwatch.operators.labels import integrate, label_all_positive, label_new_report, label_no_impact, labelled_panel_ids, latest_label
from meterwatch.operators.ordering import global_rank
from meterwatch.operators.panel import ATTRIBUTES, COMMERCIAL_COLUMNS, CONSUMPTION_COLUMNS, build_panel, complete_panel
from meterwatch.operators.relational import drop_ids, first_per_key, latest_present, union_all
from meterwatch.session import build_session, persist_table, use_folder
from meterwatch.sources.readers import scan_parquet, scan_tab_text
from meterwatch.sources.stages import (KEYS_PER_RANGE, identity, input_identity, is_complete, remove, resume, reuse_or_build,
                                       sample_entities)
from meterwatch.sources.writers import write_csv

MONTHS, LOW, MIN_GROUP = 19, 5.0, 25
VISIT_DATES = ("yyyy-MM-dd", "dd/MM/yyyy", "yyyy-MM-dd HH:mm:ss")


def _whole_id(name: str) -> Column:
    return F.expr(f"try_cast({name} as bigint)")


def raw_panel(spark: SparkSession, consumption: str, commercial: str) -> tuple[DataFrame, DataFrame]:
    """(panel, readings without a client) from the two raw tab-separated files.

    NULL and 0 ids, which gather unassigned readings, go first; repeated readings
    of a client and month are reduced to the best one before any window; months
    without a reading are filled with NULL.
    """
    readings = scan_tab_text(spark, consumption, CONSUMPTION_COLUMNS, ("producto", "ano", "mes", "consumo"))
    readings = readings.select(_whole_id("producto").alias("series_id"), F.expr("try_cast(ano as int)").alias("year"),
                               F.expr("try_cast(mes as int)").alias("month"), parse_number(F.col("consumo")).alias("value"))
    readings = readings.filter("series_id <> 0 and year is not null and month between 1 and 12")
    clients = scan_tab_text(spark, commercial, COMMERCIAL_COLUMNS, ("producto", *ATTRIBUTES)).withColumn(
        "series_id", _whole_id("producto")).filter("series_id <> 0")
    matched, unmatched = build_panel(readings, first_per_key(clients, ["series_id"], ATTRIBUTES), drop=("year", "month"))
    return complete_panel(matched, carry=ATTRIBUTES), unmatched


def raw_inspections(spark: SparkSession, path: str, id_col: str = "producto", date: str = "fecha_visita", code: str = "irregularidad") -> DataFrame:
    """series_id, visit_date, code from a file of visits with a header; ids that are no whole number and dates that cannot be read are NULL."""
    rows = spark.read.option("header", True).csv(path)
    return rows.select(F.expr(f"try_cast(`{id_col}` as bigint)").alias("series_id"), parse_date(F.col(f"`{date}`"), VISIT_DATES).alias("visit_date"),
                       F.trim(F.col(f"`{code}`")).alias("code"))


def raw_labels(spark: SparkSession, panel: str, visits: str, reports: str, out: str, findings: str | None = None,
               columns: dict[str, str] | None = None, id_col: str = "series_id") -> DataFrame:
    """Labels of the clients of a panel from raw files of inspections, written to ``out``.

    Visits are 1 but for codes without impact, the newer reports likewise with their own
    codes; ``findings`` is a third file in which every row is an irregularity. The visits and
    findings are put together without copies of (client, date, code), matched with the
    reports, the larger label wins, and clients without a series are left out. ``columns``
    renames the columns of the files. The source tables are kept beside the result.
    """
    names = columns or {}
    old = {"visits": label_no_impact(raw_inspections(spark, visits, **names).filter("series_id is not null"))}
    if findings:
        old["findings"] = label_all_positive(raw_inspections(spark, findings, **names).filter("series_id is not null"))
    whole = reuse_or_build(spark, f"{out}_sources-{identity(files=[input_identity(spark, f) for f in (visits, findings) if f], names=names)}",
                           lambda: integrate(old))
    new = label_new_report(raw_inspections(spark, reports, **names).filter("series_id <> 0"))
    ids = scan_parquet(spark, panel).select(F.col(id_col).alias("series_id"))
    found = labelled_panel_ids(whole.drop("source"), new, ids).withColumnRenamed("series_id", id_col)
    found.write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


class Job:
    """Names of the panel columns and the folder of the results.

    With ``change_col`` (date of the last meter change) clients whose meter changed
    lately are left out, with ``class_col`` those with a mean above the 95 % quantile
    of their class. Intermediate tables of operators go to ``<out>/_stages`` unless the cluster names
    a ``spark.checkpoint.dir``; ``close`` removes them.
    """

    def __init__(self, spark: SparkSession, panel: str, out: str, group: Sequence[str], id_col: str = "series_id",
                 time_col: str = "period", value: str = "value", sample: int | None = None,
                 change_col: str | None = None, class_col: str | None = None):
        self.spark, self.panel, self.out, self.group = spark, panel, out.rstrip("/"), list(group)
        self.id, self.time, self.value, self.sample = id_col, time_col, value, sample
        self.change, self.high_class = change_col, class_col
        use_folder(spark, f"{self.out}/_stages")

    def close(self) -> None:
        remove(self.spark, f"{self.out}/_stages")

    def path(self, name: str) -> str:
        return f"{self.out}/{f'sample{self.sample}_' if self.sample else ''}{name}"

    def stage(self, name: str, build: Callable[[], DataFrame], sampled: bool = True, **what: object) -> DataFrame:
        """A table named after its input, the columns and thresholds of the job and ``what`` else it depends on."""
        return reuse_or_build(self.spark, self.stage_path(name, sampled, **what), build)

    def stage_path(self, name: str, sampled: bool = True, **what: object) -> str:
        made_from = identity(panel=input_identity(self.spark, self.panel), columns=[self.id, self.time, self.value, *self.group],
                             limits=[MONTHS, LOW, MIN_GROUP], steps=[self.change, self.high_class], **what)
        return f"{self.path(name) if sampled else f'{self.out}/{name}'}-{made_from}"

    def invalid(self) -> DataFrame:
        raw = scan_parquet(self.spark, self.panel)
        return self.stage("invalid_series", lambda: quality.invalid_series(raw, self.id, self.value), sampled=False)

    def filtered(self) -> DataFrame:
        """Clients with valid series and no low month, the last months only."""
        def build() -> DataFrame:
            named = dict.fromkeys([self.id, self.time, self.value, *self.group, *[c for c in (self.change, self.high_class) if c]])
            raw = scan_parquet(self.spark, self.panel).select(*named)
            return quality.filter_customers(
                drop_ids(raw, self.invalid(), [self.id]), MONTHS, self.id, self.time, self.value, change_col=self.change,
                drop_recent=self.change is not None, low_threshold=LOW, class_col=self.high_class, drop_high=self.high_class is not None)

        whole = self.stage("filtered", build, sampled=False)
        return sample_entities(whole, self.sample, self.id) if self.sample else whole

    def gaussian(self, lag_rows: int = 4) -> DataFrame:
        made = self.stage("gaussian_features", lambda: group_gaussian.consumption_features(
            self.filtered(), lag_rows, self.id, self.time, self.value), lag_rows=lag_rows)
        scores = self.stage("gaussian_scores", lambda: group_gaussian.mahalanobis_scores(
            made, [*self.group, "year_month"], f"{self.value}_log_prev", f"{self.value}_log", MIN_GROUP), lag_rows=lag_rows)
        last = latest_present(scores, self.id, self.time, [*self.group, "year_month", "fraud_score", "density"])
        return self._publish("gaussian_ranking", global_rank(
            last, [fixed(F.col("fraud_score")).desc_nulls_last(), F.col(self.id).asc()]))

    def isolation(self, wanted: Sequence[str] | None = None, keys_per_range: int = KEYS_PER_RANGE) -> DataFrame:
        """Features of the clients in ranges that are committed one by one, then the forest on the complete ones.

        ``wanted`` names the features to use, all of them if not given.
        """
        panel = self.filtered()
        longest = panel.groupBy(self.id).agg(F.count(self.value).alias("n")).agg(F.max("n")).first()[0] or 0

        def compute(rows: DataFrame) -> DataFrame:
            groups = first_per_key(rows.select(self.id, *self.group).dropna(), [self.id], self.group)
            return features.feature_table(rows, groups, self.id, self.time, self.value, wanted, complete=False, longest=int(longest))

        what = {"wanted": list(wanted) if wanted else None}
        table = resume(self.spark, self.stage_path("isolation_features", **what), panel, [self.id], compute, keys_per_range)
        table = features.drop_incomplete_columns(table, [self.id, *self.group])
        names = features.feature_columns(table, [self.id, *self.group])
        scores = self.stage("isolation_scores", lambda: forest.isolation_forest(
            table, names, self.group, self.id, MIN_GROUP, require_group=True), **what)
        return self._publish("isolation_ranking", forest.forest_ranking(scores, self.id))

    def structural(self, alpha: float = 0.1) -> DataFrame:
        breaks = structural.cusum_break(self.filtered(), alpha, self.id, self.time, self.value)
        return self._publish("cusum_ranking", structural.cusum_ranking(breaks, self.id))

    def forecast(self, train_len: int = MONTHS - 4, test_len: int = 4, first_limit: float = 0.9, limit: float = 0.6) -> DataFrame:
        """The individual methods as one table per client: checks, vote of the confirmed, error rank, structural change, reasons."""
        names = (self.id, self.time, self.value)
        what = {"train": train_len, "test": test_len, "flags": [first_limit, limit]}
        panel = self.filtered()
        voted = self.stage("forecast_confirmed", lambda: forecast.confirmed_anomalies(panel, train_len, test_len, first_limit, limit, *names), **what)

        def errors() -> DataFrame:
            ets = forecast.ets_check(panel, train_len, test_len, first_limit, *names)
            ar = forecast.ar_check(panel, train_len, test_len, limit, *names)
            waves = forecast.fourier_check(panel, train_len, test_len, limit, id_col=self.id, time_col=self.time, value=self.value)
            return ets.join(ar, self.id, "full").join(waves, self.id, "full")

        columns = ["mae_ets", "mae_ar", "mae_fourier"]
        ranked = forecast.forecast_ranking(self.stage("forecast_errors", errors, **what), tuple(columns), self.id).select(self.id, *columns, "rank")
        cusum = structural.cusum_ranking(structural.cusum_break(panel, 0.1, *names), self.id).select(self.id, "cusum_pval", "rank")
        clients = scan_parquet(self.spark, self.panel).select(self.id)
        found = consolidate.client_results(clients, self.invalid(), cusum=cusum, forecasts=ranked, id_col=self.id).join(
            voted.select(self.id, "votes", "anomaly_final"), self.id, "left")
        return self._publish("client_results", found)

    def consolidated(self) -> DataFrame:
        """One row per client with what the group ranking, the forest, the structural change and the forecasts say."""
        clients = scan_parquet(self.spark, self.panel).select(self.id)
        gaussian = self.gaussian().select(self.id, "fraud_score", "density", "rank")
        isolated = self.isolation().select(self.id, "anomaly_score", "anomaly_score_scaled", "anomaly_bin", "rank")
        rest = self.forecast().drop("reason", "invalid")
        found = consolidate.client_results(clients, self.invalid(), gaussian=gaussian, forest=isolated, id_col=self.id)
        return self._publish("consolidated", found.join(rest, self.id, "left"))

    def evaluate(self, labels: str, kind: str = "gbt_deep", top: int = TOP_K) -> DataFrame:
        """The rankings that were written, against the labels: precision, recall and average precision at each depth.

        Reads whichever of the rankings exist; the head of each is written as
        ``top_<name>``, and ``top_overlap`` says how many clients two heads share.
        """
        seen = latest_label(scan_parquet(self.spark, labels), self.id)
        key = scan_parquet(self.spark, self.panel).schema[self.id].dataType
        known = {"gaussian": ("gaussian_ranking", "rank"), "isolation": ("isolation_ranking", "rank"), "cusum": ("cusum_ranking", "rank"),
                 "forecast": ("client_results", "rank_forecast"), "supervised": (f"{kind}_ranking", "rank")}
        parts = []
        for name, (table, rank) in known.items():
            path = self.path(f"{table}_csv")
            if is_complete(self.spark, path):
                rows = self.spark.read.option("header", True).csv(path)
                parts.append(rows.select(F.lit(name).alias("detector"), F.col(self.id).cast(key).alias(self.id),
                                         (-F.col(rank).cast("double")).alias("score")).filter("score is not null"))
        if not parts:
            raise ValueError(f"no ranking was written to {self.out}")
        rankings = persist_table(union_all(*parts))
        heads = persist_table(rankings.filter(F.col("score") >= -top))  # ranks are written down, so a head is a filter
        for name in known:
            write_csv(heads.filter(F.col("detector") == name).select(self.id, (-F.col("score")).cast("long").alias("rank")),
                      self.path(f"top_{name}_csv"), mode="overwrite")
        other = heads.select(F.col("detector").alias("other"), F.col(self.id).alias("__id"))
        pairs = heads.join(other, (heads[self.id] == other["__id"]) & (heads["detector"] < other["other"]))  # a row per client and pair of detectors
        self._publish("top_overlap", pairs.groupBy("detector", "other").agg(F.count("*").alias("both")))
        return self._publish("evaluation", evaluation.compare_detectors(rankings, seen, id_col=self.id, top=top))

    def supervised(self, labels: str, kind: str = "gbt_deep", trees: int = classifiers.TREES) -> DataFrame:
        """Fit on the labelled clients, report on the held-out part, score everyone.

        ``labels`` is a Parquet table (id, visit_date, label); repeated visits
        are reduced to the latest before they meet a series.
        """
        seen = latest_label(scan_parquet(self.spark, labels), self.id)
        names = (self.id, self.time, self.value)
        made_from = input_identity(self.spark, labels)
        fit = {"labels": made_from, "kind": kind, "trees": trees}
        known = self.stage("supervised_features", lambda: classifiers.stratified_split(
            classifiers.supervised_features(self.filtered().join(seen, self.id), self.group, "label", *names), id_col=self.id),
            labels=made_from)
        model = self._model(known, kind, trees, fit)
        held_out = self.stage(f"{kind}_validation", lambda: classifiers.score(
            model, known.filter("not train")), **fit)
        self._publish(f"{kind}_report", classifiers.classification_report(classifiers.confusion_matrix(held_out)))
        self._publish(f"{kind}_roc", classifiers.roc_curve(held_out))
        scores = self.stage(f"{kind}_predictions", lambda: classifiers.score(
            model, classifiers.supervised_features(self.filtered(), self.group, None, *names)), **fit)
        return self._publish(f"{kind}_ranking", global_rank(
            scores, [fixed(F.col("score")).desc_nulls_last(), F.col(self.id).asc()]))

    def _model(self, known: DataFrame, kind: str, trees: int, fit: dict) -> BoostedModel | ForestModel:
        """The fitted model, kept as a stage like any table."""
        path = self.stage_path(f"{kind}_model", **fit)
        if not is_complete(self.spark, path):
            classifiers.train(known.filter("train"), kind, categories=self.group, trees=trees, id_col=self.id).save(self.spark, path)
        return classifiers.load_model(self.spark, kind, path)

    def compare_models(self, labels: str, kinds: Sequence[str] = ("gbt", "forest", "gbt_deep"), trees: int = classifiers.TREES) -> DataFrame:
        """One row per model and class: area under the ROC curve on the held-out part, precision, recall, F1, support."""
        tables = []
        for kind in kinds:
            self.supervised(labels, kind, trees)
            fit = {"labels": input_identity(self.spark, labels), "kind": kind, "trees": trees}
            held_out = scan_parquet(self.spark, self.stage_path(f"{kind}_validation", **fit))
            report = classifiers.classification_report(classifiers.confusion_matrix(held_out))
            tables.append(report.join(F.broadcast(classifiers.roc_auc(held_out))).select(F.lit(kind).alias("model"), "auc", *report.columns))  # one row
        found = tables[0]
        for t in tables[1:]:
            found = found.unionByName(t)
        return self._publish("model_comparison", found)

    def benefit(self, labels: str, kind: str = "gbt_deep", k: int = 10, trees: int = classifiers.TREES) -> DataFrame:
        """Clusters of the labelled clients and what each threshold earns on the scores of ``supervised``."""
        seen = latest_label(scan_parquet(self.spark, labels), self.id)
        made_from = input_identity(self.spark, labels)
        mean = self.filtered().groupBy(self.id, *self.group).agg(F.avg(self.value).alias("value"))
        segments = self.stage("segments", lambda: kmodes.kmodes(
            mean.join(seen, self.id).dropna(), self.group, k), labels=made_from, k=k)
        profile = self.stage("cluster_profile", lambda: economics.cluster_profile(segments), labels=made_from, k=k)
        scores = scan_parquet(self.spark, self.stage_path(f"{kind}_predictions", labels=made_from, kind=kind, trees=trees)).select(self.id, "score")
        return self._publish(f"{kind}_benefit", economics.threshold_sweep(segments.join(scores, self.id), profile))

    def _publish(self, name: str, ranking: DataFrame) -> DataFrame:
        write_csv(ranking, self.path(f"{name}_csv"), mode="overwrite")
        return ranking


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("job", choices=(
        "panel", "labels", "gaussian", "isolation", "structural", "forecast", "consolidated", "supervised", "compare_models", "benefit", "evaluate"))
    parser.add_argument("--panel", required=True, help="the panel that is read, or written by the job of that name")
    parser.add_argument("--out", help="folder of the results")
    parser.add_argument("--group", nargs="+", help="columns that make a group")
    parser.add_argument("--consumption", help="raw readings, for panel")
    parser.add_argument("--commercial", help="raw clients, for panel")
    parser.add_argument("--visits", help="raw visits, for labels")
    parser.add_argument("--reports", help="raw newer reports, for labels")
    parser.add_argument("--findings", help="raw irregularities, for labels")
    parser.add_argument("--id", default="series_id")
    parser.add_argument("--time", default="period")
    parser.add_argument("--value", default="value")
    parser.add_argument("--labels", help="table of labelled visits; written by labels, read by supervised, compare_models and benefit")
    parser.add_argument("--change", help="column with the last meter change, to leave out recent ones")
    parser.add_argument("--high-class", help="column of the class in which very high users are left out")
    parser.add_argument("--sample", type=int, help="only the first clients, for a trial")
    args = parser.parse_args(arguments)
    if args.job == "panel":
        if not args.consumption or not args.commercial:
            parser.error("panel needs --consumption and --commercial")
        raw_panel(build_session(), args.consumption, args.commercial)[0].write.mode("errorifexists").parquet(args.panel)
        return
    if args.job == "labels":
        if not (args.visits and args.reports and args.labels):
            parser.error("labels needs --visits, --reports and --labels, which is written")
        raw_labels(build_session(), args.panel, args.visits, args.reports, args.labels, args.findings, id_col=args.id)
        return
    if not args.out or not args.group:
        parser.error(f"{args.job} needs --out and --group")
    job = Job(build_session(), args.panel, args.out, args.group, args.id, args.time, args.value, args.sample,
              args.change, args.high_class)
    try:
        if args.job in ("supervised", "compare_models", "benefit", "evaluate"):
            if not args.labels:
                parser.error(f"{args.job} needs --labels")
            getattr(job, args.job)(args.labels)
        else:
            getattr(job, args.job)()
    finally:
        job.close()


if __name__ == "__main__":
    main()
