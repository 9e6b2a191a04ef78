"""Inspection labels: policies, reconciliation and the ground truth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwatch.functions.nulls import is_in, not_equal
from meterwatch.functions.scalar import pick_by_match
from meterwatch.operators.relational import first_per_key, union_all

# fixed values: irregularity codes that leave no trace in the series, per source
NO_IMPACT_NEW_REPORT = (
    "16G - MEDIDOR SIN SELLO DE BORNERA Y/O ROTOS",
    "15 - RECONEXIÓN NO AUTORIZADA REGISTRADA POR EL MEDIDOR",
    "14 - CAMBIO DE USO O TARIFA INADECUADA AL TIPO DE CLIENTE",
)
UNKNOWN_NEW_REPORT = "16 - OTRO"
NO_IMPACT_VISITS = (
    "D_S5 - SIN SELLO BORNERA",
    "D_M19 - MEDIDOR SIN TAPA BORNERA",
    "D_A6 - RECONEXIÓN NO AUTORIZADA REGISTRADA POR EL MEDIDOR",
    "CO - CONFORME",
)
NOT_APPLICABLE_VISITS = "NA - NO APLICA"
CONFORMING_VISITS = "CO - CONFORME"


def _reported(df: DataFrame, id_col: str) -> DataFrame:
    """Distinct report rows of real clients (0 marks an unknown one)."""
    return df.distinct().filter(not_equal(F.col(id_col), 0))


def label_no_impact(
    df: DataFrame, id_col: str = "series_id", code: str = "code",
    no_impact: Sequence[str] = NO_IMPACT_VISITS, not_applicable: Sequence[str] = (NOT_APPLICABLE_VISITS,),
) -> DataFrame:
    """1, but 0 for codes without impact; codes that do not apply are dropped."""
    label = F.when(is_in(F.col(code), no_impact), 0).otherwise(1)
    return _reported(df, id_col).filter(~is_in(F.col(code), not_applicable)).withColumn("label", label)


def label_all_positive(df: DataFrame, id_col: str = "series_id") -> DataFrame:
    """Every reported irregularity is 1."""
    return _reported(df, id_col).withColumn("label", F.lit(1))


def label_conform(
    df: DataFrame, id_col: str = "series_id", code: str = "code",
    conforming: str = CONFORMING_VISITS, not_applicable: str = NOT_APPLICABLE_VISITS,
) -> DataFrame:
    """Conforming 0, not applicable NULL, else 1."""
    label = (F.when(F.col(code) == conforming, F.lit(0))
             .when(F.col(code) == not_applicable, F.lit(None).cast("int")).otherwise(F.lit(1)))
    return _reported(df, id_col).withColumn("label", label)


def label_new_report(
    df: DataFrame, code: str = "code", unknown: str = UNKNOWN_NEW_REPORT,
    no_impact: Sequence[str] = NO_IMPACT_NEW_REPORT,
) -> DataFrame:
    """Drop the unknown code; 0 for codes without impact, else 1."""
    label = F.when(is_in(F.col(code), no_impact), 0).otherwise(1)
    return df.filter(not_equal(F.col(code), unknown)).withColumn("label", label)


def integrate(sources: dict[str, DataFrame], id_col: str = "series_id", date: str = "visit_date", code: str = "code") -> DataFrame:
    """All sources in one table with a source tag.

    Copies of (id, date, code) keep the source named first.
    """
    tagged = [
        df.select(id_col, date, code, "label", F.lit(name).alias("source"), F.lit(n).alias("__order"))
        for n, (name, df) in enumerate(sources.items())
    ]
    return first_per_key(union_all(*tagged), [id_col, date, code], ["__order"]).drop("__order")


def _per_label(df: DataFrame, prefix: str, id_col: str, date: str, code: str) -> DataFrame:
    """One row per (id, label): number of visits, and date and code of the latest."""
    latest = F.max(F.struct(F.col(date), F.col(code))).alias("__latest")
    return (
        df.filter(F.col(id_col).isNotNull())
        .groupBy(id_col, F.col("label").alias(f"{prefix}_label"))
        .agg(F.count(F.lit(1)).alias(f"{prefix}_visits"), latest)
        .select(id_col, f"{prefix}_label", f"{prefix}_visits",
                F.col(f"__latest.{date}").alias(f"{prefix}_date"),
                F.col(f"__latest.{code}").alias(f"{prefix}_code"))
    )


def reconcile(
    old: DataFrame, new: DataFrame, id_col: str = "series_id", date: str = "visit_date", code: str = "code",
) -> DataFrame:
    """Full outer match of two labelled sources; the final label is the larger.

    Each source is first reduced to one row per (id, label), so an id with
    many visits gives at most one row per pair of labels instead of every pair
    of visits; ``pairs`` says how many visit pairs a row stands for. Date and
    reason come from the new source when its label decided, else from the old.
    """
    a = _per_label(old, "old", id_col, date, code)
    b = _per_label(new, "new", id_col, date, code)
    final = F.greatest("old_label", "new_label")

    def choose(what: str) -> Column:
        return pick_by_match(F.col("label"), F.col("new_label"), F.col(f"new_{what}"), F.col(f"old_{what}"))

    pairs = F.coalesce(F.col("old_visits"), F.lit(1)) * F.coalesce(F.col("new_visits"), F.lit(1))
    return (
        a.join(b, id_col, "full").withColumn("label", final).filter("label is not null")
        .select(id_col, "old_label", "new_label", "label",
                choose("date").alias(date), choose("code").alias(code), pairs.alias("pairs"))
    )


def labelled_panel_ids(old: DataFrame, new: DataFrame, panel: DataFrame, id_col: str = "series_id") -> DataFrame:
    """Reconciled labels of the clients that have a series."""
    known = panel.select(id_col).distinct()
    return reconcile(old, new, id_col).join(known, id_col, "left_semi").select(
        id_col, "visit_date", "label", "code")


def latest_label(labels: DataFrame, id_col: str = "series_id", date: str = "visit_date") -> DataFrame:
    """One label per id: the latest visit, the larger label on the same day.

    Keeps repeated inspections from multiplying the series rows in a join.
    """
    best = F.max_by(F.col("label"), F.struct(F.col(date), F.col("label")))
    return labels.filter(F.col("label").isNotNull()).groupBy(id_col).agg(best.alias("label"))


def filter_by_category(
    labels: DataFrame, categories: DataFrame, code: str = "code",
    by_user: str = "by_user", over_billing: str = "over_billing",
) -> DataFrame:
    """All normal rows, and anomalies whose category is the user's doing
    and does not come with over-billing."""
    wanted = (categories.filter(F.col(by_user) & ~F.col(over_billing))
              .select(code).distinct().withColumn("__hit", F.lit(True)))
    joined = labels.join(wanted, code, "left")
    keep = (F.col("label") == 0) | ((F.col("label") == 1) & F.coalesce("__hit", F.lit(False)))
    return joined.filter(keep).select(*labels.columns)
