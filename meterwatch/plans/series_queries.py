"""Windows inside a series, and series features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwatch.functions.scalar import fixed
from meterwatch.operators import quality as Q
from meterwatch.operators import series as W
from meterwatch.operators import series_features as X
from meterwatch.operators.series_features import corridors
from meterwatch.plans.registry import ORACLES, query, r
from meterwatch.plans.relational_queries import LINEAR_SQL
from meterwatch.plans.views import Views

BY = "over (partition by series_id order by period)"


@query("lag_value", f"""
    select series_id, period, {r('lag(value, 4) ' + BY)} as value_prev, {r('lag(ln(value), 4) ' + BY)} as log_prev from fx_panel""")
def lag_value(v: Views) -> DataFrame:
    rows = v.panel().withColumn("log", F.ln("value"))
    return W.add_lag(rows, ["value", "log"], 4).select("series_id", "period", "value_prev", "log_prev")


@query("pct_change", f"""
    select series_id, period, {r('coalesce(filled / nullif(prev, 0) - 1, 0)')} as change from (
        select series_id, period, last_value(value ignore nulls) over (w rows between unbounded preceding and current row) as filled,
               last_value(value ignore nulls) over (w rows between unbounded preceding and 1 preceding) as prev
        from fx_panel_nulls window w as (partition by series_id order by period))""")
def pct_change(v: Views) -> DataFrame:
    return v.panel_nulls().select("series_id", "period", W.percent_change().alias("change"))


@query("series_index", f"select series_id, period, row_number() {BY} - 1 as t from fx_panel")
def series_index(v: Views) -> DataFrame:
    return W.add_index(v.panel()).select("series_id", "period", "t")


@query("running_sum", f"""
    select series_id, period, {r('sum(value) over (partition by series_id order by period rows unbounded preceding)')} as total
    from fx_panel""")
def running_sum(v: Views) -> DataFrame:
    return v.panel().select("series_id", "period", W.running_sum("value").alias("total"))


@query("interpolate_gaps", f"select series_id, period, {r('value')} as value from filled", ctes={"filled": LINEAR_SQL})
def interpolate_gaps(v: Views) -> DataFrame:
    return W.interpolate(v.panel_nulls())


@query("zscore_group", f"""
    select series_id, period, {r('(value - m) / case when s > 0 then s else 1 end')} as value_z from (
        select *, avg(value) over g as m, stddev_pop(value) over g as s from fx_group_panel
        window g as (partition by category, zone))""")
def zscore_group(v: Views) -> DataFrame:
    return W.standardise_in_group(v.group_panel(), ["category", "zone"], ["value"]).select("series_id", "period", "value_z")


@query("minmax_group", f"""
    select series_id, period, {r('case when hi > lo then (hi - value) / (hi - lo) else 0 end')} as scaled from (
        select *, min(value) over g as lo, max(value) over g as hi from fx_group_panel
        window g as (partition by category, zone))""")
def minmax_group(v: Views) -> DataFrame:
    rows = W.minmax_in_group(v.group_panel(), ["category", "zone"], "value", "scaled", negate=True)
    return rows.select("series_id", "period", "scaled")


@query("series_split", f"""
    select series_id, part, count(*) as n, {r('sum(value)')} as total from (
        select *, case when i <= 60 then 'train' when i <= 72 then 'test' end as part
        from (select *, row_number() {BY} as i from fx_panel)) where part is not null group by all""")
def series_split(v: Views) -> DataFrame:
    rows = v.panel().withColumn("part", W.train_test_part(60, 12)).filter("part is not null")
    return rows.groupBy("series_id", "part").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


# --- features -------------------------------------------------------------

INDEXED_SQL = """
    select series_id, value as x, row_number() over (partition by series_id order by period) - 1 as t,
           count(*) over (partition by series_id) as n, avg(value) over (partition by series_id) as mean,
           stddev_pop(value) over (partition by series_id) as std
    from fx_panel where value is not null"""
IX = {"s": INDEXED_SQL}
ORD = "partition by series_id order by t"


def _indexed(v: Views) -> DataFrame:
    return X.index_series(v.panel())


def _peak_sql(k: int) -> str:
    return (f"count(*) filter (t >= {k} and t < n - {k} and x > b{k} and x > a{k}) as number_peaks_{k}")


@query("feat_peaks", f"""
    select series_id, {', '.join(_peak_sql(k) for k in X.PEAK_SUPPORTS)} from (
        select *, {', '.join(f'max(x) over ({ORD} rows between {k} preceding and 1 preceding) as b{k}, '
                             f'max(x) over ({ORD} rows between 1 following and {k} following) as a{k}' for k in X.PEAK_SUPPORTS)}
        from s) group by 1""", ctes=IX)
def feat_peaks(v: Views) -> DataFrame:
    return X.number_peaks(_indexed(v))


@query("feat_sample_entropy", f"""
    select series_id, case when a > 0 then {r('-ln(a / b)')} else cast('infinity' as double) end as sample_entropy from (
        select p.series_id, count(*) filter (abs(p.x2 - q.x2) <= p.tol) as a, count(*) as b
        from w p join w q on p.series_id = q.series_id and p.t < q.t
             and abs(p.x - q.x) <= p.tol and abs(p.x1 - q.x1) <= p.tol
        group by 1)
    union all
    select series_id, null from (select distinct series_id from s) where series_id not in (
        select p.series_id from w p join w q on p.series_id = q.series_id and p.t < q.t
             and abs(p.x - q.x) <= p.tol and abs(p.x1 - q.x1) <= p.tol)""",
       ctes={**IX, "w": f"""select series_id, t, x, lead(x) over ({ORD}) as x1, lead(x, 2) over ({ORD}) as x2,
             0.2 * std as tol from s"""})
def feat_sample_entropy(v: Views) -> DataFrame:
    return X.sample_entropy(_indexed(v))


@query("feat_skewness", f"select series_id, {r('skewness(x)')} as skewness from s group by 1", ctes=IX)
def feat_skewness(v: Views) -> DataFrame:
    return X.moments(_indexed(v)).select("series_id", "skewness")


@query("feat_kurtosis", f"select series_id, {r('kurtosis(x)')} as kurtosis from s group by 1", ctes=IX)
def feat_kurtosis(v: Views) -> DataFrame:
    return X.moments(_indexed(v)).select("series_id", "kurtosis")


@query("feat_recurring", f"""
    select series_id, {r('count(*) filter (c > 1) / count(*)')} as recurring_share
    from (select series_id, x, count(*) as c from s group by 1, 2) group by 1""", ctes=IX)
def feat_recurring(v: Views) -> DataFrame:
    return X.recurring_share(_indexed(v))


def _corridor_sql() -> str:
    grid, parts = X.QUANTILE_GRID, []
    for low, high in corridors():
        a, b = f"q[{grid.index(low) + 1}]", f"q[{grid.index(high) + 1}]"
        for absolute in (False, True):
            step = "abs(x - x0)" if absolute else "x - x0"
            inside = f"x between {a} and {b} and x0 between {a} and {b}"
            for kind, agg in (("mean", "avg"), ("var", "var_pop")):
                name = X._corridor_name(low, high, absolute, kind)
                parts.append(f"{r(f'coalesce({agg}(case when {inside} then {step} end), 0)', 4)} as {name}")
    return ",\n".join(parts)


@query("feat_change_quantiles", f"""
    select series_id, {_corridor_sql()} from (
        select series_id, x, lag(x) over ({ORD}) as x0, q from s
        join (select series_id, quantile_cont(x, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) as q from s group by 1) using (series_id))
    group by 1""", ctes=IX, digits=4)
def feat_change_quantiles(v: Views) -> DataFrame:
    return X.change_quantiles(_indexed(v))


def _autocorrelation_sql() -> str:
    return ", ".join(
        r(f"sum((x - mean) * (x{k} - mean)) / nullif((max(n) - {k}) * max(std) * max(std), 0)") + f" as autocorrelation_{k}"
        for k in X.AUTOCORRELATION_LAGS)


@query("feat_autocorr", f"""
    select series_id, {_autocorrelation_sql()} from (
        select *, {', '.join(f'lead(x, {k}) over ({ORD}) as x{k}' for k in X.AUTOCORRELATION_LAGS)} from s) group by 1""", ctes=IX)
def feat_autocorr(v: Views) -> DataFrame:
    return X.autocorrelation(_indexed(v))


@query("feat_trend", f"""
    select series_id, {r('regr_slope(x, t)')} as trend_slope, {r('regr_intercept(x, t)')} as trend_intercept,
           {r('corr(x, t)')} as trend_r,
           {r('sqrt((1 - corr(x, t) * corr(x, t)) * var_pop(x) / (var_pop(t) * (count(*) - 2)))')} as trend_stderr
    from s group by 1""", ctes=IX)
def feat_trend(v: Views) -> DataFrame:
    return X.linear_trend(_indexed(v)).drop("trend_p")


STEPS = {**IX, "d": f"select *, x - lag(x) over ({ORD}) as d from s"}


@query("feat_cid", f"""
    select series_id, {r('sqrt(sum(d * d))')} as cid_ce, {r('coalesce(sqrt(sum(d * d)) / nullif(max(std), 0), 0)')} as cid_ce_normalised
    from d group by 1""", ctes=STEPS)
def feat_cid(v: Views) -> DataFrame:
    return X.step_features(_indexed(v)).select("series_id", "cid_ce", "cid_ce_normalised")


@query("feat_second_derivative", f"""
    select series_id, {r('(max(x) filter (t = n - 1) - max(x) filter (t = n - 2) - max(x) filter (t = 1) + max(x) filter (t = 0)) / (2 * (max(n) - 2))')}
           as mean_second_derivative_central from s group by 1""", ctes=IX)
def feat_second_derivative(v: Views) -> DataFrame:
    return X.step_features(_indexed(v)).select("series_id", "mean_second_derivative_central")


@query("feat_abs_changes", f"select series_id, {r('sum(abs(d))')} as absolute_sum_of_changes from d group by 1", ctes=STEPS)
def feat_abs_changes(v: Views) -> DataFrame:
    return X.step_features(_indexed(v)).select("series_id", "absolute_sum_of_changes")


@query("feat_streak_below", f"""
    select series_id, max(c) as longest_streak_below_mean from (
        select series_id, island, count(*) filter (x < mean) as c from (
            select *, sum(case when x < mean then 0 else 1 end) over ({ORD}) as island from s) group by 1, 2)
    group by 1""", ctes=IX)
def feat_streak_below(v: Views) -> DataFrame:
    return X.streak_below_mean(_indexed(v))


@query("feat_first_max", f"""
    select series_id, {r('min(t) / max(n)')} as first_location_of_maximum
    from (select *, max(x) over (partition by series_id) as top from s) where x = top group by 1""", ctes=IX)
def feat_first_max(v: Views) -> DataFrame:
    return X.first_maximum(_indexed(v))


@query("feat_fft", f"""
    select series_id, k, {r('re', 4)} as fft_real, {r('im', 4)} as fft_imag, {r('sqrt(re * re + im * im)', 4)} as fft_abs,
           {r("degrees(atan2(round(im, 6) + 0e0, round(re, 6) + 0e0))", 4)} as fft_angle
    from (select series_id, k, sum(x * cos(2 * pi() * (t * k) / n)) as re, -sum(x * sin(2 * pi() * (t * k) / n)) as im
          from (select *, unnest(generate_series(0, n // 2)) as k from s) group by 1, 2)""", ctes=IX, digits=4)
def feat_fft(v: Views) -> DataFrame:
    return X.fourier(_indexed(v))


@query("feat_variation", f"select series_id, {r('stddev_pop(x) / nullif(avg(x), 0)')} as variation_coefficient from s group by 1", ctes=IX)
def feat_variation(v: Views) -> DataFrame:
    return X.moments(_indexed(v)).select("series_id", "variation_coefficient")


TRAILING_SQL = "select * from fx_panel where period > (select max(period) - interval 19 month from fx_panel)"


#: Features whose SQL stands above; the p-value of a trend and the entropy, which some short series lack, are left out of the comparison.
PARTS = ("peaks", "skewness", "kurtosis", "recurring", "change_quantiles", "autocorr", "trend", "cid", "second_derivative", "abs_changes",
         "streak_below", "first_max", "variation")


TABLE_MONTHS = 19


def _feature_table_sql() -> str:
    """Every feature over the last 19 months, from the SQL of each of them."""
    def recent(key: str) -> str:
        return ORACLES[f"feat_{key}"].replace("from fx_panel where value is not null", f"from ({TRAILING_SQL}) where value is not null")

    waves = ", ".join(f"max({c}) filter (k = {k}) as {c}_{k}" for k in range(TABLE_MONTHS // 2 + 1) for c in ("fft_real", "fft_imag", "fft_abs", "fft_angle"))
    joined = " ".join(f"join ({recent(p)}) p{k} using (series_id)" for k, p in enumerate(PARTS))
    return f"""select * from (select s_suppkey as series_id, s_nationkey as nation from supplier) {joined}
        join (select series_id, {waves} from ({recent('fft')}) group by 1) w using (series_id)"""


@query("feature_table", _feature_table_sql(), digits=6)
def feature_table(v: Views) -> DataFrame:
    """All features of the last 19 months; waves and change quantiles with the four digits that their SQL has."""
    meta = v.t("supplier").select(F.col("s_suppkey").alias("series_id"), F.col("s_nationkey").alias("nation"))
    table = X.feature_table(Q.trailing_months(v.panel(), TABLE_MONTHS), meta).drop("trend_p", "sample_entropy")
    return table.select(*[fixed(F.col(c), 4).alias(c) if c.startswith(("fft_", "change_quantiles_")) else F.col(c) for c in table.columns])
