"""Unsupervised detectors."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwatch.functions.scalar import fixed
from meterwatch.operators import consolidate as C
from meterwatch.operators import forecast as T
from meterwatch.operators import forest as I
from meterwatch.operators import group_gaussian as G
from meterwatch.operators import quality as Q
from meterwatch.operators import regimes as M
from meterwatch.operators import series_features as X
from meterwatch.operators import structural as D
from meterwatch.operators.series import add_lag, ordered_arrays
from meterwatch.plans.registry import query, r
from meterwatch.plans.relational_queries import INVALID_SQL
from meterwatch.plans.series_queries import TRAILING_SQL
from meterwatch.plans.views import Views
from meterwatch.session import persist_table, spread

GROUP = ["category", "zone", "period"]
MIN_GROUP = 20


def _scores_sql(x: str, y: str, source: str, group: str, min_size: int) -> str:
    """Distance and density inside the groups, from ``source`` (series_id, period, ...)."""
    return f"""
    select series_id, period, {group}, n as group_size, exp(-d2 / 2) / (2 * pi() * sqrt(det)) as density, sqrt(d2) as fraud_score
    from (select *, greatest((ay * dx * dx - 2 * cxy * dx * dy + ax * dy * dy) / det, 0) as d2 from (
        select *, ax * ay - cxy * cxy as det from (
            select *, case when vx * vy - cxy * cxy <= 1e-12 * vx * vy then vx + 1e-6 else vx end as ax,
                      case when vx * vy - cxy * cxy <= 1e-12 * vx * vy then vy + 1e-6 else vy end as ay,
                      {x} - mx as dx, {y} - my as dy
            from (select *, count(*) over g as n, avg({x}) over g as mx, avg({y}) over g as my, var_pop({x}) over g as vx,
                         var_pop({y}) over g as vy, covar_pop({x}, {y}) over g as cxy
                  from {source} where {x} is not null and {y} is not null window g as (partition by {group}))
            where n >= {min_size})))"""


LAGGED_SQL = """
    select series_id, period, category, zone, ln(value) as cur, lag(ln(value)) over (partition by series_id order by period) as prev
    from fx_group_panel"""
SCORES = {"lagged": LAGGED_SQL,
          "scores": _scores_sql("prev", "cur", "lagged", "category, zone, period", MIN_GROUP).replace("period, category, zone, period", "category, zone, period")}


def _lagged(v: Views) -> DataFrame:
    logged = v.group_panel().withColumn("cur", F.ln("value"))
    return add_lag(logged, ["cur"], 1).withColumnRenamed("cur_prev", "prev").drop("value")


def _scores(v: Views) -> DataFrame:
    return G.mahalanobis_scores(_lagged(v), GROUP, "prev", "cur", MIN_GROUP)


@query("mahalanobis_scores", f"""
    select series_id, category, zone, period, group_size, {r('density')} as density, {r('fraud_score')} as fraud_score from scores""",
       ctes=SCORES)
def mahalanobis_scores(v: Views) -> DataFrame:
    return _scores(v).drop("prev", "cur")


@query("mahalanobis_propagate", f"""
    select l.series_id, l.category, l.zone, l.period, {r('case when gaps = 0 then fraud_score end')} as fraud_score
    from lagged l join (select category, zone, period, count(*) filter (prev is null) as gaps, count(*) as n
                        from lagged group by 1, 2, 3 having count(*) >= {MIN_GROUP}) g using (category, zone, period)
    left join scores s on s.series_id = l.series_id and s.period = l.period""", ctes=SCORES)
def mahalanobis_propagate(v: Views) -> DataFrame:
    """A missing value anywhere in a group leaves the whole group without scores."""
    scored = G.mahalanobis_scores(_lagged(v), GROUP, "prev", "cur", MIN_GROUP, null_policy="propagate")
    return scored.select("series_id", *GROUP, "fraud_score")


GAUSS = {
    "dated": """select series_id, make_date(period, 1, 1) as period, category, zone, value from fx_group_panel""",
    "logged": """select *, ln(value) as cur, lag(ln(value)) over (partition by series_id order by period) as prev,
                 strftime(period, '%Y-%m') as year_month from dated""",
    "gauss": _scores_sql("prev", "cur", "logged", "category, zone, year_month", MIN_GROUP),
    "gauss_last": f"""select series_id, {r('arg_max(fraud_score, period)')} as fraud_score, {r('arg_max(density, period)')} as density,
                     arg_max(year_month, period) as year_month from gauss group by 1""",
    "gauss_rank": "select *, row_number() over (order by fraud_score desc, series_id) as rank from gauss_last",
}


def gaussian(v: Views, group: tuple[str, ...] = ("category", "zone")) -> DataFrame:
    dated = v.group_panel().withColumn("period", F.make_date("period", F.lit(1), F.lit(1)))
    return G.gaussian_ranking(dated, list(group), lag_rows=1, min_size=MIN_GROUP)


@query("gaussian_ranking", "select * from gauss_rank", ctes=GAUSS)
def gaussian_ranking(v: Views) -> DataFrame:
    return gaussian(v)


@query("sigma_flag", f"select series_id, period, {r('fraud_score')} as fraud_score from scores where fraud_score > 2", ctes=SCORES)
def sigma_flag(v: Views) -> DataFrame:
    return G.flag_outliers(_scores(v)).select("series_id", "period", "fraud_score")


PROFILE_SQL = f"""
    select s.series_id, category, zone, period, n as group_size, outliers, {r('fraud_score')} as own_distance,
           'category: ' || category || ' | zone: ' || zone || ' | period: ' || cast(period as varchar) as description
    from (select *, row_number() over (partition by series_id order by period desc) as back from scores) s
    join (select category, zone, period, count(*) as n, count(*) filter (fraud_score > 2) as outliers
          from scores group by 1, 2, 3 having count(*) >= 2) using (category, zone, period)"""


@query("client_group_profile", f"{PROFILE_SQL} where back = 1", ctes=SCORES)
def client_group_profile(v: Views) -> DataFrame:
    """The dashboard profile of every client in its latest group, as one table."""
    return G.group_profiles(persist_table(_scores(v)), GROUP, latest_by="period")


@query("client_group_profile_one", f"{PROFILE_SQL} where series_id = 17", ctes=SCORES)
def client_group_profile_one(v: Views) -> DataFrame:
    """All the groups of the client that was asked for."""
    return G.client_group_profile(_scores(v), 17, GROUP)


@query("ellipse_points", f"""
    select category, zone, period, point, {r('angle', 4)} as angle, {r('a', 4)} as axis_a, {r('b', 4)} as axis_b,
           {r('mx + a * cos(t) * cos(angle) - b * sin(t) * sin(angle)', 4)} as x,
           {r('my + a * cos(t) * sin(angle) + b * sin(t) * cos(angle)', 4)} as y
    from (select *, point * 2 * pi() / 199 as t, 2 * sqrt(half + gap) as a, 2 * sqrt(greatest(half - gap, 0)) as b from (
        select *, (vx + vy) / 2 as half, sqrt((vx - vy) * (vx - vy) / 4 + cxy * cxy) as gap, atan2(2 * cxy, vx - vy) / 2 as angle,
               cast(unnest(generate_series(0, 199)) as int) as point
        from (select category, zone, period, avg(prev) as mx, avg(cur) as my, var_pop(prev) as vx, var_pop(cur) as vy,
                     covar_pop(prev, cur) as cxy
              from lagged where prev is not null group by 1, 2, 3 having count(*) >= {MIN_GROUP})))""", digits=4, ctes=SCORES)
def ellipse_points(v: Views) -> DataFrame:
    stats = G.group_statistics(_lagged(v).filter("prev is not null"), GROUP, "prev", "cur", MIN_GROUP)
    return G.ellipse_points(stats, GROUP)


# --- structural change ----------------------------------------------------

CUSUM = {
    "pos": """select series_id, period, value, row_number() over (partition by series_id order by period) - 1 as t,
              count(*) over (partition by series_id) as n, count(value) over (partition by series_id) as known from fx_panel_nulls""",
    "res": """select series_id, t, value, value - avg(value) over p - regr_slope(value, t) over p * (t - avg(t) over p) as r
              from pos where n >= 10 and known = n window p as (partition by series_id)""",
    "stat": """select series_id, case when sum(r * r) > 1e-20 * sum(value * value) then max(abs(c)) / sqrt(sum(r * r)) end as s
               from (select *, sum(r) over (partition by series_id order by t) as c from res) group by 1""",
    "cusum": f"""select series_id, {r('s')} as cusum_stat, {r('p')} as cusum_pval, p < 0.1 as structural_change from (
        select *, case when s is null then null when s <= 0 then 1 when s < 0.5
            then 1 - sqrt(2 * pi()) / s * (select sum(exp(-((2 * k - 1) ** 2) * pi() ** 2 / (8 * s * s))) from range(1, 21) g(k))
            else least(greatest(2 * (select sum((case when k % 2 = 1 then 1 else -1 end) * exp(-2 * k * k * s * s)) from range(1, 21) g(k)), 0), 1)
            end as p from stat)""",
}
# the panel without the gaps every ninth month, so that most series are complete
GAPLESS = {"gapless": """select series_id, period, case when series_id % 10 = 7 and month(period) > 5 then null
                         when series_id % 10 = 3 then cast(100 as double) else value end as value from fx_panel""",
           **{k: s.replace("fx_panel_nulls", "gapless") for k, s in CUSUM.items()}}


def _cusum(v: Views) -> DataFrame:
    s, m = F.col("series_id"), F.month("period")
    value = (F.when((s % 10 == 7) & (m > 5), None).when(s % 10 == 3, F.lit(100.0)).otherwise(F.col("value")))
    return D.cusum_break(v.panel().withColumn("value", value), alpha=0.1)


@query("cusum_break", "select * from cusum", ctes=GAPLESS)
def cusum_break(v: Views) -> DataFrame:
    return _cusum(v)


@query("cusum_ranking", """
    select series_id, cusum_pval, row_number() over (order by cusum_pval nulls last, series_id) as rank from cusum""", ctes=GAPLESS)
def cusum_ranking(v: Views) -> DataFrame:
    return D.cusum_ranking(_cusum(v)).select("series_id", "cusum_pval", "rank")


# --- forecast checks ------------------------------------------------------

def _trailing(v: Views) -> DataFrame:
    return Q.trailing_months(v.panel(), 19)


ETS = {
    "recent": TRAILING_SQL,
    "arrays": "select series_id, list(value order by period) as y, count(*) as n from recent group by 1",
    "gate": """select *, n >= 19 and list_stddev_pop(y[1:15]) >= 1e-3 as enough,
               list_avg(list_transform(y[1:least(n, 15)], lambda e: abs(e))) as magnitude from arrays""",
    "fits": """select series_id, a, b, list_reduce(y[2:15], lambda s, e: {
                 'l': s.l + s.b + a * (e.l - (s.l + s.b)), 'b': s.b + a * b * (e.l - (s.l + s.b)),
                 'sse': s.sse + (e.l - (s.l + s.b)) * (e.l - (s.l + s.b))}, {'l': y[1].l, 'b': y[2].l - y[1].l, 'sse': 0e0}) as f
               from (select series_id, list_transform(y, lambda e: {'l': e, 'b': 0e0, 'sse': 0e0}) as y from gate where enough)
               cross join (select i / 10e0 as a, j / 10e0 as b from range(1, 10) p(i), range(1, 10) q(j))""",
    "best": """select series_id, a as alpha, b as beta, f.l as level, f.b as trend from fits
               qualify row_number() over (partition by series_id order by f.sse, a, b) = 1""",
    "ets": f"""select series_id, enough as enough_data, case when enough then '' else 'Corta/plana' end as reason, alpha, beta,
               {r('mae')} as mae_ets, mae > 0.9 * magnitude as anomaly_ets from (
               select gate.*, alpha, beta, (abs(y[16] - (level + trend)) + abs(y[17] - (level + 2 * trend))
                   + abs(y[18] - (level + 3 * trend)) + abs(y[19] - (level + 4 * trend))) / 4 as mae
               from gate left join best using (series_id))""",
}


@query("ets_check", f"""
    select series_id, enough_data, reason, {r('alpha')} as alpha, {r('beta')} as beta, mae_ets, anomaly_ets from ets""", ctes=ETS)
def ets_check(v: Views) -> DataFrame:
    return T.ets_check(_trailing(v), 15, 4, 0.9)


def _ar_sums(tag: str, y: str, x: str) -> str:
    return f"""regr_slope({y}, {x}) filter (i <= 15) as phi_{tag}, regr_intercept({y}, {x}) filter (i <= 15) as c_{tag},
        regr_count({y}, {x}) filter (i <= 15) as n_{tag}, regr_syy({y}, {x}) filter (i <= 15) as syy_{tag},
        regr_sxy({y}, {x}) filter (i <= 15) as sxy_{tag}, avg({y}) filter (i <= 15 and {x} is not null) as m_{tag}"""


def _aicc(tag: str) -> str:
    sse = f"greatest(syy_{tag} - coalesce(phi_{tag}, 0) * coalesce(sxy_{tag}, 0), 1e-9)"
    return f"n_{tag} * ln({sse} / n_{tag}) + 6 + 24e0 / (n_{tag} - 4)"


AR = {
    "recent": TRAILING_SQL,
    "steps": """select series_id, value as y, row_number() over w as i, count(*) over (partition by series_id) as n,
                lag(value) over w as y1, lag(value, 2) over w as y2 from recent window w as (partition by series_id order by period)""",
    "sums": f"""select series_id, max(n) as n, stddev_pop(y) filter (i <= 15) as deviation, avg(abs(y)) filter (i <= 15) as magnitude,
                max(y) filter (i = 15) as last_y, max(y - y1) filter (i = 15) as last_step,
                {_ar_sums('level', 'y', 'y1')}, {_ar_sums('step', '(y - y1)', '(y1 - y2)')},
                list(y order by i) filter (i > 15 and i <= 19) as test from steps group by 1""",
    "chosen": f"""select series_id, magnitude, last_y, last_step, test, n >= 19 and deviation >= 1e-3 as enough,
                case when round({_aicc('level')}, 6) <= round({_aicc('step')}, 6) then 'level' else 'step' end as model,
                greatest(least(coalesce(phi_level, 0), 0.99e0), -0.99e0) as p, coalesce(c_level, m_level) as c,
                greatest(least(coalesce(phi_step, 0), 0.99e0), -0.99e0) as q, coalesce(c_step, m_step) as d from sums""",
    "errors": """select series_id, model, enough, magnitude, avg(abs(y - case when model = 'level'
                then last_y * pow(p, h) + c * (1 - pow(p, h)) / (1 - p)
                else last_y + h * d / (1 - q) + (last_step - d / (1 - q)) * q * (1 - pow(q, h)) / (1 - q) end)) as mae
                from (select *, unnest(test) as y, unnest(range(1, 5)) as h from chosen where enough) group by all""",
    "ar": f"""select c.series_id, case when coalesce(c.enough, false) then '' else 'Corta/plana' end as reason_ar, e.model, {r('mae')} as mae_ar, mae > 0.6 * e.magnitude as anomaly_ar
              from chosen c left join errors e using (series_id)""",
}


@query("ar_check", "select * from ar", ctes=AR)
def ar_check(v: Views) -> DataFrame:
    return T.ar_check(_trailing(v), 15, 4, 0.6)


def _elimination(n: int) -> dict[str, str]:
    """A symmetric system a (upper half), b of ``n`` unknowns solved by elimination, a table per step."""
    upper = [(i, j) for i in range(n) for j in range(i, n)]
    steps = {}
    for k in range(n - 1):
        cells = [f"a{i}{j} - a{k}{i} / a{k}{k} * a{k}{j} as a{i}{j}" if i > k else f"a{i}{j}" for i, j in upper]
        cells += [f"b{i} - a{k}{i} / a{k}{k} * b{k} as b{i}" if i > k else f"b{i}" for i in range(n)]
        steps[f"solve{k + 1}"] = f"select series_id, {', '.join(cells)} from solve{k}"
    source = f"solve{n - 1}"
    for i in range(n - 1, -1, -1):
        rest = " ".join(f"- a{i}{j} * w{j}" for j in range(i + 1, n))
        steps[f"back{i}"] = f"select *, (b{i} {rest}) / a{i}{i} as w{i} from {source}"
        source = f"back{i}"
    return steps


WAVE_TERMS = range(6)
WAVES = {
    "recent": TRAILING_SQL,
    "wave_arrays": """select series_id, list(value order by period) as y, count(*) as n,
        list(year(period) * 12e0 + month(period) order by period) as m from recent group by 1""",
    "wave_gate": """select *, n >= 19 and list_stddev_pop(y[1:15]) >= 1e-3 as enough,
        list_avg(list_transform(y[1:least(n, 15)], lambda e: abs(e))) as magnitude from wave_arrays""",
    "design": """select *, 1e0 as x0, (m - first_m) / greatest(last_m - first_m, 1) as x1, sin(2 * pi() * m / 12) as x2,
        cos(2 * pi() * m / 12) as x3, sin(4 * pi() * m / 12) as x4, cos(4 * pi() * m / 12) as x5
        from (select series_id, case when magnitude = 0 then 1 else magnitude end as scale, m[1] as first_m, m[15] as last_m,
                     unnest(y) as y, unnest(m) as m, generate_subscripts(y, 1) as i from wave_gate where enough)""",
    "solve0": "select series_id, " + ", ".join(
        [f"sum(x{i} * x{j}){' + 0.1e0' if i == j and i else ''} as a{i}{j}" for i in WAVE_TERMS for j in range(i, 6)]
        + [f"sum(x{i} * y / scale) as b{i}" for i in WAVE_TERMS]) + " from design where i <= 15 group by 1",
    **_elimination(6),
    "wave_errors": f"""select series_id, avg(abs(y - scale * ({' + '.join(f'w{i} * x{i}' for i in WAVE_TERMS)}))) as mae
        from design join back0 using (series_id) where i between 16 and 19 group by 1""",
    "waves": f"""select g.series_id, case when enough then '' else 'Corta/plana' end as reason_fourier, {r('mae')} as mae_fourier,
        mae > 0.6 * magnitude as anomaly_fourier, magnitude from wave_gate g left join wave_errors e using (series_id)""",
}


@query("fourier_check", "select series_id, reason_fourier, mae_fourier, anomaly_fourier from waves", ctes=WAVES)
def fourier_check(v: Views) -> DataFrame:
    return T.fourier_check(_trailing(v), 15, 4, 0.6)


BREAKS = 3
_BREAK_TERMS = ["1e0", "u", *[f"greatest(u - {T.BREAK_SHARE * k / (BREAKS + 1)!r}::double, 0)" for k in range(1, BREAKS + 1)],
                "sin(2 * pi() * m / 12)", "cos(2 * pi() * m / 12)", "sin(4 * pi() * m / 12)", "cos(4 * pi() * m / 12)"]
_BREAK_PENALTY = [0.0, 0.1, *[0.05] * BREAKS, *[0.1] * 4]
BENT = {
    **{name: WAVES[name] for name in ("recent", "wave_arrays", "wave_gate")},
    "timed": """select *, (m - first_m) / greatest(last_m - first_m, 1) as u from (
        select series_id, case when magnitude = 0 then 1 else magnitude end as scale, m[1] as first_m, m[15] as last_m,
               unnest(y) as y, unnest(m) as m, generate_subscripts(y, 1) as i from wave_gate where enough)""",
    "bent": "select series_id, scale, y, i, " + ", ".join(f"{x} as x{k}" for k, x in enumerate(_BREAK_TERMS)) + " from timed",
    "solve0": "select series_id, " + ", ".join(
        [f"sum(x{i} * x{j}) + {_BREAK_PENALTY[i] if i == j else 0.0!r}::double as a{i}{j}" for i in range(len(_BREAK_TERMS)) for j in range(i, len(_BREAK_TERMS))]
        + [f"sum(x{i} * y / scale) as b{i}" for i in range(len(_BREAK_TERMS))]) + " from bent where i <= 15 group by 1",
    **_elimination(len(_BREAK_TERMS)),
    "bent_errors": f"""select series_id, avg(abs(y - scale * ({' + '.join(f'w{i} * x{i}' for i in range(len(_BREAK_TERMS)))}))) as mae
        from bent join back0 using (series_id) where i between 16 and 19 group by 1""",
}


@query("fourier_breaks", f"""
    select g.series_id, case when enough then '' else 'Corta/plana' end as reason_fourier, {r('mae')} as mae_fourier,
           mae > 0.6 * magnitude as anomaly_fourier from wave_gate g left join bent_errors e using (series_id)""", ctes=BENT)
def fourier_breaks(v: Views) -> DataFrame:
    """A trend that may bend at three places."""
    return T.fourier_check(_trailing(v), 15, 4, 0.6, knots=BREAKS)


AR_ORDERS = ((0, 0, 0), (0, 1, 0), (1, 0, 0), (1, 1, 0))


def _order_aicc(p: int, tag: str) -> str:
    sse = f"greatest(syy_{tag} - coalesce(phi_{tag} * sxy_{tag}, 0), 1e-9)" if p else f"greatest(syy_{tag}, 1e-9)"
    k = p + 2
    return f"round(13 * ln({sse} / 13) + {2 * k} + {2.0 * k * (k + 1) / (13 - k - 1)!r}::double, 6)"


ORDERED = {
    "recent": TRAILING_SQL,
    "steps": AR["steps"],
    "fits": f"""select series_id, max(n) as n, stddev_pop(y) filter (i <= 15) as deviation, avg(abs(y)) filter (i <= 15) as magnitude,
        max(y) filter (i = 15) as last_y, max(y - y1) filter (i = 15) as last_step, list(y order by i) filter (i > 15 and i <= 19) as test,
        {', '.join(f'regr_slope({y}, {x}) filter (i between 3 and 15) as phi_{tag}, regr_intercept({y}, {x}) filter (i between 3 and 15) as c_{tag}, '
                   f'avg({y}) filter (i between 3 and 15) as m_{tag}, 13 * var_pop({y}) filter (i between 3 and 15) as syy_{tag}, '
                   f'regr_sxy({y}, {x}) filter (i between 3 and 15) as sxy_{tag}' for tag, y, x in (('level', 'y', 'y1'), ('step', '(y - y1)', '(y1 - y2)')))}
        from steps group by 1""",
    "scores": f"""select *, n >= 19 and deviation >= 1e-3 as enough, {_order_aicc(0, 'level')} as s0, {_order_aicc(0, 'step')} as s1,
        case when abs(phi_level) < 1 then {_order_aicc(1, 'level')} else 1e300 end as s2,
        case when abs(phi_step) < 1 then {_order_aicc(1, 'step')} else 1e300 end as s3 from fits""",
    "picked": """select *, list_position([s0, s1, s2, s3], least(s0, s1, s2, s3)) as o from scores""",
    "misses": """select series_id, avg(abs(y - case o when 1 then m_level when 2 then last_y + h * m_step
            when 3 then last_y * pow(phi_level, h) + c_level * (1 - pow(phi_level, h)) / (1 - phi_level)
            else last_y + h * c_step / (1 - phi_step) + (last_step - c_step / (1 - phi_step)) * phi_step * (1 - pow(phi_step, h)) / (1 - phi_step) end)) as mae
        from (select *, unnest(test) as y, unnest(range(1, 5)) as h from picked where enough) group by 1""",
}


@query("arima_orders", f"""
    select p.series_id, case when coalesce(enough, false) then '' else 'Corta/plana' end as reason_ar,
           case when enough then ['(0,0,0)', '(0,1,0)', '(1,0,0)', '(1,1,0)'][o] end as model, {r('mae')} as mae_ar, mae > 0.6 * magnitude as anomaly_ar
    from picked p left join misses using (series_id)""", ctes=ORDERED)
def arima_orders(v: Views) -> DataFrame:
    """The order search among those without a moving average, which SQL can fit."""
    return T.arima_check(_trailing(v), 15, 4, 0.6, orders=AR_ORDERS)


@query("arima_check")
def arima_check(v: Views) -> DataFrame:
    return T.arima_check(_trailing(v), 15, 4, 0.6)


CHECKS = {**ETS, **AR, **WAVES}
ERRORS = ("mae_ets", "mae_ar", "mae_fourier")


def _checks(v: Views, limit: float = 0.3) -> DataFrame:
    """The three checks side by side for every client."""
    rows = persist_table(_trailing(v))
    ets, ar = T.ets_check(rows, 15, 4, limit), T.ar_check(rows, 15, 4, limit)
    return ets.join(ar, "series_id", "full").join(T.fourier_check(rows, 15, 4, limit), "series_id", "full")


VOTES_SQL = """select e.*, a.reason_ar, a.model, a.mae_ar, w.reason_fourier, w.mae_fourier, mae_ar > 0.3 * g.magnitude as anomaly_ar,
        mae_fourier > 0.3 * g.magnitude as anomaly_fourier, mae_ets > 0.3 * g.magnitude as first_flag
    from ets e join gate g using (series_id) join ar a using (series_id) join waves w using (series_id)"""
COUNTED = "coalesce(first_flag, false)::int + coalesce(anomaly_ar, false)::int + coalesce(anomaly_fourier, false)::int"


@query("consensus_vote", f"""
    select series_id, first_flag as anomaly_ets, anomaly_ar, anomaly_fourier, {COUNTED} as votes, {COUNTED} >= 2 as anomaly_final
    from ({VOTES_SQL})""", ctes=CHECKS)
def consensus_vote(v: Views) -> DataFrame:
    """Two votes of three."""
    return T.consensus(_checks(v)).select("series_id", "anomaly_ets", "anomaly_ar", "anomaly_fourier", "votes", "anomaly_final")


@query("consensus_full", f"""
    select series_id, enough_data, reason, {r('alpha')} as alpha, {r('beta')} as beta, mae_ets, first_flag as anomaly_ets, reason_ar, model,
           mae_ar, anomaly_ar, reason_fourier, mae_fourier, anomaly_fourier, {COUNTED} as votes, {COUNTED} >= 2 as anomaly_final
    from ({VOTES_SQL}) where first_flag""", ctes=CHECKS)
def consensus_full(v: Views) -> DataFrame:
    """Gate by the first check, then all three votes."""
    return T.confirmed_anomalies(_trailing(v), first_limit=0.3, limit=0.3)


@query("forecast_ranking", """
    select series_id, mae_ets, mae_ar, mae_fourier, row_number() over (
        order by mae_ets desc nulls last, mae_ar desc nulls last, mae_fourier desc nulls last, series_id) as rank
    from ets join ar using (series_id) join waves using (series_id)""", ctes=CHECKS)
def forecast_ranking(v: Views) -> DataFrame:
    return T.forecast_ranking(_checks(v), ERRORS).select("series_id", *ERRORS, "rank")


# --- regimes and forest ---------------------------------------------------

@query("regime_test")
def regime_test(v: Views) -> DataFrame:
    return M.regime_test(v.panel())


@query("regime_fixed", """
    select series_id, case when count(value) >= 2 then cast(count(value) as int) end as months, case when count(value) >= 2 then true end as means_agree
    from fx_panel_nulls group by 1""")
def regime_fixed(v: Views) -> DataFrame:
    """What holds for any fit: a label for every value, and means that are those of the labelled values."""
    panel = persist_table(v.panel_nulls())
    found = M.regime_test(panel)
    values = ordered_arrays(panel, "value", "series_id", "period").select(
        "series_id", F.filter("values", lambda x: x.isNotNull()).alias("known"))
    rows = found.join(values, "series_id")
    close = F.expr("""forall(transform(regime_means, (m, k) -> struct(m, filter(known, (x, i) -> regimes[i] = k) as own)),
        s -> if(size(s.own) = 0, s.m is null, abs(aggregate(s.own, 0d, (a, x) -> a + x) / size(s.own) - s.m) < 1e-6))""")
    return rows.select("series_id", F.when(F.col("regimes").isNotNull(), F.size("regimes")).alias("months"), close.alias("means_agree"))


def _density_sql(k: int, share: str) -> str:
    return f"a{k} - 0.5 * (ln(2 * pi() * variance * {k + 1}) + (x - slope * {share} * t) ** 2 / (variance * {k + 1}))"


def _both_sql(x: str, y: str) -> str:
    return f"greatest({x}, {y}) + ln(exp(({x}) - greatest({x}, {y})) + exp(({y}) - greatest({x}, {y})))"


REGIMES = {
    "known": """select series_id, value as x, row_number() over (partition by series_id order by period) as t,
                avg(value) over w / ((count(*) over w + 1) / 2) as slope, var_pop(value) over w + 1 as variance
                from fx_panel_nulls where value is not null window w as (partition by series_id)""",
    "folded": f"""select series_id, 0 as t, ln(0.5e0) as a0, ln(0.5e0) as a1, 0e0 as ll, 0 as n from (select distinct series_id from known)
        union all
        select series_id, t, {_both_sql('low + ln(0.9e0)', 'high + ln(0.1e0)')}, {_both_sql('low + ln(0.1e0)', 'high + ln(0.9e0)')}, ll + total, n + (high > low)::int
        from (select *, j0 - total as low, j1 - total as high from (select *, {_both_sql('j0', 'j1')} as total from (
            select f.series_id, k.t, ll, n, {_density_sql(0, '0.5e0')} as j0, {_density_sql(1, '1.5e0')} as j1
            from (select series_id, t as before, a0, a1, ll, n from folded) f join known k on k.series_id = f.series_id and k.t = before + 1)))""",
}


@query("regime_likelihood", f"""
    select series_id, {r('arg_max(ll, t)', 4)} as log_likelihood, cast(arg_max(n, t) as int) as months_second from folded group by 1""", digits=4, ctes=REGIMES)
def regime_likelihood(v: Views) -> DataFrame:
    """The forward filter with parameters that the series itself fixes, so that SQL can repeat it."""
    ordered = F.sort_array(F.collect_list(F.struct("period", "value")))["value"].alias("values")
    known = v.panel_nulls().filter(F.col("value").isNotNull()).groupBy("series_id").agg(
        ordered, F.avg("value").alias("mean"), (F.var_pop("value") + 1).alias("variance"), F.count("*").alias("n"))
    # written down: a fold would compute its parameters anew at every step
    rows = persist_table(known.select("series_id", "values", (F.col("mean") / ((F.col("n") + 1) / 2)).alias("slope"), "variance"))
    found = M.regime_filter(spread(rows, "series_id"), [F.col("slope") * 0.5, F.col("slope") * 1.5], [F.col("variance"), F.col("variance") * 2])
    return found.select("series_id", "log_likelihood", "months_second")


def _client_features(v: Views) -> DataFrame:
    """A few shape features per client with its group attributes."""
    panel = persist_table(v.group_panel())
    s = persist_table(X.index_series(panel))
    # one aggregate; what is not asked for is pruned; rounded, so that equal shapes are equal in any engine
    table = X.single_pass(s).select("series_id", *[fixed(F.col(c)).alias(c) for c in FOREST_FEATURES])
    return table.join(panel.select("series_id", "category", "zone").distinct(), "series_id")


FOREST_FEATURES = ["variation_coefficient", "cid_ce_normalised", "absolute_sum_of_changes",
                   "mean_second_derivative_central", "trend_slope", "trend_r"]


def _forest(v: Views) -> DataFrame:
    return I.isolation_forest(_client_features(v), FOREST_FEATURES, ["category"], min_size=25)


def _path_sql(n: str) -> str:
    return f"case when {n} > 2 then 2 * (ln({n} - 1) + {I.EULER!r}) - 2e0 * ({n} - 1) / {n} when {n} = 2 then 1 else 0 end"


def _forest_sql(seed: int = 42) -> dict[str, str]:
    """The forest in SQL: rows of all trees go down a level in each round of a recursion."""
    number = lambda text, at: f"cast('0x' || md5({text})[{at}:{at + 7}] as bigint)"
    per = lambda f: ", ".join(f(k) for k in range(1, len(FOREST_FEATURES) + 1))
    ends = [f"[{per(lambda k: f'{end}(xs[{k}]) filter (where sampled) over w')}]" for end in ("min", "max")]
    return {
        "s": """select series_id, value as x, row_number() over (partition by series_id order by period) - 1 as t, count(*) over (partition by series_id) as n,
                value - lag(value) over (partition by series_id order by period) as d, stddev_pop(value) over (partition by series_id) as std
                from fx_group_panel where value is not null""",
        "shape": """select series_id, [stddev_pop(x) / nullif(avg(x), 0), coalesce(sqrt(sum(d * d)) / nullif(max(std), 0), 0), sum(abs(d)),
                    (max(x) filter (t = n - 1) - max(x) filter (t = n - 2) - max(x) filter (t = 1) + max(x) filter (t = 0)) / nullif(2 * (max(n) - 2), 0),
                    case when max(n) > 1 then regr_slope(x, t) end, case when max(n) > 1 and max(std) > 0 then corr(x, t) end] as raw from s group by 1""",
        "clients": """select series_id, category, count(*) over (partition by category) as n,
                      list_transform(raw, lambda v: coalesce(case when isfinite(v) then round(v, 6) + 0e0 end, 0)) as xs
                      from shape join (select distinct series_id, category from fx_group_panel where category is not null) using (series_id)""",
        "trees": f"""select t, 1 + {number(f"'{seed}:tree:' || t", 1)} % {I.PRIME - 1} as m, {number(f"'{seed}:tree:' || t", 9)} % {I.PRIME} as c
                     from range({I.TREES}) g(t)""",
        "placed": f"""select series_id, category, n, xs, t, ({number(f"'{seed}:' || series_id", 1)} % {I.PRIME} * m + c) % {I.PRIME} as place
                      from clients, trees where n >= 25""",
        "drawn": f"""select *, n <= {I.PSI} or (place / {float(I.PRIME)} < least(1, {float(I.DRAW)} / n) and
                     row_number() over (partition by category, t, place / {float(I.PRIME)} < least(1, {float(I.DRAW)} / n) order by place, series_id) <= {I.PSI})
                     as sampled from placed""",
        "nodes": f"""select t, node, {number(f"'{seed}:' || t || ':' || node", 1)} / 4294967296e0 as u, {number(f"'{seed}:' || t || ':' || node", 9)} / 4294967296e0 as v
                     from range({I.TREES}) g(t), range({2 ** math.ceil(math.log2(I.PSI)) - 1}) h(node)""",
        "down": f"""select series_id, category, t, sampled, xs, 0 as level, 0 as node, least(n, {I.PSI}) as psi, cast(null as double) as path from drawn
            union all
            select series_id, category, t, sampled, xs, level + 1, 2 * node + 1 + (f > 0 and xs[greatest(f, 1)] > threshold)::int, psi,
                   case when f = 0 then level + {_path_sql('size')} end from (
                select *, case when point >= high[greatest(f, 1)] then low[greatest(f, 1)] else point end as threshold from (
                    select *, low[greatest(f, 1)] + v * (high[greatest(f, 1)] - low[greatest(f, 1)]) as point from (
                        select r.*, d.v, case when len(free) = 0 or level >= ceil(log2(greatest(psi, 2))) then 0 else free[1 + cast(floor(d.u * len(free)) as bigint)] end as f
                        from (select *, list_filter(range(1, {len(FOREST_FEATURES) + 1}), lambda k: high[k] > low[k]) as free from (
                                select *, {ends[0]} as low, {ends[1]} as high, count(*) filter (where sampled) over w as size from down where path is null
                                window w as (partition by category, t, node))) r
                        left join nodes d on d.t = r.t and d.node = r.node)))""",
        "raw": f"""select series_id, category, -pow(2, -avg(path) / {_path_sql('max(psi)')}) as raw from down where path is not null group by 1, 2""",
        "cut": "select category, quantile_cont(raw, 0.05) as cut from raw group by 1",
        "scored": """select series_id, category, raw - cut as anomaly_score, case when max(raw) over w > min(raw) over w
                     then (max(raw) over w - raw) / (max(raw) over w - min(raw) over w) else 0 end as scaled
                     from raw join cut using (category) window w as (partition by category)""",
    }


@query("isolation_forest", f"""
    select series_id, category, {r('anomaly_score')} as anomaly_score, {r('scaled')} as anomaly_score_scaled, (anomaly_score < 0)::int as anomaly_bin
    from scored""", ctes=_forest_sql())
def isolation_forest(v: Views) -> DataFrame:
    return _forest(v)


@query("forest_fixed", """
    select category, count(distinct series_id) as clients, 0e0 as lowest, 1e0 as highest
    from fx_group_panel where category is not null group by 1 having count(distinct series_id) >= 25""")
def forest_fixed(v: Views) -> DataFrame:
    """What holds for any forest: who is scored, and the scaled range of each group."""
    return _forest(v).groupBy("category").agg(
        F.count("*").alias("clients"), F.min("anomaly_score_scaled").alias("lowest"), F.max("anomaly_score_scaled").alias("highest"))


@query("isolation_ranking", f"""
    select series_id, category, {r('anomaly_score')} as anomaly_score, {r('scaled')} as anomaly_score_scaled, (anomaly_score < 0)::int as anomaly_bin,
           row_number() over (order by round(scaled, 6) + 0e0 desc, series_id) as rank from scored""", ctes=_forest_sql())
def isolation_ranking(v: Views) -> DataFrame:
    return I.forest_ranking(_forest(v))


@query("client_results", """
    select coalesce(p.series_id, c.series_id, f.series_id) as series_id, i.reason, i.invalid, c.cusum_pval, c.rank_cusum, f.mae_ets, f.mae_ar, f.mae_fourier, f.rank_forecast
    from (select distinct series_id from fx_panel_nulls) p
    left join (select series_id, string_agg(reason, '; ' order by reason) as reason, 1 as invalid from invalid group by 1) i using (series_id)
    full join (select series_id, cusum_pval, row_number() over (order by cusum_pval nulls last, series_id) as rank_cusum from cusum) c
        on p.series_id = c.series_id
    full join (select series_id, mae_ets, mae_ar, mae_fourier, row_number() over (
                   order by mae_ets desc nulls last, mae_ar desc nulls last, mae_fourier desc nulls last, series_id) as rank_forecast
               from ets join ar using (series_id) join waves using (series_id)) f on coalesce(p.series_id, c.series_id) = f.series_id""",
       ctes={**GAPLESS, **CHECKS, "invalid": INVALID_SQL})
def client_results(v: Views) -> DataFrame:
    panel = v.panel_nulls()
    return C.client_results(
        panel, Q.invalid_series(panel),
        cusum=D.cusum_ranking(_cusum(v)).select("series_id", "cusum_pval", "rank"),
        forecasts=T.forecast_ranking(_checks(v), ERRORS).select("series_id", *ERRORS, "rank"))


#: The yearly panel with every third year of some clients missing and some flat.
GAPS_SQL = """select series_id, period, case when series_id % 6 = 2 and period % 3 < 2 then null
              when series_id % 11 = 3 then 7e0 else value end as value from fx_group_panel"""


def _with_gaps(v: Views) -> DataFrame:
    value = (F.when((F.col("series_id") % 6 == 2) & (F.col("period") % 3 < 2), None)
             .when(F.col("series_id") % 11 == 3, F.lit(7.0)).otherwise(F.col("value")))
    return v.group_panel().select("series_id", "period", value.alias("value"))


@query("client_results_gaussian", f"""
    select c.c_custkey as series_id, i.reason, i.invalid, g.fraud_score, g.density, g.year_month, g.rank as rank_gaussian,
           {r('f.anomaly_score')} as anomaly_score, {r('f.scaled')} as anomaly_score_scaled, (f.anomaly_score < 0)::int as anomaly_bin, f.place as rank_forest
    from customer c left join (
        select series_id, string_agg(reason, '; ' order by reason) as reason, 1 as invalid from gap_reasons group by 1) i
        on c.c_custkey = i.series_id
    left join gauss_rank g on c.c_custkey = g.series_id
    left join (select *, row_number() over (order by round(scaled, 6) + 0e0 desc, series_id) as place from scored) f on c.c_custkey = f.series_id""",
       ctes={**GAUSS, "gaps": GAPS_SQL, "gap_reasons": INVALID_SQL.replace("fx_panel_nulls", "gaps"), **_forest_sql()})
def client_results_gaussian(v: Views) -> DataFrame:
    """Group ranking and forest of the same clients side by side, with the reasons for exclusion."""
    clients = v.t("customer").select(F.col("c_custkey").alias("series_id"))
    ranked = I.forest_ranking(_forest(v)).drop("category")
    return C.client_results(clients, Q.invalid_series(_with_gaps(v)), gaussian=gaussian(v), forest=ranked)
