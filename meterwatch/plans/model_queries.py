"""Supervised models, ranking evaluation, segments and economics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwatch.operators import bagging as BG
from meterwatch.operators import boosting as G
from meterwatch.operators import classifiers as B
from meterwatch.operators import economics as K
from meterwatch.operators import evaluation as E
from meterwatch.operators import kmodes as KM
from meterwatch.operators import labels as L
from meterwatch.plans.registry import query, r, rounded
from meterwatch.plans.views import Views
from meterwatch.session import persist_table

CATEGORIES = ["category", "zone"]


# --- supervised -----------------------------------------------------------

def _labelled(v: Views) -> DataFrame:
    return v.group_panel().join(v.truth(), "series_id")


def _features(v: Views) -> DataFrame:
    return B.supervised_features(_labelled(v), CATEGORIES)


FEATURES_SQL = f"""
    with p as (select g.*, t.label, row_number() over w - 1 as t, lag(value) over w as prev
               from fx_group_panel g join fx_truth t using (series_id) window w as (partition by series_id order by period))
    select series_id, category, zone, label, {r('avg(value)', 4)} as mean, {r('stddev_pop(value)', 4)} as std,
           {r('min(value)', 4)} as min, {r('max(value)', 4)} as max, {r('arg_max(value, period)', 4)} as last,
           {r('avg(coalesce(value / prev - 1, 0))', 4)} as pct_mean,
           {r('stddev_pop(coalesce(value / prev - 1, 0))', 4)} as pct_std,
           {r('case when count(*) > 1 then regr_slope(value, t) else 0 end', 4)} as trend
    from p group by all"""


@query("supervised_features", "select * from features", digits=4, ctes={"features": FEATURES_SQL})
def supervised_features(v: Views) -> DataFrame:
    return _features(v)


@query("encode_features", f"""
    select series_id, cast({len(B.NUMERIC)} + (select count(distinct category) from features)
           + (select count(distinct zone) from features) as int) as width, 2e0 as ones from features""", ctes={"features": FEATURES_SQL})
def encode_features(v: Views) -> DataFrame:
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    rows = B.prepare(_features(v), B.NUMERIC, CATEGORIES)
    encoded = Pipeline(stages=B.encoder(B.NUMERIC, CATEGORIES)).fit(rows).transform(rows)
    values = vector_to_array("features")
    return encoded.select("series_id", F.size(values).alias("width"),
                          F.aggregate(F.slice(values, F.lit(len(B.NUMERIC) + 1), F.size(values)), F.lit(0.0), lambda s, x: s + x).alias("ones"))


SPLIT_SQL = """
    select series_id, label, row_number() over (partition by label order by md5(cast(series_id as varchar)), series_id) * 1000
           <= count(*) over (partition by label) * 800 as train
    from fx_truth"""


@query("stratified_split", SPLIT_SQL)
def stratified_split(v: Views) -> DataFrame:
    return B.stratified_split(v.truth())


def _validated(v: Views, kind: str) -> DataFrame:
    """Fit on the training part, score the other part; features are rounded, so that any engine sorts them alike."""
    rows = B.stratified_split(rounded(_features(v), 4))
    model = B.train(rows.filter("train"), kind, categories=CATEGORIES)
    return B.score(model, rows.filter("not train")).select("series_id", "label", "score")


def _edges_sql(bins: int) -> dict[str, str]:
    """Cut points of ``numbers`` (f, x): all values if there are few, else every ``bins``-th share of the rows."""
    few = f"select f from numbers group by f having count(distinct x) <= {bins}"
    return {
        "edges": f"""select distinct f, x from (select f, x, row_number() over (partition by f order by x) as n, count(*) over (partition by f) as m from numbers)
                  join range(1, {bins + 1}) g(k) on n = (m * k + {bins - 1}) // {bins} where f not in ({few})
                  union select distinct f, x from numbers where f in ({few})""",
        "cuts": "select f, x from edges e where x < (select max(x) from edges o where o.f = e.f)",
    }


def _cells_sql() -> dict[str, str]:
    """The bin of every feature of every row of ``base``."""
    k = len(B.NUMERIC)
    return {
        "codes": f"""select {k} as f, category as v, row_number() over (order by category) - 1 as bin from (select distinct category from base where train)
                     union all select {k + 1}, zone, row_number() over (order by zone) - 1 from (select distinct zone from base where train)""",
        "cells": f"""select series_id, list(bin order by f) as cells from (
            select series_id, f, (select count(*) from cuts where cuts.f = g.f and cuts.x < b.x[g.f + 1]) as bin from base b, range({k}) g(f)
            union all select series_id, {k}, coalesce(bin, -1) from base left join codes on codes.f = {k} and v = category
            union all select series_id, {k + 1}, coalesce(bin, -1) from base left join codes on codes.f = {k + 1} and v = zone) group by 1""",
    }


def _boosted_sql(grow: G.Growth) -> dict[str, str]:
    """A recursion that splits all nodes of a level in a round, or the best leaf of all, and adds leaf values in the round after the last."""
    k, trees, depth = len(B.NUMERIC), grow.trees, grow.depth if grow.leaves is None else grow.leaves - 1
    part = lambda g, h: f"{g} * {g} / 16777216 / greatest({h}, 1)"
    return {
        "features": FEATURES_SQL,
        "base": f"""select *, [{', '.join(B.NUMERIC)}] as x, row_number() over (partition by label order by md5(cast(series_id as varchar)), series_id) * 1000
                    <= count(*) over (partition by label) * 800 as train from features""",
        "numbers": f"select f, x[f + 1] as x from base, range({k}) g(f) where train",
        **_edges_sql(255),
        **_cells_sql(),
        "boost": f"""select 0 as step, series_id, label, train, cells, cast(1 as bigint) as node,
                   ln(sum(label) filter (train) over () / (count(*) filter (train) over () - sum(label) filter (train) over ())) as score
                   from base join cells using (series_id)
            union all
            select step + 1, series_id, label, train, cells,
                   case when step % {depth + 1} = {depth} then 1 when f is null then r.node
                        when (f < {k} and cells[f + 1] > bin) or (f >= {k} and cells[f + 1] = bin) then 2 * r.node + 1 else 2 * r.node end,
                   case when step % {depth + 1} = {depth} then score - 0.1 * tg / greatest(th, 1) else score end
            from (select * from boost where step < {trees * (depth + 1)}) r left join (
                select node, tg, th, bin, {'f' if grow.leaves is None else 'case when row_number() over (order by gain desc nulls last, node) = 1 then f end as f'} from (
                select node, max(gain) as gain, any_value(tg) as tg, any_value(th) as th, first(case when gain > {G.LEAST_GAIN} then f end order by gain desc nulls last, f, bin) as f,
                       first(bin order by gain desc nulls last, f, bin) as bin from (
                    select *, case when least(c, tc - c) >= {grow.min_rows} and least(h, th - h) >= {grow.min_curvature * G.GRAIN!r} then
                           {part('g', 'h')} + {part('(tg - g)', '(th - h)')} - {part('tg', 'th')} end as gain from (
                        select node, f, bin, sum(g) over a as tg, sum(h) over a as th, sum(c) over a as tc,
                               case when f < {k} then sum(g) over a - sum(g) over w else g end as g, case when f < {k} then sum(h) over a - sum(h) over w else h end as h,
                               case when f < {k} then sum(c) over a - sum(c) over w else c end as c from (
                            select node, f, bin, sum(round((p - label) * 16777216)) as g, sum(round(p * (1 - p) * 16777216)) as h, count(*) as c from (
                                select node, label, 1 / (1 + exp(-score)) as p, unnest(cells) as bin, generate_subscripts(cells, 1) - 1 as f
                                from boost where train and step < {trees * (depth + 1)}) group by all)
                        window a as (partition by node, f), w as (partition by node, f order by bin))) group by node)) b on b.node = r.node""",
    }


@query("gbt_scores", f"select series_id, label, {r('1 / (1 + exp(-score))')} as score from boost where step = {B.TREES * 4} and not train", ctes=_boosted_sql(B.boosting_growth("gbt", B.TREES)))
def gbt_scores(v: Views) -> DataFrame:
    return _validated(v, "gbt")


def _forest_sql(features: str, train: str, bag: BG.Bagging) -> dict[str, str]:
    """Trees of full depth: rows of all trees go down a level in each round of a recursion."""
    k, prime = len(B.NUMERIC), BG.PRIME
    number = lambda text, at: f"cast('0x' || md5({text})[{at}:{at + 7}] as bigint)"
    part = lambda s, w: f"cast({s} as double) * {s} / greatest({w}, 1)"
    weight = " + ".join(f"(place / {float(prime)} >= {float(x)!r}::double)::int" for x in BG._WEIGHTS)
    keys = BG.scrambles(0, "feature", k + 2)
    key = "case f " + " ".join(f"when {f} then (path * {m} + {c}) % {prime}" for f, (m, c) in enumerate(keys)) + " end"
    tried = max(1, int((k + 2) ** 0.5))
    return {
        "features": features,
        "base": f"select *, [{', '.join(B.NUMERIC)}] as x, {train} as train from features",
        "numbers": f"select f, x[f + 1] as x from base, range({k}) g(f) where train",
        **_edges_sql(bag.bins),
        **_cells_sql(),
        "trees": f"""select t, 1 + {number(f"'{bag.seed}:bag' || t || ':0'", 1)} % {prime - 1} as m, {number(f"'{bag.seed}:bag' || t || ':0'", 9)} % {prime} as c,
                     {number(f"'{bag.seed}:root:' || t", 9)} % {prime} as path from range({bag.trees}) g(t)""",
        "placed": f"""select t, path, series_id, label, cells, train, ({number('cast(series_id as varchar)', 1)} % {prime} * m + c) % {prime} as place
                      from base join cells using (series_id), trees""",
        "down": f"""select t, cast(1 as bigint) as node, path, series_id, label, cells, case when train then {weight} else 0 end as w, cast(null as double) as leaf from placed
            union all
            select r.t, case when f is null then r.node when high then 2 * r.node + 1 else 2 * r.node end,
                   case when high then (r.path * {BG.STEPS[1][0]} + {BG.STEPS[1][1]}) % {prime} else (r.path * {BG.STEPS[0][0]} + {BG.STEPS[0][1]}) % {prime} end,
                   series_id, label, cells, w, case when f is null then ty / tw end from (
                select d.*, b.f, b.ty, b.tw, case when b.f < {k} then d.cells[b.f + 1] > b.bin else d.cells[b.f + 1] = b.bin end as high
                from (select * from down where leaf is null) d join (
                    select t, node, any_value(ty) as ty, any_value(tw) as tw, first(case when gain > 1e-9 then f end order by rank, gain desc nulls last, f, bin) as f,
                           first(bin order by rank, gain desc nulls last, f, bin) as bin from (
                        select *, case when gain > 1e-9 and place <= {tried} then 0 else 1 end as rank from (
                            select *, dense_rank() over (partition by t, node order by {key}) as place,
                                   case when ty > 0 and ty < tw and tw >= {2 * bag.min_rows} and least(hw, tw - hw) >= {bag.min_rows}
                                        then {part('hy', 'hw')} + {part('(ty - hy)', '(tw - hw)')} - {part('ty', 'tw')} end as gain from (
                                select t, node, path, f, bin, sum(y) over a as ty, sum(w) over a as tw, case when f < {k} then sum(y) over a - sum(y) over o else y end as hy,
                                       case when f < {k} then sum(w) over a - sum(w) over o else w end as hw from (
                                    select t, node, path, f, bin, sum(w * label) as y, sum(w) as w from (
                                        select t, node, path, w, label, unnest(cells) as bin, generate_subscripts(cells, 1) - 1 as f from down where leaf is null and w > 0)
                                    group by all) window a as (partition by t, node, f), o as (partition by t, node, f order by bin))))
                    group by t, node) b on b.t = d.t and b.node = d.node) r""",
        "voted": "select series_id, any_value(label) as label, avg(leaf) as score from down where leaf is not null group by 1",
    }


SPLIT_TEST = """row_number() over (partition by label order by md5(cast(series_id as varchar)), series_id) * 1000 <= count(*) over (partition by label) * 800"""
EVERYONE_SQL = FEATURES_SQL.replace("from fx_group_panel g join fx_truth t", "from fx_group_panel g left join fx_truth t")


@query("rf_scores", f"select v.series_id, v.label, {r('score')} as score from voted v join base b using (series_id) where not train",
       ctes=_forest_sql(FEATURES_SQL, SPLIT_TEST, BG.Bagging(trees=B.TREES)))
def rf_scores(v: Views) -> DataFrame:
    return _validated(v, "forest")


@query("gbt_deep_scores", f"select series_id, label, {r('1 / (1 + exp(-score))')} as score from boost where step = {B.TREES * 31} and not train",
       ctes=_boosted_sql(B.boosting_growth("gbt_deep", B.TREES)))
def gbt_deep_scores(v: Views) -> DataFrame:
    return _validated(v, "gbt_deep")


@query("held_out_rows", """
    select series_id, label, true as in_range from (
        select series_id, label, row_number() over (partition by label order by md5(cast(series_id as varchar)), series_id) * 1000
               > count(*) over (partition by label) * 800 as held_out from features) where held_out""", ctes={"features": FEATURES_SQL})
def held_out_rows(v: Views) -> DataFrame:
    """Which rows a fitted model scores, with the labels it does not see, and that each has a probability."""
    rows = B.stratified_split(_features(v))
    model = B.train(rows.filter("train"), "gbt", categories=CATEGORIES, trees=5)
    scored = B.score(model, rows.filter("not train"))
    return scored.select("series_id", "label", F.coalesce(F.col("score").between(0, 1), F.lit(False)).alias("in_range"))


STUMP_BINS, STUMP_TREES = 16, 4


def _stumps_sql() -> dict[str, str]:
    """Boosted trees of one level, a round per block of tables."""
    steps = {
        "base": """select *, row_number() over (partition by label order by md5(cast(series_id as varchar)), series_id) * 1000
                   <= count(*) over (partition by label) * 800 as train from (
            select t.series_id, t.label, c.c_acctbal as x0, cast(c.c_nationkey as double) as x1, p.category, p.zone
            from fx_truth t join customer c on c.c_custkey = t.series_id
            join (select distinct series_id, category, zone from fx_group_panel) p on p.series_id = t.series_id)""",
        "numbers": "select 0 as f, x0 as x from base where train union all select 1, x1 from base where train",
        **_edges_sql(STUMP_BINS),
        "codes": """select 2 as f, category as v, row_number() over (order by category) - 1 as bin from (select distinct category from base where train)
                    union all select 3, zone, row_number() over (order by zone) - 1 from (select distinct zone from base where train)""",
        "cells": """select series_id, 0 as f, (select count(*) from cuts where f = 0 and cuts.x < b.x0) as bin from base b
                    union all select series_id, 1, (select count(*) from cuts where f = 1 and cuts.x < b.x1) from base b
                    union all select series_id, 2, coalesce(bin, -1) from base left join codes on codes.f = 2 and v = category
                    union all select series_id, 3, coalesce(bin, -1) from base left join codes on codes.f = 3 and v = zone""",
        "s0": """select series_id, label, train, ln(sum(label) filter (train) over () / (count(*) filter (train) over () - sum(label) filter (train) over ())) as score
                 from base""",
    }
    for k in range(STUMP_TREES):
        steps |= {
            f"g{k}": f"""select *, round((p - label) * 16777216) as g, round(p * (1 - p) * 16777216) as h
                         from (select *, 1 / (1 + exp(-score)) as p from s{k} where train)""",
            f"h{k}": f"select f, bin, sum(g) as g, sum(h) as h, count(*) as c from cells join g{k} using (series_id) group by 1, 2",
            f"t{k}": f"select sum(g) as tg, sum(h) as th, count(*) as tc from g{k}",
            f"r{k}": f"""select f, bin, tg, th, tc, case when f < 2 then tg - sum(g) over w else g end as g, case when f < 2 then th - sum(h) over w else h end as h,
                         case when f < 2 then tc - sum(c) over w else c end as c from h{k}, t{k} window w as (partition by f order by bin)""",
            f"b{k}": f"""select * from (select *, g * g / 16777216 / greatest(h, 1) + (tg - g) * (tg - g) / 16777216 / greatest(th - h, 1)
                                        - tg * tg / 16777216 / greatest(th, 1) as gain from r{k} where c > 0 and c < tc) order by gain desc, f, bin limit 1""",
            f"s{k + 1}": f"""select s.series_id, label, train, score + case when case when b.f < 2 then l.bin > b.bin else l.bin = b.bin end
                             then -0.1 * g / h else -0.1 * (tg - g) / (th - h) end as score
                             from s{k} s, b{k} b join cells l on l.f = b.f where l.series_id = s.series_id""",
        }
    return steps


@query("boosted_stumps", f"select series_id, label, {r('1 / (1 + exp(-score))')} as score from s{STUMP_TREES} where not train", ctes=_stumps_sql())
def boosted_stumps(v: Views) -> DataFrame:
    """The boosting engine with trees of one level: bins, gradients, gains, categories and leaf values against SQL."""
    profile = v.t("customer").select(F.col("c_custkey").alias("series_id"), F.col("c_acctbal").alias("x0"), F.col("c_nationkey").cast("double").alias("x1"))
    rows = v.truth().join(profile, "series_id").join(v.group_panel().select("series_id", *CATEGORIES).distinct(), "series_id")
    rows = persist_table(B.stratified_split(rows))
    model = G.fit_boosted(rows.filter("train"), G.Growth(trees=STUMP_TREES, depth=1, bins=STUMP_BINS), ["x0", "x1"], CATEGORIES, "label", ["series_id"])
    return model.score(rows.filter("not train")).select("series_id", "label", "score")


@query("score_all", f"select series_id, {r('score')} as score from voted", ctes=_forest_sql(EVERYONE_SQL, "label is not null", BG.Bagging(trees=B.TREES)))
def score_all(v: Views) -> DataFrame:
    """Every client of the panel gets a probability, labelled or not."""
    model = B.train(rounded(_features(v), 4), "forest", categories=CATEGORIES)
    everyone = rounded(B.supervised_features(v.group_panel(), CATEGORIES, label=None), 4)
    return B.score(model, everyone).select("series_id", "score")


ROC = {
    "by_score": """select score, count(*) filter (label = 1) as pos, count(*) filter (label = 0) as neg from fx_scores group by 1""",
    "running": """select *, sum(pos) over (order by score desc) as tp, sum(neg) over (order by score desc) as fp,
                  sum(pos) over () as p, sum(neg) over () as n from by_score""",
}


@query("roc_auc", f"select {r('sum(neg * (tp - pos / 2)) / (max(p) * max(n))')} as auc from running", ctes=ROC)
def roc_auc(v: Views) -> DataFrame:
    return B.roc_auc(v.scores())


@query("roc_curve", f"select {r('score')} as threshold, {r('fp / n')} as fpr, {r('tp / p')} as tpr from running", ctes=ROC)
def roc_curve(v: Views) -> DataFrame:
    return B.roc_curve(v.scores())


@query("trapezoid_area", f"""
    select {r('sum((x - px) * (y + py) / 2)')} as area from (
        select x, y, coalesce(lag(x) over (order by x, y), 0) as px, coalesce(lag(y) over (order by x, y), 0) as py
        from (select fp / n as x, tp / p as y from running))""", ctes=ROC)
def trapezoid_area(v: Views) -> DataFrame:
    return B.trapezoid_area(B.roc_curve(v.scores()))


MATRIX = {"matrix": "select label, (score >= 0.5)::int as predicted, count(*) as count from fx_scores group by 1, 2"}


@query("confusion_matrix", "select * from matrix", ctes=MATRIX)
def confusion_matrix(v: Views) -> DataFrame:
    return B.confusion_matrix(v.scores())


@query("classification_report", f"""
    select class, {r('precision')} as precision, {r('recall')} as recall, {r('f1')} as f1, cast(support as bigint) as support from (
        select cast(c as varchar) as class, precision, recall, f1, support from measures
        union all select 'accuracy', a, a, a, n from (select sum(hit) / sum(support) as a, sum(support) as n from measures)
        union all select 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) from measures
        union all select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                         sum(f1 * support) / sum(support), sum(support) from measures)""",
       ctes={**MATRIX, "measures": """
    select *, 2 * precision * recall / (precision + recall) as f1 from (
        select c, hit / predicted as precision, hit / support as recall, support, hit from (
            select c, sum(count) filter (label = c and predicted = c) as hit, sum(count) filter (predicted = c) as predicted,
                   sum(count) filter (label = c) as support from matrix, (values (0), (1)) v(c) group by 1))"""})
def classification_report(v: Views) -> DataFrame:
    return B.classification_report(B.confusion_matrix(v.scores()))


# --- rankings -------------------------------------------------------------

HITS = {
    "hits": """select *, sum(hit) over (partition by detector order by rank) as hits from (
        select k.detector, k.series_id, k.score, row_number() over (partition by k.detector order by k.score desc, k.series_id) as rank,
               coalesce(t.label, 0) as hit
        from fx_ranking k left join (select * from fx_truth where label = 1) t on k.series_id = t.series_id)""",
    "rel": "select count(*) as n from fx_truth where label = 1",
}


def _hits(v: Views) -> DataFrame:
    return E.ranked_hits(v.ranking(), v.truth())


@query("precision_at_k", f"select detector, {r('sum(hit) filter (rank <= 100) / 100')} as precision from hits group by 1", ctes=HITS)
def precision_at_k(v: Views) -> DataFrame:
    return E.precision_at_k(_hits(v), 100)


@query("recall_at_k", f"select detector, {r('sum(hit) filter (rank <= 100) / max(n)')} as recall from hits, rel group by 1", ctes=HITS)
def recall_at_k(v: Views) -> DataFrame:
    return E.recall_at_k(_hits(v), 100, E.count_relevant(v.truth()))


@query("average_precision", f"""
    select detector, {r('sum(hits / rank) filter (hit = 1) / max(n)')} as ap from hits, rel group by 1""", ctes=HITS)
def average_precision(v: Views) -> DataFrame:
    return E.average_precision(_hits(v), E.count_relevant(v.truth()))


@query("pr_curve", f"""
    select detector, rank as k, {r('hits / rank')} as precision, {r('hits / n')} as recall from hits, rel where rank % 10 = 0""", ctes=HITS)
def pr_curve(v: Views) -> DataFrame:
    return E.pr_curve(_hits(v), E.count_relevant(v.truth()), 10)


def _summary_sql(relevant: str) -> str:
    return f"""
    select h.detector, cast(h.rank as bigint) as k, {r('h.hits / h.rank')} as precision_at_k,
           {r(f'h.hits / {relevant}')} as recall_at_k, {r(f'a.gain / {relevant}')} as ap
    from hits h join (select detector, max(rank) as n, sum(hits / rank) filter (hit = 1) as gain, max(hits) as found from hits group by 1) a
    using (detector), rel
    where h.rank in (50, 100, 500, 1000, 2000, 3000, 4000, 5000)
    union all
    select h.detector, cast(h.rank as bigint), {r('h.hits / h.rank')}, {r(f'h.hits / {relevant}')}, {r(f'a.gain / {relevant}')}
    from hits h join (select detector, max(rank) as n, sum(hits / rank) filter (hit = 1) as gain, max(hits) as found from hits group by 1) a
    using (detector), rel where h.rank = a.n"""


@query("ranking_summary", _summary_sql("rel.n"), ctes=HITS)
def ranking_summary(v: Views) -> DataFrame:
    return E.ranking_summary(_hits(v), E.count_relevant(v.truth()))


HEAD = {
    "head": """select * from (select detector, k.series_id, row_number() over (partition by detector order by score desc, k.series_id) as rank,
               t.label as hit from fx_ranking k join fx_truth t on k.series_id = t.series_id) where rank <= 5000""",
    "hits": "select *, sum(hit) over (partition by detector order by rank) as hits from head",
    "rel": "select 1 as n",
}


@query("evaluate_detector", f"select * from ({_summary_sql('a.found')}) where detector = 'spend'", ctes=HEAD)
def evaluate_detector(v: Views) -> DataFrame:
    return E.evaluate_detector(v.ranking(), v.truth(), "spend")


@query("compare_detectors", _summary_sql("a.found"), ctes=HEAD)
def compare_detectors(v: Views) -> DataFrame:
    return E.compare_detectors(v.ranking(), v.truth())


# --- segments and money ---------------------------------------------------

ATTRIBUTES = ["p_brand", "p_type", "size_band"]


def _start_sql(k: int) -> dict[str, str]:
    """The first ``k`` modes, a table each."""
    names = ", ".join(ATTRIBUTES)
    shares = " + ".join(f"sum(w) over (partition by {a})" for a in ATTRIBUTES)
    steps = {"profiles": f"select {names}, count(*) as w from fx_categorical where {' and '.join(f'{a} is not null' for a in ATTRIBUTES)} group by all",
             "dense": f"select {names}, ({shares}) / {float(len(ATTRIBUTES))} / sum(w) over () as density from profiles"}
    for n in range(k):
        away = [" + ".join(f"(d.{a} <> m{j}.{a})::int" for a in ATTRIBUTES) for j in range(n)]
        nearest = f"least({', '.join(away)})" if away else str(len(ATTRIBUTES))
        steps[f"m{n}"] = f"""select d.* from dense d {' '.join(f'cross join m{j}' for j in range(n))}
            order by round(({nearest}) * d.density, 9) desc, {', '.join(f'd.{a}' for a in ATTRIBUTES)} limit 1"""
    return steps


@query("kmodes_start", " union all ".join(f"select {n} as cluster, {', '.join(ATTRIBUTES)} from m{n}" for n in range(4)), ctes=_start_sql(4))
def kmodes_start(v: Views) -> DataFrame:
    """The modes that the rounds begin with."""
    modes = KM.initial_modes(KM.distinct_profiles(v.categorical(), ATTRIBUTES), ATTRIBUTES, 4)
    schema = "cluster int, " + ", ".join(f"{a} string" for a in ATTRIBUTES)
    return v.spark.createDataFrame([(n, *m) for n, m in enumerate(modes)], schema)


def _rounds_sql(ks: range) -> dict[str, str]:
    """The start, then rounds of assigning profiles and updating modes as a recursion with a row per number of clusters."""
    names = range(1, len(ATTRIBUTES) + 1)
    away = " + ".join(f"(v[{a}] <> modes[j][{a}])::int" for a in names)
    modes = ", ".join(f"(select [{', '.join(ATTRIBUTES)}] from m{n})" for n in range(max(ks)))
    kept = "any_value(round) as round, any_value(cost) as cost, any_value(modes) as modes"
    update = ", ".join(f"coalesce(list_filter(best, lambda b: b.c = j and b.a = {a})[1].v, m[{a}])" for a in names)
    return {**_start_sql(max(ks)),
            "start": f"select [{modes}] as modes",
            "points": f"select [{', '.join(ATTRIBUTES)}] as v, w from profiles",
            "rounds": f"""select k, 0 as round, modes[1:k] as modes, cast(null as bigint) as cost, false as stop from start, range({min(ks)}, {max(ks) + 1}) g(k)
            union all
            select k, round + 1, case when stop then modes else updated end, new_cost, stop from (
                select *, updated = modes or coalesce(new_cost >= cost, false) as stop from (
                    select *, list_transform(modes, lambda m, j: [{update}]) as updated from (
                        select k, {kept}, cast(sum(loss) filter (a = 1) as bigint) as new_cost, list({{'c': c, 'a': a, 'v': x}}) as best from (
                            select k, c, a, {kept}, first(x order by n desc, x) as x, sum(loss) as loss from (
                                select k, c, a, v[a] as x, {kept}, sum(w) as n, sum(d * w) as loss from (
                                    select *, near % 1000 as c, near // 1000 as d from (
                                        select k, round, cost, modes, v, w, list_min(list_transform(range(1, k + 1), lambda j: ({away}) * 1000 + j)) as near
                                        from rounds, points where not stop and round < {KM.MAX_ROUNDS})), range(1, {len(ATTRIBUTES) + 1}) h(a)
                                group by k, c, a, v[a]) group by k, c, a) group by k)))""",
            "fitted": "select k, arg_max(modes, round) as modes, arg_max(cost, round) as cost from rounds group by 1"}


@query("kmodes", f"""
    select * exclude (near, modes, k, cost), cast(near % 1000 - 1 as int) as cluster, cast(near // 1000 as int) as mismatch from (
        select c.*, f.*, list_min(list_transform(range(1, k + 1), lambda j:
               ({' + '.join(f'({a} <> modes[j][{n}])::int' for n, a in enumerate(ATTRIBUTES, start=1))}) * 1000 + j)) as near
        from fx_categorical c, fitted f where {' and '.join(f'{a} is not null' for a in ATTRIBUTES)})""", ctes=_rounds_sql(range(10, 11)))
def kmodes(v: Views) -> DataFrame:
    return KM.kmodes(v.categorical(), ATTRIBUTES, 10)


@query("kmodes_elbow", "select cast(k as int) as k, cost from fitted", ctes=_rounds_sql(range(5, 21)))
def kmodes_elbow(v: Views) -> DataFrame:
    return KM.elbow(v.categorical(), ATTRIBUTES)


# clusters are the customers' segments and zones; the score is a number derived from the id
SEGMENTS = {
    "seg": """select g.series_id, g.category || '/' || g.zone as cluster, t.label, avg(g.value) as value,
              cast(g.series_id * 37 % 101 as double) / 100 as score
              from fx_group_panel g join fx_truth t using (series_id) group by all""",
    "profile": """select cluster, count(*) as total, count(*) filter (label = 1) as anomalous, count(*) filter (label = 0) as normal,
                  avg(value) filter (label = 1) as mean_anomalous, avg(value) filter (label = 0) as mean_normal,
                  median(value) filter (label = 0) - median(value) filter (label = 1) as difference from seg group by 1""",
    "sweep": f"""
        select t / 100 as threshold, kwh * {K.horizon_months()!r}::double * 850 as benefit, (tp + fp) * 50000e0 as cost,
               kwh * {K.horizon_months()!r}::double * 850 - (tp + fp) * 50000e0 as net_benefit,
               coalesce(tp / nullif(tp + fp, 0), 0) as precision, coalesce(tp / nullif(p, 0), 0) as recall, tp + fp as visits
        from (select t, sum(tp * difference) as kwh, cast(sum(tp) as bigint) as tp, cast(sum(fp) as bigint) as fp, sum(p) as p from (
            select t, s.cluster, max(difference) as difference, count(*) filter (label = 1) as p,
                   count(*) filter (label = 1 and score > t / 100) as tp, count(*) filter (label = 0 and score > t / 100) as fp
            from seg s join profile c on s.cluster = c.cluster and c.difference > 0, range(10, 91, 5) g(t) group by 1, 2) group by 1)""",
}


def _segments(v: Views) -> DataFrame:
    rows = _labelled(v).groupBy("series_id", "category", "zone", "label").agg(F.avg("value").alias("value"))
    rows = rows.select("series_id", F.concat_ws("/", "category", "zone").alias("cluster"), "label", "value",
                       ((F.col("series_id") * 37 % 101).cast("double") / 100).alias("score"))
    return persist_table(rows)  # one row per client, read by every step that follows


@query("cluster_profile", f"""
    select cluster, total, anomalous, normal, {r('anomalous / total', 6)} as share_anomalous, {r('normal / total', 6)} as share_normal,
           {r('mean_anomalous', 6)} as mean_anomalous, {r('mean_normal', 6)} as mean_normal, {r('difference', 6)} as difference
    from profile""", digits=6, ctes=SEGMENTS)
def cluster_profile(v: Views) -> DataFrame:
    return K.cluster_profile(_segments(v))


@query("beneficial_clusters", f"select cluster, {r('difference')} as difference from profile where difference > 0", ctes=SEGMENTS)
def beneficial_clusters(v: Views) -> DataFrame:
    return K.beneficial_clusters(K.cluster_profile(_segments(v))).select("cluster", "difference")


@query("threshold_sweep", f"""
    select {r('threshold')} as threshold, {r('benefit', 0)} as benefit, {r('cost', 0)} as cost, {r('net_benefit', 0)} as net_benefit,
           {r('precision')} as precision, {r('recall')} as recall, visits,
           {r('coalesce(2 * precision * recall / nullif(precision + recall, 0), 0)')} as f1 from sweep""", ctes=SEGMENTS)
def threshold_sweep(v: Views) -> DataFrame:
    rows = _segments(v)
    sweep = K.threshold_sweep(rows, K.cluster_profile(rows))
    return sweep.withColumns({c: F.round(c, 0) for c in ("benefit", "cost", "net_benefit")})


@query("best_threshold", f"""
    select {r('threshold')} as threshold, {r('net_benefit', 0)} as net_benefit, visits from sweep
    order by round(net_benefit, 0) desc, threshold limit 1""", ctes=SEGMENTS)
def best_threshold(v: Views) -> DataFrame:
    rows = _segments(v)
    best = K.best_threshold(K.threshold_sweep(rows, K.cluster_profile(rows)))
    return best.withColumn("net_benefit", F.round("net_benefit", 0))


@query("label_category_filter", """
    select distinct series_id, visit_date, code, label from (
        select series_id, visit_date, code, case when code in ('5-LOW', '3-MEDIUM') then 0 else 1 end as label from fx_visits_old
        where code <> '4-NOT SPECIFIED' and series_id <> 0) where label = 0 or (label = 1 and code = '1-URGENT')""")
def label_category_filter(v: Views) -> DataFrame:
    labels = L.label_no_impact(v.visits_old(), no_impact=["5-LOW", "3-MEDIUM"], not_applicable=["4-NOT SPECIFIED"])
    # the category table: urgent findings are the user's doing, high ones come with over-billing
    categories = v.visits_old().select("code").distinct().select(
        "code", F.col("code").isin("1-URGENT", "2-HIGH").alias("by_user"), (F.col("code") == "2-HIGH").alias("over_billing"))
    return L.filter_by_category(labels, categories)
