"""Sources, projections, addresses, joins, sets, aggregates, sorting."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwatch.functions import address as A
from meterwatch.functions import nulls as N
from meterwatch.functions import scalar as S
from meterwatch.operators import labels as L
from meterwatch.operators import panel as P
from meterwatch.operators import quality as Q
from meterwatch.operators import relational as R
from meterwatch.operators.ordering import arg_best, global_rank, top_k
from meterwatch.plans.registry import query, r
from meterwatch.plans.views import Views
from meterwatch.session import shared_folder, spread
from meterwatch.sources import readers, stages, writers

PANEL_SQL = f"select series_id, period, {r('value')} as value from fx_panel"


# --- sources and sinks ----------------------------------------------------

@query("scan_csv_renamed", """
    select c_custkey as producto, c_name as nombre, c_nationkey as localidad, c_acctbal as saldo,
           c_mktsegment as categoria from customer""")
def scan_csv_renamed(v: Views) -> DataFrame:
    path = writers.write_csv(v.t("customer"), shared_folder(v.spark))
    schema = "a long, b string, c int, d double, e string"
    return readers.scan_csv(v.spark, path, schema, ["producto", "nombre", "localidad", "saldo", "categoria"])


@query("scan_tsv_union", f"""
    select cast(strftime(period, '%Y%m') as int) as month, series_id, {r('value')} as value from fx_panel""")
def scan_tsv_union(v: Views) -> DataFrame:
    rows = v.panel().select(
        F.date_format("period", "yyyyMM").alias("MES_CONSUMO"), F.col("series_id").cast("string").alias("CUCONUSE"),
        F.replace(F.col("value").cast("string"), F.lit("."), F.lit(",")).alias("CONSUMO_TOTAL"),
        F.lit("Señal").alias("OBSERVACION"))
    folder = shared_folder(v.spark)
    halves = (F.month(F.to_date("MES_CONSUMO", "yyyyMM")) <= 6)
    paths = [writers.write_csv(rows.filter(part), f"{folder}/{name}", sep="\t", encoding="ISO-8859-1")
             for name, part in (("CONSUMOS_01", halves), ("CONSUMOS_02", ~halves))]
    text = readers.scan_tab_text(v.spark, paths, rows.columns, ["MES_CONSUMO", "CUCONUSE", "CONSUMO_TOTAL"])
    return text.select(F.col("MES_CONSUMO").try_cast("int").alias("month"),
                       F.col("CUCONUSE").try_cast("long").alias("series_id"),
                       S.parse_decimal_comma(F.col("CONSUMO_TOTAL")).alias("value"))


@query("scan_parquet", """
    select o_orderstatus as status, count(*) as n, cast(min(o_orderdate) as date) as first
    from orders group by 1""")
def scan_parquet(v: Views) -> DataFrame:
    orders = readers.scan_parquet(v.spark, f"{v.dir}/orders.parquet")
    return orders.groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderdate").cast("date").alias("first"))


@query("scan_pruned", "select c_custkey, c_mktsegment from customer")
def scan_pruned(v: Views) -> DataFrame:
    return readers.scan_available(v.spark, f"{v.dir}/customer.parquet", ["c_custkey", "c_mktsegment", "c_subclass"])


VISIT_FILE = "`Fecha Visita` string, `Producto` long, `Anomalia 1` string"


@query("scan_inspections", "select visit_date, series_id, code from fx_visits_old")
def scan_inspections(v: Views) -> DataFrame:
    rows = v.visits_old().select(
        F.date_format("visit_date", "dd/MM/yyyy").alias("Fecha Visita"), F.col("series_id").alias("Producto"),
        F.col("code").alias("Anomalia 1"))
    path = writers.write_csv(rows, shared_folder(v.spark))
    report = readers.scan_csv(v.spark, path, VISIT_FILE)
    return report.select(S.parse_date(F.col("Fecha Visita")).alias("visit_date"),
                         F.col("Producto").alias("series_id"), F.col("Anomalia 1").alias("code"))


@query("unpivot_months", f"""
    select i.series_id, m.period, {r('p.value')} as value
    from (select distinct series_id from fx_panel) i
    join (select distinct period from fx_panel) m on true
    left join fx_panel p on p.series_id = i.series_id and p.period = m.period""")
def unpivot_months(v: Views) -> DataFrame:
    panel = v.panel()
    span = panel.agg(F.min("period").alias("a"), F.max("period").alias("b")).first()
    months = [row.m for row in v.spark.range(1).select(  # the months of the report header
        F.explode(F.sequence(F.lit(span.a), F.lit(span.b), F.expr("interval 1 month"))).alias("m")).collect()]
    wide = panel.groupBy("series_id").agg(*[
        F.max(F.when(F.col("period") == F.lit(m), F.col("value"))).alias(m.strftime("%d/%m/%Y")) for m in months])
    path = writers.write_csv(wide.withColumnRenamed("series_id", "CLIENTE"), shared_folder(v.spark))
    schema = ", ".join(["CLIENTE long", *[f"`{c}` double" for c in wide.columns[1:]]])
    report = readers.scan_csv(v.spark, path, schema)
    return readers.months_to_rows(report, ["series_id"], {"CLIENTE": "series_id"})


@query("sink_csv", PANEL_SQL)
def sink_csv(v: Views) -> DataFrame:
    path = writers.write_csv(v.panel(), shared_folder(v.spark))
    return readers.scan_csv(v.spark, path, "series_id long, period date, value double")


@query("sink_parquet", PANEL_SQL)
def sink_parquet(v: Views) -> DataFrame:
    return readers.scan_parquet(v.spark, writers.write_parquet(v.panel(), shared_folder(v.spark)))


@query("stage_reuse", PANEL_SQL)
def stage_reuse(v: Views) -> DataFrame:
    path = shared_folder(v.spark)
    stages.reuse_or_build(v.spark, path, v.panel)

    def must_not_run() -> DataFrame:
        raise AssertionError("a finished stage was built again")

    return stages.reuse_or_build(v.spark, path, must_not_run)


@query("incremental_resume", f"select series_id, {r('sum(value)', 4)} as total from fx_user_day group by 1", digits=4)
def incremental_resume(v: Views) -> DataFrame:
    """First run over the buyers, second over everyone: only the rest is added."""
    days, path = v.user_day(), shared_folder(v.spark)
    buyers = v.t("events").filter("event_type = 'purchase'").select(F.col("user_id").alias("series_id")).distinct()

    def totals(todo: DataFrame) -> DataFrame:
        return todo.groupBy("series_id").agg(F.sum("value").alias("total"))

    stages.resume(v.spark, path, days.join(buyers, "series_id", "left_semi"), ["series_id"], totals)
    return stages.resume(v.spark, path, days, ["series_id"], totals)


@query("resume_missing", f"""
    select p.series_id, p.period, {r('coalesce(p.value, a.mean)')} as value
    from fx_panel_nulls p
    left join (select series_id, avg(value) as mean from fx_panel group by 1) a using (series_id)""")
def resume_missing(v: Views) -> DataFrame:
    means = v.panel().groupBy("series_id").agg(F.avg("value").alias("value"))

    def look_up(rows: DataFrame) -> DataFrame:
        return rows.join(means, "series_id")

    return stages.fill_missing(v.panel_nulls(), ["series_id", "period"], ["value"], look_up)


@query("scan_glob_union", PANEL_SQL)
def scan_glob_union(v: Views) -> DataFrame:
    folder, panel = shared_folder(v.spark), v.panel()
    first_half = F.month("period") <= 6
    writers.write_csv(panel.filter(first_half), f"{folder}/resultados_1")
    writers.write_csv(panel.filter(~first_half), f"{folder}/resultados_2")
    return readers.scan_csv(v.spark, f"{folder}/resultados*", "series_id long, period date, value double")


@query("sample_entities", f"""
    select series_id, period, {r('value')} as value from fx_panel
    where series_id in (select distinct series_id from fx_panel order by 1 limit 20)""")
def sample_entities(v: Views) -> DataFrame:
    return stages.sample_entities(v.panel(), 20)


# --- projections ----------------------------------------------------------

@query("month_date", """
    select o_orderkey, make_date(year(o_orderdate), month(o_orderdate), 1) as period from orders""")
def month_date(v: Views) -> DataFrame:
    return v.t("orders").select("o_orderkey", S.month_start(F.year("o_orderdate"), F.month("o_orderdate")).alias("period"))


@query("parse_yyyymm", """
    select o_orderkey, cast(date_trunc('month', o_orderdate) as date) as period,
           cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month from orders""")
def parse_yyyymm(v: Views) -> DataFrame:
    code = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("int")
    rows = v.t("orders").select("o_orderkey", S.parse_yyyymm(code).alias("period"))
    return rows.select("*", F.year("period").alias("year"), F.month("period").alias("month"))


@query("parse_decimal_comma", f"select c_custkey, {r('c_acctbal')} as balance from customer")
def parse_decimal_comma(v: Views) -> DataFrame:
    text = F.replace(F.col("c_acctbal").cast("string"), F.lit("."), F.lit(","))
    return v.t("customer").select("c_custkey", S.parse_decimal_comma(text).alias("balance"))


@query("coerce_types", """
    select o_orderkey,
           try_cast(case when o_orderstatus = 'O' then 'sin dato' else cast(o_totalprice as varchar) end as double) as price,
           try_cast(case when o_orderpriority = '5-LOW' then 'nunca' else strftime(o_orderdate, '%Y-%m-%d') end as date) as day
    from orders""")
def coerce_types(v: Views) -> DataFrame:
    text = v.t("orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "O", "sin dato").otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        F.when(F.col("o_orderpriority") == "5-LOW", "nunca").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"))
    return Q.coerce(text, numbers=["price"], dates=["day"])


@query("parse_mixed_dates", "select o_orderkey, cast(o_orderdate as date) as day from orders")
def parse_mixed_dates(v: Views) -> DataFrame:
    d = F.col("o_orderdate")
    text = (F.when(F.col("o_orderstatus") == "F", F.date_format(d, "dd/MM/yyyy"))
            .when(F.col("o_orderstatus") == "O", F.date_format(d, "yyyy-MM-dd"))
            .otherwise(F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit(" 00:00:00"))))
    return v.t("orders").select("o_orderkey", S.parse_date(text, ["dd/MM/yyyy", "yyyy-MM-dd"]).alias("day"))


@query("project_rename", f"select c_custkey as producto, {r('c_acctbal')} as score from customer")
def project_rename(v: Views) -> DataFrame:
    raw = v.t("customer").withColumnsRenamed({"c_custkey": " CLIENTE_ID ", "c_acctbal": "Fraud_Score", "c_name": "Anomalia 2"})
    return R.rename_by_alias(R.drop_matching(raw, "Anomalia"), {
        "producto": ["producto", "cliente_id", "clientes_id"], "score": ["anomaly_score", "fraud_score", "score"]})


@query("filter_sentinel", "select c_custkey, c_nationkey from customer where c_custkey <> 0 or c_custkey is null")
def filter_sentinel(v: Views) -> DataFrame:
    return v.t("customer").filter(N.not_equal(F.col("c_custkey"), 0)).select("c_custkey", "c_nationkey")


CODES_SQL = """(select series_id, visit_date, case when code = '4-NOT SPECIFIED' then null else code end as code
                from fx_visits_old)"""


@query("filter_codes", f"""
    select series_id, visit_date, code, case when coalesce(code in ('5-LOW', '3-MEDIUM'), false) then 0 else 1 end as label
    from {CODES_SQL} where not coalesce(code in ('2-HIGH'), false)""")
def filter_codes(v: Views) -> DataFrame:
    code = F.when(F.col("code") != "4-NOT SPECIFIED", F.col("code"))
    rows = v.visits_old().withColumn("code", code)
    return rows.filter(~N.is_in(F.col("code"), ["2-HIGH"])).withColumn(
        "label", F.when(N.is_in(F.col("code"), ["5-LOW", "3-MEDIUM"]), 0).otherwise(1))


@query("exclude_periods", f"""{PANEL_SQL}
    where not (year(period) = 2000 and month(period) = 9 or year(period) = 2000 and month(period) = 10)""")
def exclude_periods(v: Views) -> DataFrame:
    return P.exclude_periods(v.panel(), [(2000, 9), (2000, 10)])


@query("trailing_months", f"""{PANEL_SQL}
    where period > (select max(period) - interval 19 month from fx_panel)""")
def trailing_months(v: Views) -> DataFrame:
    return Q.trailing_months(v.panel(), 19)


@query("drop_nulls", f"""
    select series_id, period, {r('value')} as value from fx_panel_nulls where value is not null""")
def drop_nulls(v: Views) -> DataFrame:
    return v.panel_nulls().dropna(subset=["value"])


@query("clean_category", """
    select p_partkey, nullif(regexp_replace(trim(raw), '\\.0$', ''), 'nan') as size from (
        select p_partkey, case when p_type = 'ECONOMY' then ' nan ' else concat(' ', cast(p_size as varchar), '.0') end as raw
        from part)""")
def clean_category(v: Views) -> DataFrame:
    raw = F.when(F.col("p_type") == "ECONOMY", F.lit(" nan ")).otherwise(
        F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(".0")))
    return v.t("part").select("p_partkey", S.clean_category(raw).alias("size"))


@query("year_month", "select series_id, period, strftime(period, '%Y-%m') as year_month from fx_panel")
def year_month(v: Views) -> DataFrame:
    return v.panel().select("series_id", "period", S.month_key(F.col("period")).alias("year_month"))


@query("log_value", f"""
    select series_id, period, {r('case when value > 0 then ln(value) end')} as value_log from fx_panel""")
def log_value(v: Views) -> DataFrame:
    return v.panel().select("series_id", "period", S.safe_log(F.col("value")).alias("value_log"))


@query("sanitize_numeric", f"""
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, {r('coalesce(l_quantity / nullif(l_tax, 0), 0)')} as ratio
    from lineitem""")
def sanitize_numeric(v: Views) -> DataFrame:
    infinite = F.when(F.col("l_tax") == 0, F.lit(float("inf"))).otherwise(
        F.try_divide(F.col("l_quantity"), F.col("l_tax")))
    return v.t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                  N.finite_or(infinite).alias("ratio"))


@query("epoch_day", """
    select o_orderkey, cast(date_diff('day', date '1970-01-01', cast(o_orderdate as date)) as int) as day from orders""")
def epoch_day(v: Views) -> DataFrame:
    return v.t("orders").select("o_orderkey", S.epoch_day(F.col("o_orderdate")).alias("day"))


PAIR_SQL = """
    select coalesce(o.series_id, n.series_id) as series_id, o.label as old_label, n.label as new_label, greatest(o.label, n.label) as label,
           o.code as old_code, n.code as new_code
    from (select series_id, max(case when code = '5-LOW' then 0 else 1 end) as label, max(code) as code
          from fx_visits_old group by 1) o
    full join (select series_id, max(case when code = '1-URGENT' then 1 else 0 end) as label, max(code) as code
          from fx_visits_new group by 1) n on o.series_id = n.series_id"""


@query("conditional_pick", """
    select series_id, label, case when label = new_label then new_code else old_code end as code from pairs""",
       ctes={"pairs": PAIR_SQL})
def conditional_pick(v: Views) -> DataFrame:
    def side(df: DataFrame, test, tag: str) -> DataFrame:
        return df.groupBy("series_id").agg(F.max(test.cast("int")).alias(f"{tag}_label"), F.max("code").alias(f"{tag}_code"))

    old = side(v.visits_old(), F.col("code") != "5-LOW", "old")
    new = side(v.visits_new(), F.col("code") == "1-URGENT", "new")
    rows = old.join(new, "series_id", "full").withColumn("label", F.greatest("old_label", "new_label"))
    return rows.select("series_id", "label", S.pick_by_match(
        F.col("label"), F.col("new_label"), F.col("new_code"), F.col("old_code")).alias("code"))


@query("composite_key", """
    select concat_ws('||', category, zone, cast(period as varchar)) as key, count(*) as n
    from fx_group_panel group by 1""")
def composite_key(v: Views) -> DataFrame:
    return v.group_panel().groupBy(S.composite_key(["category", "zone", "period"]).alias("key")).agg(
        F.count(F.lit(1)).alias("n"))


@query("search_id", f"""{PANEL_SQL} where series_id = 17""")
def search_id(v: Views) -> DataFrame:
    found = v.panel().filter(S.matches_typed_id(F.col("series_id"), " 17 "))
    return found.filter(S.matches_typed_id(F.col("series_id"), "diecisiete"))


# --- addresses ------------------------------------------------------------

STANDARD_SQL = r"""
    select series_id, case
        when regexp_matches(t, '\b([A-ZÁÉÍÓÚÑ]+)\s+(\d+[A-Z]{0,2})\s+(\d+[A-Z]{0,2})\s*-\s*(\d+)')
        then regexp_replace(regexp_extract(t, '\b([A-ZÁÉÍÓÚÑ]+)\s+(\d+[A-Z]{0,2})\s+(\d+[A-Z]{0,2})\s*-\s*(\d+)'),
             '([A-ZÁÉÍÓÚÑ]+)\s+(\d+[A-Z]{0,2})\s+(\d+[A-Z]{0,2})\s*-\s*(\d+)', '\1 \2 #\3-\4')
        else t end as address
    from (select series_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(upper(official),
        '\([^)]*\)', '', 'g'), '\s+(CAS\s|APT\s|LOC\s).*$', ''), '\bCLL\b', 'CALLE', 'g'), '\s+', ' ', 'g')) as t
        from fx_address)"""


@query("address_std_a", STANDARD_SQL)
def address_std_a(v: Views) -> DataFrame:
    return v.address().select("series_id", A.standardise_a(F.col("official")).alias("address"))


@query("address_label", """
    select s.series_id, address || ', ' || n_name || ', ' || array_to_string(list_transform(
           string_split(lower(r_name), ' '), lambda w: upper(w[1]) || w[2:]), ' ') || ', NORTE DE SANTANDER, COLOMBIA' as label
    from (select series_id, address from standard where address is not null) s
    join customer on c_custkey = s.series_id
    join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
    union all select series_id, null from standard where address is null""", ctes={"standard": STANDARD_SQL})
def address_label(v: Views) -> DataFrame:
    places = v.t("customer").join(v._regions(), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("series_id"), "n_name", "r_name")
    rows = v.address().join(places, "series_id")
    return rows.select("series_id", A.label_a(
        A.standardise_a(F.col("official")), F.col("n_name"), F.col("r_name")).alias("label"))


NORMAL_SQL = r"""
    select series_id, official, installed,
        regexp_replace(regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(
            split_part(upper(trim({0})), 'APTO', 1), '\bK\b', 'CARRERA', 'g'), '\b0+(\d+)\b', '\1', 'g'), '\s+', ' ', 'g')),
            '((?:CARRERA|CALLE|AVENIDA|DIAGONAL|TRANSVERSAL)\s+\w+(?:\s+[A-Z]+)*)\s+(\d+\s*[A-Z]?\s*-\s*\d+)', '\1 # \2', 'g'),
            '$', ', Cali, Colombia') as address
    from fx_address"""


@query("address_norm_b", "select series_id, address from normal where address is not null "
                         "union all select series_id, null from normal where address is null",
       ctes={"normal": NORMAL_SQL.format("installed")})
def address_norm_b(v: Views) -> DataFrame:
    return v.address().select("series_id", A.normalise_b(F.col("installed")).alias("address"))


RESOLVED_SQL = """
    select a.series_id, coalesce(a.address, b.address) as address,
           case when a.address is not null then 'direccion_oficial'
                when b.address is not null then 'instalacion' else 'fallido' end as source
    from official a join installed b using (series_id)"""
ADDRESS_CTES = {"official": NORMAL_SQL.format("official"), "installed": NORMAL_SQL.format("installed"),
                "resolved": RESOLVED_SQL}


def _resolved(v: Views, ids: DataFrame | None = None) -> DataFrame:
    """Addresses of all clients, or of ``ids``, dealt to all cores: cleaning is heavy per row and the table may be one small file."""
    address, source = A.with_fallback(F.col("official"), F.col("installed"))
    rows = v.address() if ids is None else R.keep_ids(v.address(), ids, ["series_id"])
    return (spread(rows) if ids is None else rows).select("series_id", address.alias("address"), source.alias("source"))


def _coordinates(v: Views) -> DataFrame:
    """One place per cleaned official address; equal texts are put together before they are cleaned."""
    texts = v.address().filter("official is not null").groupBy("official").agg(F.min("series_id").alias("first"), F.max("series_id").alias("last"))
    ends = spread(texts, "official").groupBy(A.normalise_b(F.col("official")).alias("address")).agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return ends.select("address", (F.col("first").cast("double") / 100).alias("lat"), (-F.col("last").cast("double") / 100).alias("lon"))


@query("address_fallback", "select * from resolved", ctes=ADDRESS_CTES)
def address_fallback(v: Views) -> DataFrame:
    return _resolved(v)


@query("address_distinct", "select distinct address from resolved where address is not null", ctes=ADDRESS_CTES)
def address_distinct(v: Views) -> DataFrame:
    return _resolved(v).select("address").dropna().dropDuplicates(["address"])


# one text for each shape and word of the two formats, the same expression in Spark and in SQL
SHAPES_TEXT = """case c_custkey % 9
    when 0 then concat('Sector (km 3)  norte ', cast(c_custkey as string))
    when 1 then concat('CLL ', cast(c_custkey % 90 as string), ' ', cast(c_nationkey as string), 'AB - 7 LOC 3')
    when 2 then concat('mnz ', cast(c_custkey % 90 as string), ' ', cast(c_nationkey as string), ' 44')
    when 3 then concat('AVENIDA CANAL BOGOTA ', cast(c_custkey % 90 as string), ' ', cast(c_nationkey as string))
    when 4 then concat('CLL ', cast(c_custkey % 90 as string), ' NORTE ', cast(c_nationkey as string), 'A - 12')
    when 5 then concat('CRR ANT BELEN ', cast(c_custkey % 90 as string), 'A - ', cast(c_nationkey as string))
    when 6 then concat('AVE CANAL BOGOTA ', cast(c_custkey % 90 as string), 'C ', cast(c_nationkey as string))
    when 7 then concat('AVENIDA LIBERTADORES ', cast(c_custkey % 90 as string), 'B-', cast(c_nationkey as string), ' CAS 2')
    else concat('crr belen ', cast(c_custkey % 90 as string), 'D ', cast(c_nationkey as string)) end"""
WORDS_TEXT = """case c_custkey % 8
    when 0 then concat('CL 0', cast(c_custkey % 60 as string), ' 3 - 20 APARTAMENTO 4')
    when 1 then concat('MACROMEDICION AV 5 ', cast(c_custkey % 60 as string), ' - 9 0000')
    when 2 then concat('TR 4 BIS ', cast(c_custkey % 60 as string), ' - 7 LC 3')
    when 3 then concat('VD ALTA 00', cast(c_custkey as string), ' MACRO')
    when 4 then concat(' DIAGONAL 5  6-', cast(c_custkey % 60 as string), ' INTERIOR 2')
    when 5 then concat('CR ', cast(c_custkey % 60 as string), ' 2 - 3 BLOQUE 9')
    when 6 then 'CASA 3'
    else concat('k ', cast(c_custkey % 60 as string), ' 8A - 3 apto 5') end"""


def _swapped(text: str, pattern: str, by: str) -> str:
    return f"regexp_replace({text}, '{pattern}', '{by}', 'g')"


def _numbered(template: str) -> str:
    return re.sub(r"\{([0-9])\}", lambda m: "\\" + m[1], template)


def _shapes_sql() -> str:
    text = f"upper({SHAPES_TEXT})"
    for pattern, by in A.CLEANING_A:
        text = _swapped(text, pattern, by)
    for short, full in A.ABBREVIATIONS_A.items():
        text = _swapped(text, rf"\b{short}\b", full)
    cases = " ".join(f"when regexp_matches(t, '{p}') then regexp_replace(regexp_extract(t, '{p}'), '{p}', '{_numbered(by)}')" for p, by in A.SHAPES_A)
    spaces = _swapped(text, r"\s+", " ")
    return f"select series_id, case {cases} else t end as address from (select c_custkey as series_id, trim({spaces}) as t from customer)"


@query("address_shapes", _shapes_sql())
def address_shapes(v: Views) -> DataFrame:
    """Every shape of the first format."""
    text = v.t("customer").select(F.col("c_custkey").alias("series_id"), F.expr(SHAPES_TEXT).alias("text"))
    return text.select("series_id", A.standardise_a(F.col("text")).alias("address"))


def _words_sql() -> str:
    text = f"trim(upper({WORDS_TEXT}))"
    for word in A.CUT_WORDS_B:
        text = f"trim(split_part({text}, '{word}', 1))"
    for word in A.DROP_WORDS_B:
        text = f"replace({text}, '{word}', '')"
    text = f"trim({text})"
    for short, full in A.ABBREVIATIONS_B.items():
        text = _swapped(text, rf"\b{short}\b", full)
    for pattern, by in A.CLEANING_B:
        text = _swapped(text, pattern, by.replace("$", "\\"))
    spaces = _swapped(text, r"\s+", " ")
    pattern, by = A.STREET_B
    street = _swapped(f"trim({spaces})", pattern, by.replace("$", "\\"))
    return f"select c_custkey as series_id, {street} || ', Cali, Colombia' as address from customer"


@query("address_words", _words_sql())
def address_words(v: Views) -> DataFrame:
    """Every word that the second format cuts, drops or writes out."""
    text = v.t("customer").select(F.col("c_custkey").alias("series_id"), F.expr(WORDS_TEXT).alias("text"))
    return text.select("series_id", A.normalise_b(F.col("text")).alias("address"))


COORDINATES_SQL = """
    select address, cast(min(series_id) as double) / 100 as lat, -cast(max(series_id) as double) / 100 as lon
    from resolved where source = 'direccion_oficial' group by 1"""


@query("coord_joinback", """
    select r.source, count(*) as clients, count(*) filter (c.lat is null) as missing
    from resolved r left join coordinates c on r.address = c.address group by 1""",
       ctes={**ADDRESS_CTES, "coordinates": COORDINATES_SQL})
def coord_joinback(v: Views) -> DataFrame:
    located = _resolved(v).join(_coordinates(v), "address", "left")
    return located.groupBy("source").agg(F.count(F.lit(1)).alias("clients"), F.count_if(F.col("lat").isNull()).alias("missing"))


# --- joins ----------------------------------------------------------------

@query("join_left_indicator", """
    select case when d.series_id is null then 'left_only' else 'both' end as match, count(*) as n
    from fx_group_panel p left join fx_dim d on p.series_id = d.series_id group by 1""")
def join_left_indicator(v: Views) -> DataFrame:
    joined = R.join_with_indicator(v.group_panel().drop("category", "zone"), v.dim(), ["series_id"])
    return joined.groupBy("match").agg(F.count(F.lit(1)).alias("n"))


@query("join_unmatched", f"""
    select 'matched' as part, series_id, period, {r('value', 2)} as value from fx_group_panel
    where series_id in (select series_id from fx_dim)
    union all
    select 'unmatched', series_id, period, {r('value', 2)} from fx_group_panel
    where series_id not in (select series_id from fx_dim)""", digits=2)
def join_unmatched(v: Views) -> DataFrame:
    both, left = R.split_by_match(v.group_panel().select("series_id", "period", "value"), v.dim().select("series_id"), ["series_id"])
    return both.withColumn("part", F.lit("matched")).unionByName(left.withColumn("part", F.lit("unmatched")))


@query("join_semi", "select distinct series_id from fx_visits_old where series_id in (select series_id from fx_dim)")
def join_semi(v: Views) -> DataFrame:
    return R.keep_ids(v.visits_old(), v.dim(), ["series_id"]).select("series_id").distinct()


@query("join_anti", "select series_id, visit_date, code from fx_visits_old "
                    "where series_id not in (select series_id from fx_dim)")
def join_anti(v: Views) -> DataFrame:
    return R.drop_ids(v.visits_old(), v.dim(), ["series_id"])


@query("join_inner", f"""
    select p.series_id, p.period, {r('p.value', 2)} as value, t.label
    from fx_group_panel p join fx_truth t on p.series_id = t.series_id""", digits=2)
def join_inner(v: Views) -> DataFrame:
    return v.group_panel().select("series_id", "period", "value").join(v.truth(), "series_id")


@query("join_enrich", """
    select v.series_id, v.visit_date, v.code, d.category, d.zone
    from fx_visits_new v left join fx_dim d on v.series_id = d.series_id where d.zone is not null""")
def join_enrich(v: Views) -> DataFrame:
    return R.enrich(v.visits_new(), v.dim().select("series_id", "category", "zone"), ["series_id"], ["zone"])


@query("join_accumulate", f"""
    select coalesce(a.series_id, b.series_id, c.series_id) as series_id, {r('a.score')} as balance,
           {r('b.score')} as spend, c.label
    from (select series_id, score from fx_ranking where detector = 'balance') a
    full join (select series_id, score from fx_ranking where detector = 'spend') b on a.series_id = b.series_id
    full join fx_truth c on coalesce(a.series_id, b.series_id) = c.series_id""")
def join_accumulate(v: Views) -> DataFrame:
    ranking = v.ranking()
    parts = [ranking.filter(F.col("detector") == d).select("series_id", F.col("score").alias(d)) for d in ("balance", "spend")]
    return R.accumulate([*parts, v.truth()], ["series_id"])


DAYS_SQL = """select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as period
              from (select min(period)::timestamp as lo, max(period)::timestamp as hi from fx_user_day)"""


@query("join_cross_panel", f"""
    select i.series_id, d.period, {r('u.value', 4)} as value, u.n_events
    from (select distinct series_id from fx_user_day) i join days d on true
    left join fx_user_day u on u.series_id = i.series_id and u.period = d.period""", digits=4, ctes={"days": DAYS_SQL})
def join_cross_panel(v: Views) -> DataFrame:
    return P.densify(v.user_day(), step="interval 1 day").select("series_id", "period", "value", "n_events")


@query("join_metadata", f"""
    select p.series_id, d.category, d.zone, {r('avg(p.value)', 4)} as mean, count(*) as n
    from fx_group_panel p join fx_dim d on p.series_id = d.series_id group by all""", digits=4)
def join_metadata(v: Views) -> DataFrame:
    features = v.group_panel().groupBy("series_id").agg(F.avg("value").alias("mean"), F.count(F.lit(1)).alias("n"))
    return features.join(v.dim().select("series_id", "category", "zone"), "series_id")


# --- sets and duplicates --------------------------------------------------

@query("union_sources", """
    select series_id, visit_date, code, 'old' as source, cast(null as varchar) as note from fx_visits_old
    union all select series_id, visit_date, code, 'new', 'report' from fx_visits_new""")
def union_sources(v: Views) -> DataFrame:
    return R.union_all(v.visits_old().withColumn("source", F.lit("old")),
                       v.visits_new().withColumn("source", F.lit("new")).withColumn("note", F.lit("report")))


@query("ids_union", "select series_id from fx_visits_old union select series_id from fx_dim")
def ids_union(v: Views) -> DataFrame:
    return R.ids_in_any(v.visits_old().select("series_id"), v.dim().select("series_id"))


HEADS_SQL = """
    select detector, series_id from (select *, row_number() over (partition by detector order by score desc, series_id) as k
    from fx_ranking) where k <= 500"""


@query("ids_intersect", """
    select count(*) as overlap from (select series_id from heads where detector = 'balance'
    intersect select series_id from heads where detector = 'spend')""", ctes={"heads": HEADS_SQL})
def ids_intersect(v: Views) -> DataFrame:
    order = [F.desc("score"), F.asc("series_id")]
    ranking = v.ranking()
    heads = [top_k(ranking.filter(F.col("detector") == d), 500, order) for d in ("balance", "spend")]
    return R.overlap(*heads, ["series_id"]).agg(F.count(F.lit(1)).alias("overlap"))


@query("ids_except", "select c_custkey as series_id from customer except select series_id from fx_dim")
def ids_except(v: Views) -> DataFrame:
    return v.t("customer").select(F.col("c_custkey").alias("series_id")).subtract(v.dim().select("series_id"))


@query("distinct_rows", "select distinct l_suppkey, l_partkey, l_returnflag from lineitem")
def distinct_rows(v: Views) -> DataFrame:
    return v.t("lineitem").select("l_suppkey", "l_partkey", "l_returnflag").distinct()


TAGGED_SQL = """select *, 'old' as source, 0 as o from fx_visits_old
                union all select *, 'new', 1 from fx_visits_new"""


@query("distinct_subset", """
    select series_id, visit_date, code, source from (
        select *, row_number() over (partition by series_id, visit_date order by o, code) as k from tagged) where k = 1""",
       ctes={"tagged": TAGGED_SQL})
def distinct_subset(v: Views) -> DataFrame:
    tagged = R.union_all(*[df.withColumn("source", F.lit(n)).withColumn("o", F.lit(i)) for i, (n, df) in enumerate(
        [("old", v.visits_old()), ("new", v.visits_new())])])
    return R.first_per_key(tagged, ["series_id", "visit_date"], ["o", "code"]).drop("o")


READINGS_SQL = """
    select l_suppkey as series_id, cast(date_trunc('month', l_shipdate) as date) as period,
           case when l_returnflag = 'R' then null when l_discount = 0 then 0 else l_quantity end as value,
           l_orderkey as reading, l_linenumber as line, l_partkey as part
    from lineitem"""


def _readings(v: Views) -> DataFrame:
    value = (F.when(F.col("l_returnflag") == "R", None).when(F.col("l_discount") == 0, F.lit(0.0))
             .otherwise(F.col("l_quantity")))
    return v.t("lineitem").select(
        F.col("l_suppkey").alias("series_id"), F.trunc("l_shipdate", "month").alias("period"), value.alias("value"),
        F.col("l_orderkey").alias("reading"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"))


BEST_SQL = """
    select series_id, period, value, reading, line, part from (
        select *, row_number() over (partition by series_id, period order by
            (value is not null)::int + 2 * coalesce(value > 0, false)::int desc,
            value desc nulls last, reading desc, line desc, part desc) as k from readings) where k = 1"""


@query("dedupe_best", "select * from best", ctes={"readings": READINGS_SQL, "best": BEST_SQL})
def dedupe_best(v: Views) -> DataFrame:
    return R.best_reading(_readings(v), ["series_id", "period"])


@query("duplicate_count", """
    select l_suppkey, l_partkey, count(*) as copies from lineitem group by 1, 2 having count(*) > 1""")
def duplicate_count(v: Views) -> DataFrame:
    return R.duplicate_groups(v.t("lineitem").select("l_suppkey", "l_partkey"))


# --- aggregates -----------------------------------------------------------

@query("invalid_series_strict", f"""
    select series_id, {r('null_share')} as null_share, {r('variance', 6)} as variance, reason from (
        select series_id, count(*) filter (value is null) / count(*) as null_share, var_samp(value) as variance,
               case when count(*) filter (value is null) / count(*) > 0.2 then 'Demasiados nulos'
                    when var_samp(value) < 1e-6 then 'Serie sin varianza' end as reason
        from fx_panel_nulls group by 1) where reason is not null""")
def invalid_series_strict(v: Views) -> DataFrame:
    return Q.invalid_series_strict(v.panel_nulls())


INVALID_SQL = """
    select series_id, 'Serie sin varianza' as reason from fx_panel_nulls group by 1 having var_samp(value) < 1e-6
    union all
    select series_id, 'Demasiados nulos' from fx_panel_nulls group by 1
    having count(value) = 0 or count(*) filter (value is null) / count(value) > 0.4"""


@query("invalid_series", INVALID_SQL)
def invalid_series(v: Views) -> DataFrame:
    return Q.invalid_series(v.panel_nulls())


@query("value_counts", "select code, count(*) as count from fx_visits_old group by 1")
def value_counts(v: Views) -> DataFrame:
    return R.value_counts(v.visits_old(), "code")


@query("distinct_entities", """
    select 'all' as step, count(distinct series_id) as entities from fx_panel_nulls
    union all select 'known', count(distinct series_id) from fx_panel_nulls where value > 150""")
def distinct_entities(v: Views) -> DataFrame:
    panel = v.panel_nulls()
    return R.count_entities(panel, "series_id").select(F.lit("all").alias("step"), "entities").unionByName(
        R.count_entities(panel.filter("value > 150"), "series_id").select(F.lit("known").alias("step"), "entities"))


@query("exclude_low", f"""{PANEL_SQL}
    where series_id not in (select series_id from fx_panel group by 1 having min(value) <= 20)""")
def exclude_low(v: Views) -> DataFrame:
    return Q.exclude_low(v.panel(), 20)


METER_SQL = """
    select p.series_id, p.period, p.value,
           case when d.label = 1 then strftime(d.visit_date, '%Y-%m-%d') else 'SIN CAMBIO MEDIDOR' end as meter_change
    from fx_group_panel p join (
        select series_id, max(visit_date) as visit_date, max(case when code = '1-URGENT' then 1 else 0 end) as label
        from fx_visits_old group by 1) d using (series_id)"""


@query("exclude_recent", f"""
    select series_id, period, {r('value', 2)} as value from meters where series_id not in (
        select series_id from meters where meter_change <> 'SIN CAMBIO MEDIDOR'
        and cast(meter_change as date) >= (select make_date(max(period), 1, 1) - interval 24 month from meters))""",
       digits=2, ctes={"meters": METER_SQL})
def exclude_recent(v: Views) -> DataFrame:
    changes = v.visits_old().groupBy("series_id").agg(
        F.max("visit_date").alias("d"), F.max((F.col("code") == "1-URGENT").cast("int")).alias("l"))
    change = F.when(F.col("l") == 1, F.date_format("d", "yyyy-MM-dd")).otherwise(F.lit(Q.NO_METER_CHANGE))
    rows = v.group_panel().join(changes, "series_id").select(
        "series_id", "period", F.make_date("period", F.lit(1), F.lit(1)).alias("day"), "value", change.alias("meter_change"))
    return Q.exclude_recent(rows, "meter_change", 24, time_col="day").select("series_id", "period", "value")


@query("exclude_high", f"""
    select series_id, period, {r('value', 2)} as value from fx_group_panel where series_id not in (
        select m.series_id from means m join (select category, quantile_cont(mean, 0.95) as cut from means group by 1) c
        using (category) where m.mean > c.cut)""", digits=2,
       ctes={"means": "select category, series_id, avg(value) as mean from fx_group_panel group by 1, 2"})
def exclude_high(v: Views) -> DataFrame:
    return Q.exclude_high(v.group_panel(), "category").select("series_id", "period", "value")


@query("balanced_panel", f"""{PANEL_SQL}
    where series_id in (select series_id from fx_panel group by 1 having count(distinct period) = 83)""")
def balanced_panel(v: Views) -> DataFrame:
    return Q.balanced(v.panel(), 83)


@query("completeness", """
    select months, count(*) as clients, max(top) as expected, months = max(top) as complete from (
        select months, max(months) over () as top from (select series_id, count(*) as months from fx_user_day group by 1))
    group by months""")
def completeness(v: Views) -> DataFrame:
    return Q.completeness(v.user_day())


@query("mean_median", f"""
    select category, zone, {r('avg(value)', 4)} as mean, {r('median(value)', 4)} as median
    from fx_group_panel group by 1, 2""", digits=4)
def mean_median(v: Views) -> DataFrame:
    return R.mean_and_median(v.group_panel(), ["category", "zone"], "value")


@query("max_score", f"select series_id, {r('max(score)')} as score from fx_ranking group by 1")
def max_score(v: Views) -> DataFrame:
    return R.max_per_id(v.ranking(), "series_id", "score")


@query("latest_per_id", f"""
    select series_id, {r('arg_max(value, period) filter (value is not null)')} as value,
           arg_max(year, period) filter (year is not null) as year
    from (select series_id, period, value, case when month(period) < 7 then cast(year(period) as int) end as year from fx_panel_nulls)
    group by 1""")
def latest_per_id(v: Views) -> DataFrame:
    rows = v.panel_nulls().withColumn("year", F.when(F.month("period") < 7, F.year("period")))
    return R.latest_present(rows, "series_id", "period", ["value", "year"])


@query("describe_scores", f"""
    select count(score) as count, {r('avg(score)', 4)} as mean, {r('stddev_samp(score)', 4)} as std, {r('min(score)', 4)} as min,
           {r('max(score)', 4)} as max, {r('quantile_cont(score, 0.25)', 4)} as q25, {r('median(score)', 4)} as median,
           {r('quantile_cont(score, 0.75)', 4)} as q75
    from fx_ranking""", digits=4)
def describe_scores(v: Views) -> DataFrame:
    return R.describe_score(v.ranking(), "score")


@query("group_mode", """
    select series_id, code from (select series_id, code, row_number() over (partition by series_id
        order by count(*) desc, code) as k from fx_visits_old group by 1, 2) where k = 1""")
def group_mode(v: Views) -> DataFrame:
    return R.most_frequent(v.visits_old(), ["series_id"], "code")


@query("group_cov", f"""
    select zone, category, count(*) as n, {r('avg(period)', 4)} as mu_x, {r('avg(value / 1000)', 4)} as mu_y,
           {r('var_pop(period)', 4)} as var_x, {r('covar_pop(period, value / 1000)', 4)} as cov_xy,
           {r('var_pop(value / 1000)', 4)} as var_y
    from fx_group_panel group by 1, 2""", digits=4)
def group_cov(v: Views) -> DataFrame:
    rows = v.group_panel().withColumn("thousands", F.col("value") / 1000)
    return R.covariance_2d(rows, ["zone", "category"], "period", "thousands")


@query("date_range", """
    select min(period) as first, max(period) as last, strftime(min(period), '%d%m%y') as first_text,
           strftime(max(period), '%d%m%y') as last_text from fx_panel""")
def date_range(v: Views) -> DataFrame:
    return R.date_range(v.panel(), "period")


@query("clients_by_category", """
    select category, count(distinct series_id) as clients from fx_dim
    where series_id in (select series_id from fx_ranking where detector = 'spend' order by score desc, series_id limit 500)
    group by 1""")
def clients_by_category(v: Views) -> DataFrame:
    spend = v.ranking().filter("detector = 'spend'")
    return R.clients_by_category(v.dim(), spend, "series_id", "category", "score", top=500)


@query("coverage_kpi", """
    select count(*) as total, count(*) filter (c.lat is null or c.lon is null) as missing
    from resolved r left join coordinates c on r.address = c.address
    where r.series_id in (select series_id from fx_ranking where detector = 'balance' order by score desc, series_id limit 500)""",
       ctes={**ADDRESS_CTES, "coordinates": COORDINATES_SQL})
def coverage_kpi(v: Views) -> DataFrame:
    top = top_k(v.ranking().filter("detector = 'balance'"), 500, [F.desc("score"), F.asc("series_id")])
    return R.coverage(_resolved(v, top).join(_coordinates(v), "address", "left"))


@query("base_rate", f"""
    select count(distinct series_id) as inspected, count(distinct case when label = 1 then series_id end) as anomalous,
           {r('count(distinct case when label = 1 then series_id end) / count(distinct series_id)')} as rate from fx_truth""")
def base_rate(v: Views) -> DataFrame:
    return R.base_rate(v.truth(), "series_id", "label")


# --- order ----------------------------------------------------------------

@query("sort_multi", """
    select series_id, visit_date, code, row_number() over (order by code desc, visit_date, series_id) as place
    from (select distinct * from fx_visits_old)""")
def sort_multi(v: Views) -> DataFrame:
    """The sorted table, with its place made visible."""
    return global_rank(v.visits_old().distinct(), [F.desc("code"), F.asc("visit_date"), F.asc("series_id")], "place")


@query("global_rank", f"""
    select series_id, {r('score')} as score, row_number() over (order by score desc, series_id) as rank
    from fx_ranking where detector = 'spend'""")
def global_rank_query(v: Views) -> DataFrame:
    spend = v.ranking().filter("detector = 'spend'").select("series_id", "score")
    return global_rank(spend, [F.desc_nulls_last("score"), F.asc("series_id")])


@query("topk", f"""
    select series_id, {r('score')} as score from fx_ranking where detector = 'spend' order by score desc, series_id limit 100""")
def topk(v: Views) -> DataFrame:
    spend = v.ranking().filter("detector = 'spend'").select("series_id", "score")
    return top_k(spend, 100, [F.desc_nulls_last("score"), F.asc("series_id")])


@query("argmax_row", f"""
    select series_id, period, {r('value')} as value from fx_panel order by value desc, series_id, period limit 1""")
def argmax_row(v: Views) -> DataFrame:
    return arg_best(v.panel(), [F.desc("value"), F.asc("series_id"), F.asc("period")])


@query("series_for_ids", f"""
    select series_id, period, {r('value', 2)} as value from fx_group_panel where series_id in (
        select series_id from fx_ranking where detector = 'spend' order by score desc, series_id limit 25)""", digits=2)
def series_for_ids(v: Views) -> DataFrame:
    spend = v.ranking().filter("detector = 'spend'")
    ids = top_k(spend, 25, [F.desc("score"), F.asc("series_id")])
    rows = R.keep_ids(v.group_panel(), ids, ["series_id"])
    return rows.select("series_id", "period", "value").orderBy("series_id", "period")


# --- panel and labels -----------------------------------------------------

@query("build_panel", f"""
    select 'both' as part, p.series_id, make_date(p.period, 6, 1) as period, {r('p.value', 2)} as value, d.zone
    from fx_group_panel p join fx_dim d on p.series_id = d.series_id
    union all
    select 'left_only', series_id, make_date(period, 6, 1), {r('value', 2)}, null from fx_group_panel
    where series_id not in (select series_id from fx_dim)""", digits=2)
def build_panel(v: Views) -> DataFrame:
    readings = v.group_panel().select("series_id", F.col("period").alias("year"), F.lit(6).alias("month"), "value")
    both, alone = P.build_panel(readings, v.dim(), attributes=["zone"])
    both = both.withColumn("part", F.lit("both"))
    return R.union_all(both, alone.withColumn("part", F.lit("left_only"))).select("part", "series_id", "period", "value", "zone")


@query("densify_panel", f"""
    select i.series_id, m.period, {r('b.value')} as value, b.reading
    from (select distinct series_id from best) i
    join (select distinct period from fx_panel) m on true
    left join best b on b.series_id = i.series_id and b.period = m.period""",
       ctes={"readings": READINGS_SQL, "best": BEST_SQL})
def densify_panel(v: Views) -> DataFrame:
    return P.complete_panel(_readings(v)).select("series_id", "period", "value", "reading")


LINEAR_SQL = """
    select series_id, period, case
        when value is not null then value
        when pi is not null and ni is not null then pv + (nv - pv) * (i - pi) / (ni - pi)
        when known = 1 then coalesce(pv, nv)
        when ni is not null then v1 + (v2 - v1) * (i - i1) / (i2 - i1)
        when pi is not null then w2 + (w1 - w2) * (i - j2) / (j1 - j2) end as value
    from (
        select *, last_value(case when value is not null then i end ignore nulls) over back as pi,
               last_value(value ignore nulls) over back as pv,
               first_value(case when value is not null then i end ignore nulls) over ahead as ni,
               first_value(value ignore nulls) over ahead as nv,
               max(case when value is not null and seen = 1 then i end) over whole as i1,
               max(case when value is not null and seen = 1 then value end) over whole as v1,
               max(case when value is not null and seen = 2 then i end) over whole as i2,
               max(case when value is not null and seen = 2 then value end) over whole as v2,
               max(case when value is not null and seen = known then i end) over whole as j1,
               max(case when value is not null and seen = known then value end) over whole as w1,
               max(case when value is not null and seen = known - 1 then i end) over whole as j2,
               max(case when value is not null and seen = known - 1 then value end) over whole as w2
        from (select *, row_number() over (partition by series_id order by period) - 1 as i,
                     count(value) over (partition by series_id order by period) as seen,
                     count(value) over (partition by series_id) as known from fx_panel_nulls)
        window whole as (partition by series_id),
               back as (partition by series_id order by period rows between unbounded preceding and current row),
               ahead as (partition by series_id order by period rows between current row and unbounded following))"""


@query("filter_customers", f"""
    select series_id, period, {r('value', 4)} as value from kept where period > (select max(period) - interval 19 month from kept)
    and series_id in (select series_id from kept where period > (select max(period) - interval 19 month from kept)
                      group by 1 having count(distinct period) = 19)""", digits=4,
       ctes={"filled": LINEAR_SQL, "kept": """
    select * from filled where series_id not in (select series_id from filled group by 1 having min(value) <= 5)"""})
def filter_customers(v: Views) -> DataFrame:
    return Q.filter_customers(v.panel_nulls(), months=19, low_threshold=5, drop_high=False, drop_recent=False, only_balanced=True)


@query("filter_customers_all", f"""
    select series_id, period, {r('value', 4)} as value from k3 where period > (select max(period) - interval 19 month from k3)
    and series_id in (select series_id from k3 where period > (select max(period) - interval 19 month from k3)
                      group by 1 having count(distinct period) = 19)""", digits=4,
       ctes={"filled": LINEAR_SQL,
             "k1": "select * from filled where series_id not in (select series_id from filled group by 1 having min(value) <= 5)",
             "k2": "select * from k1 where not (series_id % 13 = 4 and date '1998-05-01' >= (select max(period) - interval 19 month from k1))",
             "means": "select series_id % 2 as class, series_id, avg(value) as mean from k2 group by all",
             "cuts": "select class, quantile_cont(mean, 0.8) as cut from means group by 1",
             "k3": "select * from k2 where series_id not in (select series_id from means join cuts using (class) where mean > cut)"})
def filter_customers_all(v: Views) -> DataFrame:
    """Text is coerced first; clients with a new meter and those high in their class go too."""
    s = F.col("series_id")
    change = (F.when(s % 13 == 4, "1998-05-01").when(s % 13 == 5, "1992-01-01").when(s % 13 == 6, "no date").otherwise(Q.NO_METER_CHANGE))
    text = v.panel_nulls().select("series_id", F.col("period").cast("string").alias("period"), F.col("value").cast("string").alias("value"),
                                  change.alias("meter_change"), (s % 2).alias("class"))
    return Q.filter_customers(
        Q.coerce(text, ["value"], ["period"]), months=19, low_threshold=5, change_col="meter_change", class_col="class",
        high_quantile=0.8, only_balanced=True).select("series_id", "period", "value")


NO_IMPACT, NOT_APPLICABLE = ["5-LOW", "3-MEDIUM"], ["4-NOT SPECIFIED"]


@query("label_no_impact", """
    select distinct series_id, visit_date, code, case when code in ('5-LOW', '3-MEDIUM') then 0 else 1 end as label
    from fx_visits_old where series_id <> 0 and code <> '4-NOT SPECIFIED'""")
def label_no_impact(v: Views) -> DataFrame:
    return L.label_no_impact(v.visits_old(), no_impact=NO_IMPACT, not_applicable=NOT_APPLICABLE)


@query("label_all_positive", "select distinct series_id, visit_date, code, 1 as label from fx_visits_old where series_id <> 0")
def label_all_positive(v: Views) -> DataFrame:
    return L.label_all_positive(v.visits_old())


@query("label_conform", """
    select distinct series_id, visit_date, code,
           case when code = '5-LOW' then 0 when code = '4-NOT SPECIFIED' then null else 1 end as label
    from fx_visits_old where series_id <> 0""")
def label_conform(v: Views) -> DataFrame:
    return L.label_conform(v.visits_old(), conforming="5-LOW", not_applicable="4-NOT SPECIFIED")


@query("label_new_report", """
    select series_id, visit_date, code, case when code in ('5-LOW', '3-MEDIUM') then 0 else 1 end as label
    from fx_visits_new where code <> '4-NOT SPECIFIED'""")
def label_new_report(v: Views) -> DataFrame:
    return L.label_new_report(v.visits_new(), unknown="4-NOT SPECIFIED", no_impact=NO_IMPACT)


LABELLED_CTES = {
    "old_labels": """select distinct series_id, visit_date, code,
                     case when code = '5-LOW' then 0 when code = '4-NOT SPECIFIED' then null else 1 end as label
                     from fx_visits_old where series_id <> 0""",
    "new_labels": """select series_id, visit_date, code, case when code in ('5-LOW', '3-MEDIUM') then 0 else 1 end as label
                     from fx_visits_new where code <> '4-NOT SPECIFIED'""",
    "o": """select series_id, label as old_label, count(*) as visits, max((visit_date, code)) as l from old_labels group by 1, 2""",
    "n": """select series_id, label as new_label, count(*) as visits, max((visit_date, code)) as l from new_labels group by 1, 2""",
    "final": """
        select series_id, old_label, new_label, label, case when label = new_label then nl[1] else ol[1] end as visit_date,
               case when label = new_label then nl[2] else ol[2] end as code, coalesce(ov, 1) * coalesce(nv, 1) as pairs
        from (select coalesce(o.series_id, n.series_id) as series_id, old_label, new_label,
                     greatest(old_label, new_label) as label, o.l as ol, n.l as nl, o.visits as ov, n.visits as nv
              from o full join n on o.series_id = n.series_id) where label is not null""",
}


def _sources(v: Views) -> tuple[DataFrame, DataFrame]:
    return (L.label_conform(v.visits_old(), conforming="5-LOW", not_applicable="4-NOT SPECIFIED"),
            L.label_new_report(v.visits_new(), unknown="4-NOT SPECIFIED", no_impact=NO_IMPACT))


@query("join_full_reconcile", "select * from final", ctes=LABELLED_CTES)
def join_full_reconcile(v: Views) -> DataFrame:
    return L.reconcile(*_sources(v))


@query("labelled_panel_ids", """
    select series_id, visit_date, label, code from final where series_id in (select series_id from fx_dim)""", ctes=LABELLED_CTES)
def labelled_panel_ids(v: Views) -> DataFrame:
    return L.labelled_panel_ids(*_sources(v), v.dim())


@query("integrate_labels", """
    select series_id, visit_date, code, label, source from (
        select *, row_number() over (partition by series_id, visit_date, code order by o) as k from (
            select series_id, visit_date, code, label, 'visits' as source, 0 as o from old_labels
            union all select series_id, visit_date, code, label, 'report', 1 from new_labels)) where k = 1""",
       ctes={k: LABELLED_CTES[k] for k in ("old_labels", "new_labels")})
def integrate_labels(v: Views) -> DataFrame:
    old, new = _sources(v)
    return L.integrate({"visits": old, "report": new})


@query("customer_dim", "select series_id, category, zone from fx_dim")
def customer_dim(v: Views) -> DataFrame:
    return P.customer_dimension(v.dim(), ["series_id", "category", "zone"])
