"""The given tables seen as metered consumption, in Spark and in SQL.

Both forms of a view say the same; the SQL is put in front of an oracle as
common table expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwatch.functions.scalar import exact_sum

SQL_VIEWS = {
    # monthly panel: one series per supplier
    "fx_panel": """
        select l_suppkey as series_id, cast(date_trunc('month', l_shipdate) as date) as period,
               sum(l_quantity) as value
        from lineitem group by all""",
    # the same with gaps and flat series
    "fx_panel_nulls": """
        select series_id, period,
               case when (series_id + month(period)) % 9 = 0 then null
                    when series_id % 10 = 7 and month(period) > 5 then null
                    when series_id % 10 = 3 then cast(100 as double) else value end as value
        from fx_panel""",
    # yearly panel with group attributes: one series per customer
    "fx_group_panel": """
        select o_custkey as series_id, year(o_orderdate) as period, c_mktsegment as category,
               r_name as zone, sum(o_totalprice) as value
        from orders join customer on o_custkey = c_custkey
        join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
        group by all""",
    # daily series with gaps
    "fx_user_day": """
        select user_id as series_id, cast(ts as date) as period, sum(value) as value, count(*) as n_events
        from events group by all""",
    # commercial dimension; some clients have no row
    "fx_dim": """
        select c_custkey as series_id, c_mktsegment as category, n_name as district, r_name as zone,
               case when c_acctbal < 0 then 'debtor' else 'regular' end as product_type
        from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
        where c_acctbal >= -900""",
    # two sources of inspections
    "fx_visits_old": """
        select o_custkey as series_id, cast(o_orderdate as date) as visit_date, o_orderpriority as code
        from orders where o_orderstatus = 'F'""",
    "fx_visits_new": """
        select o_custkey as series_id, cast(o_orderdate as date) as visit_date, o_orderpriority as code
        from orders where o_orderstatus = 'P'""",
    # ground truth, one row per id
    "fx_truth": """
        select series_id, max(case when code in ('1-URGENT', '2-HIGH') then 1 else 0 end) as label
        from fx_visits_old where code <> '4-NOT SPECIFIED' group by series_id""",
    # two detectors
    "fx_ranking": """
        select c_custkey as series_id, 'balance' as detector, round(c_acctbal, 2) as score from customer
        union all
        select series_id, 'spend', round(sum(value), 2) from fx_group_panel group by series_id""",
    "fx_address": """
        select c_custkey as series_id,
               case when c_custkey % 11 = 0 then null
                    else concat('CLL ', cast(c_custkey % 90 as varchar), ' ', cast(c_nationkey as varchar), ' - 0',
                                cast(c_custkey % 40 as varchar), ' APT 3 (X)') end as official,
               case when c_custkey % 22 = 0 then null
                    else concat('K 0', cast(c_custkey % 60 as varchar), ' ', cast(c_nationkey as varchar), ' - ',
                                cast(c_custkey % 40 as varchar)) end as installed
        from customer""",
    "fx_categorical": """
        select p_partkey as series_id, p_brand, p_type,
               case when p_size <= 15 then 'S' when p_size <= 35 then 'M' else 'L' end as size_band
        from part""",
    # label and score with ties
    "fx_scores": """
        select doc_id as series_id, quality as label, cast(doc_id * 37 % 101 as double) / 100 as score
        from labels""",
}


def _names(sql: str) -> list[str]:
    return [n for n in dict.fromkeys(re.findall(r"\bfx_\w+", sql)) if n in SQL_VIEWS]


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """Put the views that ``sql`` names in front of it, and then ``extra``."""
    extra = extra or {}
    wanted: list[str] = []

    def visit(text: str) -> None:
        for name in _names(text):
            if name not in wanted:
                visit(SQL_VIEWS[name])
                if name not in wanted:
                    wanted.append(name)

    for body in [*extra.values(), sql]:
        visit(body)
    parts = [f"{n} as ({SQL_VIEWS[n].strip()})" for n in wanted] + [f"{n} as ({b.strip()})" for n, b in extra.items()]
    recursive = any(re.search(rf"\bfrom {n}\b", b) for n, b in extra.items())
    head = ("with recursive " if recursive else "with ") + ",\n".join(parts) + "\n" if parts else ""
    return head + sql.strip()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Views:
    """The same views as DataFrames over the tables of one directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def t(self, name: str) -> DataFrame:
        return table(self.spark, self.dir, name)

    def panel(self) -> DataFrame:
        return self.t("lineitem").groupBy(
            F.col("l_suppkey").alias("series_id"), F.trunc("l_shipdate", "month").alias("period"),
        ).agg(F.sum("l_quantity").alias("value"))

    def panel_nulls(self) -> DataFrame:
        s, m = F.col("series_id"), F.month("period")
        value = (F.when((s + m) % 9 == 0, None).when((s % 10 == 7) & (m > 5), None)
                 .when(s % 10 == 3, F.lit(100.0)).otherwise(F.col("value")))
        return self.panel().withColumn("value", value)

    def _regions(self) -> DataFrame:
        return self.t("nation").join(self.t("region"), F.col("n_regionkey") == F.col("r_regionkey"))

    def group_panel(self) -> DataFrame:
        # aggregate by customer and year before the dimension joins
        spend = self.t("orders").groupBy("o_custkey", F.year("o_orderdate").alias("period")).agg(
            exact_sum(F.col("o_totalprice")).alias("value"))
        return (spend.join(self.t("customer"), F.col("o_custkey") == F.col("c_custkey"))
                .join(self._regions(), F.col("c_nationkey") == F.col("n_nationkey"))
                .select(F.col("o_custkey").alias("series_id"), "period", F.col("c_mktsegment").alias("category"),
                        F.col("r_name").alias("zone"), "value"))

    def user_day(self) -> DataFrame:
        return self.t("events").groupBy(
            F.col("user_id").alias("series_id"), F.col("ts").cast("date").alias("period"),
        ).agg(F.sum("value").alias("value"), F.count(F.lit(1)).alias("n_events"))

    def dim(self) -> DataFrame:
        kind = F.when(F.col("c_acctbal") < 0, "debtor").otherwise("regular")
        return (self.t("customer").filter("c_acctbal >= -900")
                .join(self._regions(), F.col("c_nationkey") == F.col("n_nationkey"))
                .select(F.col("c_custkey").alias("series_id"), F.col("c_mktsegment").alias("category"),
                        F.col("n_name").alias("district"), F.col("r_name").alias("zone"), kind.alias("product_type")))

    def _visits(self, status: str) -> DataFrame:
        return self.t("orders").filter(F.col("o_orderstatus") == status).select(
            F.col("o_custkey").alias("series_id"), F.col("o_orderdate").cast("date").alias("visit_date"),
            F.col("o_orderpriority").alias("code"))

    def visits_old(self) -> DataFrame:
        return self._visits("F")

    def visits_new(self) -> DataFrame:
        return self._visits("P")

    def truth(self) -> DataFrame:
        bad = F.col("code").isin("1-URGENT", "2-HIGH").cast("int")
        return (self.visits_old().filter(F.col("code") != "4-NOT SPECIFIED")
                .groupBy("series_id").agg(F.max(bad).alias("label")))

    def ranking(self) -> DataFrame:
        balance = self.t("customer").select(
            F.col("c_custkey").alias("series_id"), F.lit("balance").alias("detector"), F.round("c_acctbal", 2).alias("score"))
        spend = self.group_panel().groupBy("series_id").agg(F.round(F.sum("value"), 2).alias("score"))
        return balance.unionByName(spend.select("series_id", F.lit("spend").alias("detector"), "score"))

    def address(self) -> DataFrame:
        k, n = F.col("c_custkey"), F.col("c_nationkey").cast("string")
        official = F.concat(F.lit("CLL "), (k % 90).cast("string"), F.lit(" "), n, F.lit(" - 0"),
                            (k % 40).cast("string"), F.lit(" APT 3 (X)"))
        installed = F.concat(F.lit("K 0"), (k % 60).cast("string"), F.lit(" "), n, F.lit(" - "), (k % 40).cast("string"))
        return self.t("customer").select(
            k.alias("series_id"), F.when(k % 11 != 0, official).alias("official"),
            F.when(k % 22 != 0, installed).alias("installed"))

    def categorical(self) -> DataFrame:
        band = F.when(F.col("p_size") <= 15, "S").when(F.col("p_size") <= 35, "M").otherwise("L")
        return self.t("part").select(F.col("p_partkey").alias("series_id"), "p_brand", "p_type", band.alias("size_band"))

    def scores(self) -> DataFrame:
        return self.t("labels").select(
            F.col("doc_id").alias("series_id"), F.col("quality").alias("label"),
            ((F.col("doc_id") * 37 % 101).cast("double") / 100).alias("score"))
