"""Building and completing the monthly panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwatch.functions.scalar import month_start
from meterwatch.operators.relational import best_reading, join_with_indicator

# fixed values: column names of the two raw files, by position
COMMERCIAL_COLUMNS = (
    "lv_datcom_id_datcom", "producto", "contrato", "nombre_de_usuario", "direccion_oficial",
    "direccion_de_instalacion", "identificacion_direccion", "fecha_de_instalacion", "tipo_producto",
    "categoria", "subcategoria", "localidad", "barrio", "plan_de_facturacion", "estado_de_corte",
    "cuentas_energia", "saldo_energia", "creacion_producto", "retiro_de_producto", "ciclo",
    "nombre_usuario_oficial", "direccion", "cuentas_total", "saldo_total", "fecha_cargue",
)
CONSUMPTION_COLUMNS = ("lv_cons_id_cons", "ano", "mes", "consumo", "producto", "lv_fecha_server", "lv_user")
ATTRIBUTES = ("localidad", "barrio", "tipo_producto", "categoria", "subcategoria")


def build_panel(
    readings: DataFrame, dimension: DataFrame, id_col: str = "series_id", year: str = "year", month: str = "month",
    attributes: Sequence[str] = ATTRIBUTES, drop: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """(matched panel, readings without a dimension row), dated by month.

    The dimension is cut to the key and ``attributes`` first, so names and
    addresses never enter the join.
    """
    dated = readings.withColumn("period", month_start(F.col(year), F.col(month))).drop(*drop)
    joined = join_with_indicator(dated, dimension.select(id_col, *attributes), [id_col])
    split = {side: joined.filter(F.col("match") == side).drop("match") for side in ("both", "left_only")}
    return split["both"], split["left_only"].drop(*attributes)


def densify(
    df: DataFrame, first: Column | None = None, last: Column | None = None,
    id_col: str = "series_id", time_col: str = "period", step: str = "interval 1 month",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Every id in every period of the range; missing cells are NULL.

    The range comes from the whole table as scalar subqueries; each id explodes
    its own periods, so nothing is crossed. ``carry`` names columns to repeat
    on the filled rows; by default they stay NULL.
    """
    first = df.agg(F.min(time_col)).scalar() if first is None else first
    last = df.agg(F.max(time_col)).scalar() if last is None else last
    ids = df.select(id_col).distinct()
    if carry:
        ids = df.groupBy(id_col).agg(*[F.max(c).alias(f"__k_{c}") for c in carry])
    grid = ids.select(
        id_col, *[f"__k_{c}" for c in carry],
        F.explode(F.sequence(first, last, F.expr(step))).alias(time_col))
    full = grid.join(df, [id_col, time_col], "left")
    return full.select([
        F.coalesce(F.col(c), F.col(f"__k_{c}")).alias(c) if c in carry else F.col(c) for c in df.columns])


def complete_panel(df: DataFrame, id_col: str = "series_id", time_col: str = "period", value: str = "value", **kwargs) -> DataFrame:
    """The best reading per cell, on the full grid."""
    return densify(best_reading(df, [id_col, time_col], value), id_col=id_col, time_col=time_col, **kwargs)


def exclude_periods(df: DataFrame, year_months: Sequence[tuple[int, int]], time_col: str = "period") -> DataFrame:
    """Drop the months that another source already covers."""
    covered = F.lit(False)
    for y, m in year_months:
        covered = covered | ((F.year(time_col) == y) & (F.month(time_col) == m))
    return df.filter(~F.coalesce(covered, F.lit(False)))


def customer_dimension(dim: DataFrame, columns: Sequence[str], id_col: str = "series_id") -> DataFrame:
    return dim.select(*columns).filter(F.col(id_col).isNotNull()).orderBy(id_col)
