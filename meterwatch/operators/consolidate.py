"""One row per client with what every detector says."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwatch.operators.relational import accumulate


def client_results(
    clients: DataFrame, invalid: DataFrame, gaussian: DataFrame | None = None, cusum: DataFrame | None = None,
    forecasts: DataFrame | None = None, forest: DataFrame | None = None, id_col: str = "series_id",
) -> DataFrame:
    """Full joins on the id. A client with two reasons for exclusion keeps both,
    in one sorted list of at most two."""
    flags = invalid.groupBy(id_col).agg(
        F.array_join(F.sort_array(F.collect_set("reason")), "; ").alias("reason"), F.lit(1).alias("invalid"))
    parts = [clients.select(id_col).distinct(), flags]
    renamed = {"rank_gaussian": gaussian, "rank_cusum": cusum, "rank_forecast": forecasts, "rank_forest": forest}
    for name, table in renamed.items():
        if table is not None:
            parts.append(table.withColumnRenamed("rank", name))
    return accumulate(parts, [id_col])
