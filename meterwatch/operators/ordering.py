"""Exact ranks, running sums and quantiles without a single-task window.

All three come from one range partitioning on the wanted order. Rows keep
their place in a written table, so a lost executor cannot change a rank.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterwatch.session import persist_table

_POS, _PART = "__pos", "__part"


def ordered_prefix(
    df: DataFrame,
    order: Sequence[Column],
    group: Sequence[str] = (),
    rank: str | None = "rank",
    sums: Mapping[str, str] | None = None,
    totals: Mapping[str, str] | None = None,
) -> DataFrame:
    """Row number, running sums and totals of each group, in a total order.

    ``order`` must end in a unique key. A group of any size spreads over many
    range partitions; the offsets need one row per (partition, group) only.
    ``sums`` and ``totals`` map new column names to the columns to add up.
    """
    sums, totals = dict(sums or {}), dict(totals or {})
    columns = df.columns
    keys = [F.col(g).asc() for g in group] + list(order)
    placed = persist_table(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn(_PART, F.spark_partition_id())
        .withColumn(_POS, F.monotonically_increasing_id())
    )

    chunk = [*group, _PART]
    measures = [F.count(F.lit(1)).alias("__n"), F.min(_POS).alias("__start")]
    measures += [F.sum(c).alias(f"__s_{name}") for name, c in sums.items()]
    measures += [F.sum(c).alias(f"__t_{name}") for name, c in totals.items()]
    chunks = placed.groupBy(*chunk).agg(*measures)
    # one row per range partition that a group touches: small for every group
    whole = Window.partitionBy(*[F.col(g) for g in group])
    before = whole.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select(
        *[F.col(c).alias(f"__c_{c}") for c in chunk],
        "__start",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__rows_before"),
        *[F.coalesce(F.sum(f"__s_{n}").over(before), F.lit(0)).alias(f"__before_{n}") for n in sums],
        *[F.sum(f"__t_{n}").over(whole).alias(f"__all_{n}") for n in totals],
    )

    if sums:
        inside = Window.partitionBy(*chunk).orderBy(_POS).rowsBetween(Window.unboundedPreceding, 0)
        placed = placed.select("*", *[F.sum(c).over(inside).alias(f"__in_{n}") for n, c in sums.items()])
    match = F.lit(True)
    for c in chunk:
        match = match & F.col(c).eqNullSafe(F.col(f"__c_{c}"))
    joined = placed.join(chunks, match, "inner")
    out = [F.col(c) for c in columns]
    if rank:
        out.append((F.col(_POS) - F.col("__start") + F.col("__rows_before") + 1).cast("long").alias(rank))
    out += [(F.col(f"__before_{n}") + F.col(f"__in_{n}")).alias(n) for n in sums]
    out += [F.col(f"__all_{n}").alias(n) for n in totals]
    return joined.select(*out)


def global_rank(df: DataFrame, order: Sequence[Column], rank: str = "rank", group: Sequence[str] = ()) -> DataFrame:
    """Row number in a total order over the whole table (or per group)."""
    return ordered_prefix(df, order, group, rank=rank)


def exact_quantiles(
    df: DataFrame, value: str, probs: Mapping[str, float], group: Sequence[str] = (),
) -> DataFrame:
    """Exact quantiles with linear interpolation, for groups of any size.

    Equal values are counted before any shuffle on order, so that no task has
    to hold a whole group.
    """
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*group, F.col(value).alias("__v"))
        .agg(F.count(F.lit(1)).alias("__c"))
    )
    running = ordered_prefix(counts, [F.col("__v").asc()], group, rank=None,
                             sums={"__cum": "__c"}, totals={"__total": "__c"})

    def place(p: float) -> Column:
        return F.lit(float(p)) * (F.col("__total") - 1)

    wanted = []
    for name, p in probs.items():
        low, high = F.floor(place(p)), F.ceil(place(p))
        wanted.append(F.min(F.when(F.col("__cum") > low, F.col("__v"))).alias(f"__lo_{name}"))
        wanted.append(F.min(F.when(F.col("__cum") > high, F.col("__v"))).alias(f"__hi_{name}"))
    picked = running.groupBy(*group).agg(F.max("__total").alias("__total"), *wanted)
    out = [F.col(g) for g in group]
    for name, p in probs.items():
        share = place(p) - F.floor(place(p))
        lo, hi = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        out.append((lo + (hi - lo) * share).alias(name))
    return picked.select(*out)


def top_k(df: DataFrame, k: int | None, order: Sequence[Column]) -> DataFrame:
    """First ``k`` rows in the order; ``None`` keeps all (sorted)."""
    ordered = df.orderBy(*order)
    return ordered if k is None else ordered.limit(k)


def arg_best(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The first row in the order."""
    return df.orderBy(*order).limit(1)
