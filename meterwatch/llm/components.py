"""Connected components of links between numbers, in rounds of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwatch.llm.common import persist_table


def connected_components(links: DataFrame) -> DataFrame:
    """node, component (smallest node that links reach) for every node of ``links`` (a, b).

    Large-star and small-star rounds: every node hands its larger neighbours to
    its smallest one, then its smaller ones. A round is two aggregates (combined
    before their shuffle) and two joins; its links are written to the shared
    folder, so that a lost executor costs a round at the most. A node with very
    many links is only ever a key of a minimum and of a join that adaptive
    execution can split. Links of a node to itself are allowed, NULL ends are
    left out; without links the result is empty.
    """
    pairs = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"),
                         F.isnull("a").alias("na"), F.isnull("b").alias("nb")).filter("not na and not nb and u > v")
    pairs = persist_table(pairs.select("u", "v").distinct())
    state = _state(pairs)
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: (larger neighbour, smallest of the neighbourhood)
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: smaller neighbours and the node itself go to the smallest one
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").unionByName(
            low.select("u", F.col("m").alias("v"))).distinct()
        pairs = persist_table(small)
        new = _state(pairs)
        if new == state:
            break
        state = new
    roots = pairs.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def component_tops(found: DataFrame, firsts: DataFrame) -> DataFrame:
    """class, top_id, top_key for every node of ``found``: the smallest (first_id, first_key) of its component.

    ``firsts``: class, first_id, first_key. Classes are numbers without an order of
    their own, so rows that share an id can be nodes of their own.
    """
    nodes = found.join(firsts, found["node"] == firsts["class"]).select("class", "component", "first_id", "first_key")
    tops = nodes.groupBy("component").agg(F.min(F.struct("first_id", "first_key")).alias("top"))
    return found.join(tops, "component").select(F.col("node").alias("class"), F.col("top.first_id").alias("top_id"),
                                                F.col("top.first_key").alias("top_key"))


def _state(pairs: DataFrame) -> tuple:
    """Tells one set of links from another."""
    row = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")),
                    F.sum(F.xxhash64("v", "u", F.lit(1)).cast("decimal(20,0)"))).first()
    return tuple(row)
