"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import written


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every linked node; a component is named by its smallest node.

    ``links`` has two long columns, taken in any direction; loops and repeats
    are harmless, no link gives no row.  Each round joins links to the minimum
    of their node's neighbours (summed up per key before it is shuffled) and
    is written, until a round changes nothing.
    """
    a, b = links.columns
    low, high = F.least(a, b), F.greatest(a, b)
    edges = written(links.where(F.col(a) != F.col(b)).select(high.alias("u"), low.alias("v")).distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("w")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, F.col("u") == F.col("w")).where("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "large-star")
        least = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        small = large.join(least, F.col("u") == F.col("w")).where("v <> m").select(
            F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct()
        edges = written(small, "small-star")
        before, state = state, _state(edges)
        if state == before:
            break
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(members.select(F.col("component").alias("node"), "component")).groupBy("node").agg(
        F.min("component").alias("component"))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]
