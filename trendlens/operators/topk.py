"""Ordering and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def order_by_count(df: DataFrame, count_col: str = "count", key_col: str = "text") -> DataFrame:
    """K3: count descending, ties by key ascending."""
    return df.orderBy(F.col(count_col).desc(), F.col(key_col).asc())


def top_k(df: DataFrame, k: int, count_col: str = "count", key_col: str = "word") -> DataFrame:
    """K1/K4: the k rows with the largest ``count_col`` (ties by key).

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: every task keeps
    its own k best rows and only those reach the final merge.
    """
    return order_by_count(df, count_col, key_col).limit(k)


def top_k_string(top: DataFrame, count_col: str = "count", key_col: str = "word",
                 out: str = "topk") -> DataFrame:
    """K2: render top-k rows as ``w1:c1|w2:c2|...|`` in rank order; one row always.

    Input is already cut to k rows, so the single-group ``collect_list`` holds
    at most k entries.  No rows gives the empty string.
    """
    entries = F.array_sort(F.collect_list(F.struct((-F.col(count_col)).alias("neg"), F.col(key_col).alias("k"))))
    rendered = F.transform(entries, lambda e: F.concat(e["k"], F.lit(":"), (-e["neg"]).cast("string"), F.lit("|")))
    return top.agg(F.array_join(rendered, "").alias(out))


def approx_top_k(df: DataFrame, col: str, k: int, max_items_tracked: int = 10_000,
                 out: str = "count") -> DataFrame:
    """K4 approximate built-in: Spark's ``approx_top_k`` aggregate, one row per item.

    The aggregate keeps at most ``max_items_tracked`` candidates per task and
    merges those summaries, so its state is bounded whatever the input.
    """
    summary = df.agg(F.expr(f"approx_top_k(`{col}`, {int(k)}, {int(max_items_tracked)})").alias("_t"))
    return summary.select(F.explode("_t").alias("_e")).select(
        F.col("_e.item").alias(col), F.col("_e.count").alias(out))
