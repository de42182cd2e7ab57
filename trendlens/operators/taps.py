"""Pass-through debug taps.

A tap keeps every row.  Instead of printing each row from a task, it attaches
named metrics that Spark aggregates alongside the job (``observe``) and that
the driver reads once the action finishes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def tap(df: DataFrame, name: str, *metrics: Column) -> tuple[DataFrame, Observation]:
    """Return ``(df, observation)``; after an action, ``observation.get`` holds the row count and extras."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *metrics), obs


def with_partition(df: DataFrame, out: str = "partition") -> DataFrame:
    """Append the id of the partition each row sits in."""
    return df.withColumn(out, F.spark_partition_id())


def tap_stream(df: DataFrame, name: str, *metrics: Column) -> DataFrame:
    """Streaming form: metrics per micro-batch appear in ``query.lastProgress['observedMetrics']``."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *metrics)
