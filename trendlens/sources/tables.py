"""Reading the given Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Session setting that names the fan-out of text scans (unset: none).
FAN_OUT = "spark.trendlens.scan.fanOut"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None,
               fan_out: int | None = None) -> DataFrame:
    """``{sf_dir}/{name}.parquet``; ``columns`` prunes the scan.

    ``fan_out`` deals the rows round-robin to that many tasks.  It is for
    tables in one file with one row group, which a single task would split
    into words alone; tables of many splits need none, and get none unless
    the caller asks.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    return df.repartition(fan_out) if fan_out else df


def session_fan_out(spark: SparkSession) -> int | None:
    """The fan-out that ``spark.trendlens.scan.fanOut`` names, if it is set."""
    value = spark.conf.get(FAN_OUT, None)
    return int(value) if value else None
