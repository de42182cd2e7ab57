"""Small helpers the operators share: written tables, ordered prefix sums, column names."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from trendlens.session import scratch_path

# Words of the digests: runs of anything but the six ASCII white-space characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a given table."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """``df`` written to a fresh folder under ``spark.checkpoint.dir`` and read back.

    Cuts the lineage: a lost executor costs the readers nothing, and values
    that a rerun could change (partition numbers, row numbers) are fixed.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    writer = df.write.option("compression", "lz4")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of jobs whose results are written.

    Spark deletes them once the driver's JVM has collected the objects that
    stand for them, which an idle heap may put off for half an hour.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def give_back_memory() -> None:
    """Returns what a task has let go to the system, where the C library can: Spark's Python workers live on."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(taken: Sequence[str], *names: str) -> list[str]:
    """``names``, each lengthened until no column of ``taken`` has it (case ignored, as Spark does)."""
    low = {c.lower() for c in taken}
    out = []
    for name in names:
        while name.lower() in low:
            name = f"_{name}"
        low.add(name.lower())
        out.append(name)
    return out


def same(left: Sequence, right: Sequence):
    """Null-safe equality of two lists of columns, as a join condition."""
    cond = F.lit(True)
    for a, b in zip(left, right, strict=True):
        cond = cond & a.eqNullSafe(b)
    return cond


def prefix_sums(parts: DataFrame, value: str, out: str, part: str, seq: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over all rows before this one by (part, seq).

    Sums run inside a part first, then over parts in blocks of 1,000, then
    over blocks, so no task sees more than one part's rows, 1,000 parts or
    all blocks (a millionth of the rows of parts of 1,000 rows).
    """
    block = F.floor(F.col(part) / 1000)
    before = F.sum(value).over(Window.partitionBy(part).orderBy(seq).rowsBetween(Window.unboundedPreceding, -1))
    totals = parts.groupBy(part).agg(F.sum(value).alias("_total")).withColumn("_block", block)
    in_block = F.sum("_total").over(Window.partitionBy("_block").orderBy(part)
                                    .rowsBetween(Window.unboundedPreceding, -1))
    blocks = totals.groupBy("_block").agg(F.sum("_total").alias("_sum"))
    of_blocks = blocks.select("_block", F.coalesce(
        F.sum("_sum").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_blocks_before"))
    starts = totals.withColumn("_in_block", F.coalesce(in_block, F.lit(0))).join(of_blocks, "_block").select(
        F.col(part).alias("_part"), (F.col("_in_block") + F.col("_blocks_before")).alias("_start"))
    return parts.withColumn("_before", F.coalesce(before, F.lit(0))).join(
        starts, F.col(part) == F.col("_part")).withColumn(
        out, (F.col("_before") + F.col("_start")).cast("long")).drop("_before", "_start", "_part")


def texts(column: pa.Array) -> list[str]:
    """Arrow strings as Python strings, null as empty."""
    return ["" if t is None else t for t in column.to_pylist()]


def batches_of(batch: pa.RecordBatch, column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose strings in ``column`` come to at most ``most_bytes`` (or one row)."""
    lengths = batch.column(column).cast(pa.large_string()).buffers()[1]
    offsets = memoryview(lengths).cast("q")[batch.column(column).cast(pa.large_string()).offset:]
    start, rows = 0, batch.num_rows
    for i in range(1, rows + 1):
        if i == rows or offsets[i + 1] - offsets[start] > most_bytes:
            yield batch.slice(start, i - start)
            start = i
