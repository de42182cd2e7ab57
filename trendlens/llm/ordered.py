"""Positions of rows inside their key, and ordered digests, without putting a key into one task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from trendlens.llm.common import fresh, shuffle_partitions, written


def runs_of(keys: pa.Array) -> np.ndarray:
    """For every row, where its run of equal keys (null equals null) starts."""
    n = len(keys)
    null = np.asarray(keys.is_null())
    value = np.asarray(keys.fill_null(0))
    change = np.ones(n, bool)
    change[1:] = (value[1:] != value[:-1]) | (null[1:] != null[:-1])
    return np.maximum.accumulate(np.where(change, np.arange(n), 0))


def positions(rows: DataFrame, key: str, order: Sequence[str], out: str, drop: Sequence[str] = (),
              name: str = "positions") -> DataFrame:
    """``rows`` with ``out``: the row's position, from 0, among the rows of its integer ``key`` by ``order``.

    Rows are dealt by ranges of (key, order) and, for rows alike in all of
    these, by where they stood in the input, so a key with any share of the
    rows, even equal ones, lies in as many tasks as its size asks for.  Each
    task counts along its sorted rows; what a key has in earlier tasks is
    added from a table with at most one row per task.  Nulls sort first and
    are one key.  ``drop`` names columns that only the order needs.  The
    result is written, in order, so a lost task cannot renumber rows.
    """
    spark = rows.sparkSession
    salt, run, part, p, k, held, before = fresh([*rows.columns, out], "_salt", "_run", "_part", "_p", "_k", "_held", "_before")
    by = [key, *order, salt]
    dealt = rows.withColumn(salt, F.monotonically_increasing_id()).repartitionByRange(
        shuffle_partitions(spark), *by).sortWithinPartitions(*by).drop(salt, *drop)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, last, carried = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key)
            starts = runs_of(keys)
            at = np.arange(batch.num_rows) - starts
            if last is not None and keys[0].as_py() == last[0]:
                at[starts == 0] += carried
            last, carried = (keys[-1].as_py(),), int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(at, pa.int64()), pa.array(np.full(batch.num_rows, task), pa.int32())],
                names=[*batch.schema.names, run, part])

    schema = StructType([*dealt.schema.fields, StructField(run, LongType()), StructField(part, IntegerType())])
    counted = written(dealt.mapInArrow(count, schema), name)
    runs = counted.groupBy(part, key).agg((F.max(run) + 1).alias(held))
    earlier = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    # at most the first key of each task has rows in earlier tasks: one row a task
    spans = runs.withColumn(before, F.sum(held).over(earlier)).where(F.col(before) > 0).select(
        F.col(part).alias(p), F.col(key).alias(k), before)
    return counted.join(F.broadcast(spans), (F.col(part) == F.col(p)) & F.col(key).eqNullSafe(F.col(k)),
                        "left").withColumn(out, F.col(run) + F.coalesce(before, F.lit(0))).drop(run, part, p, k, before)
