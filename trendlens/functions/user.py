"""User functions where built-in ones do not reach.

- a row function gives 0..n rows for a row: a ``udtf``, joined laterally
  (``SplitWords`` is the splitter as one);
- a filter is any boolean Column, or a row function of 0 or 1 rows;
- a reducer has ``init`` and ``reduce``, and ``merge`` to put partial results
  together (``reduce_groups``).

They run in Python workers; the built-in forms (``explode_words``, aggregates)
stay in the JVM and are to be preferred where they exist.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, StructField, StructType


@F.udtf(returnType="w string")
class SplitWords:
    """The words of a text, lower-cased, split on one space; empty pieces and a null text give none."""

    def eval(self, text: str) -> Iterator[tuple[str]]:
        for word in (text or "").lower().split(" "):
            if word:
                yield (word,)


def row_function(df: DataFrame, function, *columns: str) -> DataFrame:
    """``df`` with the rows that a ``udtf`` gives for each of its rows; a row it gives none for goes."""
    return df.alias("_r").lateralJoin(function(*[F.col(f"_r.{c}").outer() for c in columns]))


def reduce_groups(df: DataFrame, keys: list[str], init: Callable[[], Any], reduce: Callable[[Any, dict], Any],
                  merge: Callable[[Any, Any], Any], result: Callable[[Any], dict], schema: StructType,
                  parts: int = 8) -> DataFrame:
    """``keys`` and, of each group, ``result`` of its reduced rows.

    Rows of a group are reduced in ``parts`` parts, each a stream of Arrow
    batches of which one is in memory, and the parts' values are merged; so a
    group with any share of the rows is no single task's.  ``reduce`` takes the
    value so far and a row (a dict), in no particular order; values must
    pickle.
    """
    held = df.schema
    partial_schema = StructType([*[held[k] for k in keys], StructField("_value", BinaryType())])
    whole_schema = StructType([*[held[k] for k in keys], *schema.fields])

    def one(key_row: dict, arrow: pa.Schema, values: dict) -> pa.RecordBatch:
        row = {**{k: key_row[k] for k in keys}, **values}
        return pa.RecordBatch.from_pylist([row], schema=arrow)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value, first = init(), None
        for batch in batches:
            for row in batch.to_pylist():
                first = row if first is None else first
                value = reduce(value, row)
        if first is not None:
            yield one(first, to_arrow_schema(partial_schema), {"_value": pickle.dumps(value)})

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value, first = None, None
        for batch in batches:
            for row in batch.to_pylist():
                more = pickle.loads(row["_value"])
                value, first = (more, row) if first is None else (merge(value, more), first)
        if first is not None:
            yield one(first, to_arrow_schema(whole_schema), result(value))

    part = F.pmod(F.monotonically_increasing_id(), F.lit(parts)).alias("_part")
    reduced = df.select("*", part).groupBy(*keys, "_part").applyInArrow(partial, partial_schema)
    return reduced.groupBy(*keys).applyInArrow(whole, whole_schema)
