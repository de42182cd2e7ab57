"""The fixed cyclic sentence source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The five sentences of the demo word-count stream, in order.
FIXED_SENTENCES: tuple[str, ...] = (
    "the cow jumped over the moon",
    "the man went to the store and bought some candy",
    "four score and seven years ago",
    "how many apples can you eat",
    "to be or not to be the person",
)


def fixed_sentences(spark: SparkSession, cycles: int = 1,
                    sentences: tuple[str, ...] = FIXED_SENTENCES) -> DataFrame:
    """The sentences repeated ``cycles`` times, column ``sentence``.

    Generated from ``spark.range`` so ``cycles`` can be large without a join or
    a driver-side list.
    """
    arr = F.array(*[F.lit(s) for s in sentences])
    n = len(sentences)
    return spark.range(cycles * n).select(
        F.element_at(arr, (F.col("id") % n + 1).cast("int")).alias("sentence"))
