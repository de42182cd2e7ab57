"""Structured Streaming forms of the operators.

- ``running_doc_counts`` (T1): the counted store kept by Spark's state store
  (update mode); every micro-batch writes the changed keys as a delta of the
  published keyed table, compacted into a full copy every few batches.
- ``running_word_top_k`` (T3, exact): running word counts in the state store;
  every micro-batch's top-k is the top-k of the previous top-k and the words
  whose counts just changed (counts only grow, so nothing else can enter).
- ``running_sketch_top_k`` (T2 + T3 bounded): no Spark state at all; the
  snapshot *is* the state -- ``depth x width`` cells plus ``k`` rows.  Every
  micro-batch adds its words' cells, re-estimates its own words and the
  previous top-k against the new cells and keeps k.
- ``running_approx_top_k`` (T3 approximate): Spark's ``approx_top_k``
  summary as a streaming global aggregate; one bounded state row.

Every job checkpoints to a folder under the shared checkpoint directory, so
a restarted query resumes where it stopped (T5: exactly-once state instead of
the reference's replays).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trendlens.operators.sketch import CountMinSketch, SketchParams, sketch_cells
from trendlens.operators.store import STORE_KEYS, doc_store
from trendlens.operators.topk import top_k
from trendlens.operators.words import drop_stop_words, tokens, word_counts
from trendlens.streaming.snapshots import Snapshots, new_attempt


def start_foreach_batch(df: DataFrame, fn, checkpoint: str, output_mode: str, trigger: dict | None,
           name: str | None, state_partitions: int | None = None) -> StreamingQuery:
    """Start ``df`` into ``foreachBatch(fn)``.

    A stateful query keeps as many state partitions as
    ``spark.sql.shuffle.partitions`` says when it first starts (the number is
    then fixed in its checkpoint).  ``state_partitions`` sets it for this query
    alone: Spark runs a stream on a copy of the session taken at start, so the
    caller's setting is restored right after.
    """
    writer = (df.writeStream.outputMode(output_mode).foreachBatch(fn)
                .option("checkpointLocation", checkpoint))
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    if not state_partitions:
        return writer.start()
    conf = df.sparkSession.conf
    before = conf.get("spark.sql.shuffle.partitions")
    conf.set("spark.sql.shuffle.partitions", str(int(state_partitions)))
    try:
        return writer.start()
    finally:
        conf.set("spark.sql.shuffle.partitions", before)


def running_doc_counts(posts: DataFrame, snapshots: Snapshots, checkpoint: str,
                       trigger: dict | None = None, name: str | None = None,
                       compact_every: int = 16, state_partitions: int | None = None,
                       id_mode: str = "java") -> StreamingQuery:
    """Running count per distinct text; keyed table ``store`` (``snapshots.read_keyed``).

    ``id_mode``: ``java`` (32-bit ids, parity) or ``sha2`` (no collisions; for many texts).

    Each micro-batch writes only the texts whose counts changed, and a full
    copy every ``compact_every`` batches.
    """
    counts = doc_store(posts, id_mode=id_mode)

    def publish(batch: DataFrame, batch_id: int) -> None:
        changed = batch.select(*STORE_KEYS, "text", "count")
        snapshots.upsert(batch.sparkSession, "store", changed, STORE_KEYS, batch_id, compact_every)

    return start_foreach_batch(counts, publish, checkpoint, "update", trigger, name, state_partitions)


def running_word_top_k(posts: DataFrame, snapshots: Snapshots, checkpoint: str, k: int = 5,
                       stop: DataFrame | None = None, trigger: dict | None = None,
                       name: str | None = None, state_partitions: int | None = None) -> StreamingQuery:
    """T3 exact: running word counts (stop words out); table ``topk`` after each batch."""
    counts = word_counts(drop_stop_words(tokens(posts, "text", out="w"), "w", stop), "w", out="count")

    def publish(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        prev_v = snapshots.latest_version(spark, before=batch_id)
        cand = batch.select("w", "count")
        if prev_v is not None:
            cand = snapshots.read(spark, "topk", prev_v).select("w", "count").unionByName(cand)
            cand = cand.groupBy("w").agg(F.max("count").alias("count"))
        snapshots.publish(spark, {"topk": top_k(cand, k, "count", "w")}, batch_id)

    return start_foreach_batch(counts, publish, checkpoint, "update", trigger, name, state_partitions)


def running_sketch_top_k(posts: DataFrame, snapshots: Snapshots, checkpoint: str, k: int = 5,
                         params: SketchParams = SketchParams(), stop: DataFrame | None = None,
                         trigger: dict | None = None, name: str | None = None,
                         state_partitions: int | None = None) -> StreamingQuery:
    """T2 + T3 bounded: tables ``cells`` (the sketch) and ``topk`` after each batch."""
    words = drop_stop_words(tokens(posts, "text", out="w"), "w", stop)

    def publish(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        prev_v = snapshots.latest_version(spark, before=batch_id)
        # two jobs use this micro-batch: count its words once and keep the counts
        counts = word_counts(batch, "w", out="n").persist()
        try:
            cells = sketch_cells(counts, "w", params, weight_col="n", pre_aggregate=False)
            if prev_v is not None:
                cells = (snapshots.read(spark, "cells", prev_v).unionByName(cells)
                         .groupBy("row", "bucket").agg(F.sum("cnt").cast("bigint").alias("cnt")))
            # write the new cells first, then estimate against the written copy
            attempt = new_attempt()
            cells_path = snapshots.path("cells", batch_id, attempt)
            cells.write.parquet(cells_path)
            sketch = CountMinSketch(spark.read.schema(cells.schema).parquet(cells_path), params)
            cand = counts.select("w")
            if prev_v is not None:
                prev_top = snapshots.read(spark, "topk", prev_v).select("w")
                cand = cand.unionByName(prev_top.join(cand, "w", "left_anti"))
            top = top_k(sketch.estimate(cand, "w", out="estimate", distinct=False), k, "estimate", "w")
            snapshots.publish(spark, {"topk": top}, batch_id, attempt)
        finally:
            counts.unpersist()

    return start_foreach_batch(words, publish, checkpoint, "append", trigger, name, state_partitions)


def running_approx_top_k(posts: DataFrame, snapshots: Snapshots, checkpoint: str, k: int = 5,
                         max_items_tracked: int = 10_000, stop: DataFrame | None = None,
                         trigger: dict | None = None, name: str | None = None,
                         state_partitions: int | None = None) -> StreamingQuery:
    """T3 approximate built-in: Spark's ``approx_top_k`` as a streaming global aggregate.

    The state is one summary row bounded by ``max_items_tracked``; every
    micro-batch publishes the current top-k as table ``topk`` (``w, count``).
    """
    words = drop_stop_words(tokens(posts, "text", out="w"), "w", stop)
    summary = words.agg(F.expr(f"approx_top_k(w, {int(k)}, {int(max_items_tracked)})").alias("_t"))

    def publish(batch: DataFrame, batch_id: int) -> None:
        top = batch.select(F.explode("_t").alias("_e")).select(
            F.col("_e.item").alias("w"), F.col("_e.count").alias("count"))
        snapshots.publish(batch.sparkSession, {"topk": top}, batch_id)

    return start_foreach_batch(summary, publish, checkpoint, "complete", trigger, name, state_partitions)
