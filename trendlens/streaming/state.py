"""State that a caller can ask while its stream runs, and state of the user's own.

- ``running_counts_state``: the counted store as the state store holds it, read
  by Spark's state data source from the checkpoint of ``running_doc_counts``: no
  snapshot has to be published for it.
- ``poll``: asks a running query for its state at intervals, once a batch.
- ``running_own_sketch``: a state updater of our own, as the sketch program's
  state is one: ``transformWithState`` keeps, for each part of the words, the
  sketch's counters and a bounded heap of its largest words as one value.  A
  task's equal words are counted before they travel to it, packed in rows of
  many words: PySpark hands the updater its rows one by one.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from trendlens.operators.sketch import CountMinSketch, SketchParams
from trendlens.operators.topk import top_k
from trendlens.operators.words import drop_stop_words, tokens
from trendlens.streaming.running import start_foreach_batch
from trendlens.streaming.snapshots import Snapshots


#: What the state data source says of a checkpoint without a committed batch.
NO_BATCH_YET = ("STDS_COMMITTED_BATCH_UNAVAILABLE", "STDS_OFFSET_LOG_UNAVAILABLE",
                "STDS_OFFSET_METADATA_LOG_UNAVAILABLE", "STDS_NO_PARTITION_DISCOVERED_IN_STATE_STORE")


def running_counts_state(spark: SparkSession, checkpoint: str) -> DataFrame | None:
    """``index, type, id, text, count`` as of the last finished batch of ``running_doc_counts``; None before the first."""
    try:
        state = spark.read.format("statestore").load(checkpoint)
    except PySparkException as e:
        if e.getCondition() not in NO_BATCH_YET:
            raise
        return None
    return state.select("key.index", "key.type", "key.id", F.col("value.min").alias("text"), "value.count")


def poll(query: StreamingQuery, ask: Callable[[], object], every: float = 0.5) -> Iterator[tuple[int, object]]:
    """(batch, answer) for batches of a running query that ``ask`` was put to, and for its last one."""
    asked = -1
    while True:
        active, progress = query.isActive, query.lastProgress
        batch = progress["batchId"] if progress else -1
        if batch > asked:
            asked = batch
            yield batch, ask()
        if not active:
            if query.exception():
                raise RuntimeError(f"the stream failed: {query.exception()}")
            return
        time.sleep(every)


HEAP = 64

#: Words of a packed row, and bytes beyond which it takes no further word; rows that the updater takes in one step.
ROW_WORDS = 128
ROW_BYTES = 4 << 10
STEP_ROWS = 128


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``part, words, counts``: neighbouring words of a part in one row, up to ``ROW_WORDS`` or about ``ROW_BYTES``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = batch.take(pc.array_sort_indices(batch["part"]))
        parts, place = batch["part"].to_numpy(), np.arange(batch.num_rows)
        size = np.cumsum(pc.binary_length(batch["w"]).to_numpy(), dtype=np.int64)
        new = (np.diff(parts) != 0) | (np.diff(place // ROW_WORDS) != 0) | (np.diff(size // ROW_BYTES) != 0)
        starts = np.concatenate([[0], np.flatnonzero(new) + 1])
        offsets = pa.array(np.append(starts, batch.num_rows), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(parts[starts]), pa.ListArray.from_arrays(offsets, batch["w"]),
             pa.ListArray.from_arrays(offsets, batch["n"])], ["part", "words", "counts"])


_OUT = StructType([StructField("part", LongType()), StructField("cells", ArrayType(LongType())),
                   StructField("words", ArrayType(StringType()))])
_STATE = StructType([StructField("cells", ArrayType(LongType())), StructField("words", ArrayType(StringType()))])


class SketchUpdater(StatefulProcessor):
    """One part's state: ``depth x width`` counters, and the ``heap`` words of the largest estimates.

    Rows are packed words and their counts; a batch's rows come as pandas
    frames, and the state is read and written once a batch, whatever the number
    of words.  A word is hashed once each time that it comes.
    """

    def __init__(self, params: SketchParams, heap: int):
        if params.hash != "md5":
            raise ValueError("the state updater hashes by md5")
        self.params, self.heap = params, heap

    def init(self, handle) -> None:
        self.state = handle.getValueState("sketch", _STATE)

    def _slots(self, words: list[str]) -> np.ndarray:
        """Each word's counters: one a row of the sketch."""
        digests = np.frombuffer(b"".join([hashlib.md5(w.encode()).digest()[:8] for w in words]), ">u4").astype(np.int64)
        first, second = digests[0::2, None], digests[1::2, None]
        rows = np.arange(self.params.depth)
        return rows * self.params.width + (first + rows * second) % self.params.width

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.state.get() if self.state.exists() else None
        cells = np.array(held[0] if held else np.zeros(self.params.cells), np.int64)
        words = list(held[1]) if held else []
        slots = self._slots(words)
        for frame in rows:
            for at in range(0, len(frame), STEP_ROWS):
                some = frame.iloc[at:at + STEP_ROWS]
                names = list(chain.from_iterable(some["words"]))
                new = self._slots(names)
                np.add.at(cells, new.ravel(), np.repeat(np.concatenate(some["counts"].tolist()), self.params.depth))
                words, slots = self._largest(cells, words, slots, names, new)
        words = sorted(words)
        self.state.update((cells.tolist(), words))
        yield pd.DataFrame({"part": [int(key[0])], "cells": [cells.tolist()], "words": [words]})

    def _largest(self, cells: np.ndarray, words: list[str], slots: np.ndarray, names: list[str],
                 new: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The words of the largest estimates among those held (``words``) and ``names``, with their counters' places."""
        held, estimates = cells[slots].min(1), cells[new].min(1)
        # no word below a full heap's least can enter
        entering = np.flatnonzero(estimates >= held.min()) if len(words) >= self.heap else np.arange(len(names))
        best = {names[i]: (-estimates[i], names[i], new[i]) for i in entering}
        best.update((w, (-n, w, s)) for w, n, s in zip(words, held, slots, strict=True))
        kept = sorted(best.values(), key=lambda x: x[:2])[:self.heap]
        return [w for _, w, _ in kept], np.array([s for _, _, s in kept]).reshape(-1, self.params.depth)

    def close(self) -> None:
        pass


def running_own_sketch(posts: DataFrame, snapshots: Snapshots, checkpoint: str, params: SketchParams = SketchParams(),
                       heap: int = HEAP, parts: int = 8, stop: DataFrame | None = None, trigger: dict | None = None,
                       name: str | None = None, state_partitions: int | None = None) -> StreamingQuery:
    """U4: sketch and heap per part of the words, kept by ``SketchUpdater``; keyed table ``sketch`` by ``part``.

    A task's equal words are counted before they travel, so a common word is
    one of a task's packed words; a word always goes to one part.
    """
    words = drop_stop_words(tokens(posts, "text", out="w", count="n"), "w", stop)
    dealt = words.select(F.pmod(F.xxhash64("w"), F.lit(parts)).alias("part"), "w", "n")
    packed = dealt.mapInArrow(_pack, "part bigint, words array<string>, counts array<bigint>")
    kept = packed.groupBy("part").transformWithStateInPandas(SketchUpdater(params, heap), _OUT, "update", "none")

    def publish(batch: DataFrame, batch_id: int) -> None:
        snapshots.upsert(batch.sparkSession, "sketch", batch, ["part"], batch_id)

    conf = posts.sparkSession.conf
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(provider)
    conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        return start_foreach_batch(kept, publish, checkpoint, "update", trigger, name, state_partitions)
    finally:
        conf.set(provider, before)


def own_sketch_top_k(state: DataFrame, k: int, params: SketchParams = SketchParams()) -> DataFrame:
    """``w, estimate``: the top-k words of all parts' heaps by the merged sketch (one row a part is read)."""
    cells = state.select(F.posexplode("cells").alias("slot", "cnt")).groupBy("slot").agg(F.sum("cnt").alias("cnt")).select(
        F.floor(F.col("slot") / params.width).cast("int").alias("row"),
        (F.col("slot") % params.width).cast("bigint").alias("bucket"), "cnt")
    words = state.select(F.explode("words").alias("w"))
    return top_k(CountMinSketch(cells, params).estimate(words, "w", out="estimate"), k, "estimate", "w")
