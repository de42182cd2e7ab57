"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last seven bytes ends a chunk wherever it is
``block - 1`` modulo the block size; each chunk adds one of 64 letters, from a
hash of the chunk's bytes, to the signature.  The block size is the smallest
of 3, 6, 12, ... that gives at most 64 chunks, so every byte of a text counts.
A fingerprint is ``block:signature:signature at twice the block size``.

Two fingerprints are compared at a block size they share (equal sizes, or one
twice the other): 1 - edit distance / length of the longer signature; 0 where
no size is shared.  Equal texts have equal fingerprints and likeness 1.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlens.llm.common import batches_of, shuffle_partitions, texts, written

WINDOW = 7
SMALLEST = 3
LONGEST = 64
LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+-", np.uint8)

_MIX = np.uint32(0x9E3779B1)
_ODD = 0x9E3779B97F4A7C15
_SPREAD = np.uint64(_ODD)


class _Powers:
    """Powers of an odd number modulo 2**64, as many as the longest text has needed."""

    def __init__(self, base: int):
        self.base, self.known = np.uint64(base), np.ones(1, np.uint64)

    def __call__(self, n: int) -> np.ndarray:
        if len(self.known) < n:
            self.known = np.concatenate([[np.uint64(1)], np.cumprod(np.full(2 * n, self.base, np.uint64))])
        return self.known[:n]


_UP, _DOWN = _Powers(_ODD), _Powers(pow(_ODD, -1, 1 << 64))


def fingerprint(data: bytes) -> str:
    """The fingerprint of some bytes; of none: ``3::``."""
    n = len(data)
    if not n:
        return f"{SMALLEST}::"
    raw = np.frombuffer(data, np.uint8)
    wide = raw.astype(np.uint32) + np.uint32(1)
    rolling, factor = np.zeros(n, np.uint32), np.uint32(1)
    for k in range(min(WINDOW, n)):
        rolling[k:] += wide[:n - k] * factor
        factor = np.uint32((int(factor) * 0x01000193 + 2) & 0xFFFFFFFF)
    rolling = (rolling ^ (rolling >> np.uint32(15))) * _MIX
    rolling ^= rolling >> np.uint32(13)
    # a chunk's hash is a polynomial: the difference of two prefix sums, divided by the power its first byte has
    sums = np.concatenate([[np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(0x100)) * _UP(n))])
    down = _DOWN(n)

    def ends(block: int, among: np.ndarray) -> np.ndarray:
        # multiples of twice a block are multiples of the block: each size looks among the last one's ends
        return among[rolling[among] % np.uint32(block) == block - 1]

    def signature(cut: np.ndarray) -> str:
        stops = cut + 1
        if not len(stops) or stops[-1] != n:
            stops = np.append(stops, n)
        starts = np.concatenate([[0], stops[:-1]])
        code = (sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64)
        code = (code ^ (code >> np.uint64(29))) * _SPREAD
        return LETTERS[(code >> np.uint64(58)).astype(np.int64)].tobytes().decode()

    block = SMALLEST
    cut = np.flatnonzero(rolling % np.uint32(block) == block - 1)
    while len(cut) + (not len(cut) or cut[-1] != n - 1) > LONGEST:
        block *= 2
        cut = ends(block, cut)
    return f"{block}:{signature(cut)}:{signature(ends(2 * block, cut))}"


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two fingerprint columns, 0 to 1."""
    pa_, pb = F.split(a, ":"), F.split(b, ":")
    size_a, size_b = pa_[0].cast("long"), pb[0].cast("long")

    def at(x: Column, y: Column) -> Column:
        longest = F.greatest(F.length(x), F.length(y))
        return F.when(longest == 0, F.lit(1.0)).otherwise(1.0 - F.levenshtein(x, y) / longest)

    return (F.when(a == b, F.lit(1.0))
            .when(size_a == size_b, F.greatest(at(pa_[1], pb[1]), at(pa_[2], pb[2])))
            .when(size_a == 2 * size_b, at(pa_[1], pb[2]))
            .when(size_b == 2 * size_a, at(pa_[2], pb[1]))
            .otherwise(F.lit(0.0)))


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of the start of ``following`` (or all of it)."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


_ROW = ("kind string, part int, doc_id long, n_chars long, text string, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, next_fingerprint string")
_KINDS = [pa.string(), pa.int32(), pa.int64(), pa.int64(), *[pa.string()] * 5]
_NAMES = [c.split()[0] for c in _ROW.split(", ")]


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, compared to each other and to the next document's.

    The next document follows in descending order of id (null ids last; rows
    of one id by their text's hash, then text); the last one's next is the
    first.  A single document is its own next.  Null text counts as empty, an
    empty table gives no row, other columns are not read.

    Documents are sorted into ranges; each task streams its range and keeps
    one document back.  Only the first and the last document of a range are
    joined to those of its neighbours.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows, held = TaskContext.get().partitionId(), [], None
        for whole in batches:
            for batch in batches_of(whole, "text"):
                for key, text in zip(batch.column("id").to_pylist(), texts(batch.column("text")), strict=True):
                    own = fingerprint(text.encode())
                    if held is None:
                        rows.append(("head", part, key, len(text), text, None, own, None, None))
                    else:
                        rows.append(done(part, *held, text, own))
                    held = (key, text, own)
                if rows:
                    yield pack(rows)
                    rows = []
        if held is not None:
            key, text, own = held
            yield pack([("tail", part, key, len(text), text, None, own, None, None)])

    def done(part, key, text, own, next_text, next_own) -> tuple:
        new = edited(text, next_text).encode()
        return ("done", part, key, len(text), None, hashlib.sha256(new).hexdigest(), own, fingerprint(new), next_own)

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)],
                                          names=_NAMES)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [done(r["part"], r["doc_id"], r["text"], r["fingerprint"], r["next_text"], r["next_own"])
                    for r in batch.to_pylist()]
            if rows:
                yield pack(rows)

    n = shuffle_partitions(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = slim.withColumn("tie", F.xxhash64("text")).repartitionByRange(
        n, F.desc_nulls_last("id"), "tie").sortWithinPartitions(F.desc_nulls_last("id"), "tie", "text")
    rows = written(ordered.select("id", "text").mapInArrow(run, _ROW), "fingerprints", "kind")
    heads = rows.where("kind = 'head'").select(F.col("part").alias("head_part"), F.col("text").alias("next_text"),
                                               F.col("fingerprint").alias("next_own"))
    # one row per range that holds documents, without texts: the following range, or the first after the last
    places = heads.select("head_part")
    following = places.select("head_part", F.coalesce(
        F.lead("head_part").over(Window.orderBy("head_part")),
        F.min("head_part").over(Window.partitionBy())).alias("following"))
    tails = rows.where("kind = 'tail'").drop("kind", "next_fingerprint")
    paired = tails.join(following, F.col("part") == F.col("head_part")).drop("head_part").join(
        heads, F.col("following") == F.col("head_part"))
    last = paired.select("part", "doc_id", "text", "fingerprint", "next_text", "next_own").mapInArrow(join, _ROW)
    every = rows.where("kind = 'done'").select(*_NAMES).unionByName(last)
    return every.select(
        F.col("doc_id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
