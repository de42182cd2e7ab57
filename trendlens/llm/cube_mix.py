"""Mixing sources to target weights by cube-method balanced sampling.

Each source's target is a number of words.  A row of source ``s`` is taken
``target(s) / size(s)`` times on average: the whole part always, the fraction
as an inclusion probability.  Equal rows (one id, source and size) are a unit:
its rows together are taken so often, and only the fraction that their whole
number of takes leaves is one row's probability.  The cube method turns these probabilities into
zeros and ones while it keeps, within every source, both the words taken and
the rows taken at their expected totals:

- flight: the vector of probabilities moves along directions of the
  constraints' null space until at most two rows of a block stay fractional;
- rows still fractional are gathered into new blocks and fly again, round by
  round (each round leaves two rows of ``BLOCK``), until one block per source
  is left;
- landing: its last rows fly on under the words constraint alone, the last one
  is drawn by its probability, and exchanges of two rows of that block bring
  the words nearer to the target.

All draws come from hashes of the rows, so reruns agree.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlens.llm.common import WORD_PATTERN, fresh, shuffle_partitions, written
from trendlens.llm.ordered import positions

#: Rows of a source that fly together; at most two of them stay fractional.
BLOCK = 512
#: No source is taken more often than this on average.
MOST = 3
#: Weights given to sources in order, repeating.
WEIGHTS = (1, 2, 3)
EPS = 1e-9


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


# -- the cube method on one block ------------------------------------------------

def _move(pi: list[float], at: list[int], direction: list[float], draw: float) -> None:
    """Moves the probabilities at ``at`` along ``direction`` or against it until one is 0 or 1."""
    up = down = math.inf
    for k, u in zip(at, direction, strict=True):
        if u > EPS:
            up, down = min(up, (1 - pi[k]) / u), min(down, pi[k] / u)
        elif u < -EPS:
            up, down = min(up, pi[k] / -u), min(down, (1 - pi[k]) / -u)
    step = up if draw * (up + down) < down else -down
    for k, u in zip(at, direction, strict=True):
        pi[k] += step * u
        if pi[k] < EPS:
            pi[k] = 0.0
        elif pi[k] > 1 - EPS:
            pi[k] = 1.0


def _direction(sizes: list[float]) -> list[float]:
    """A null-space vector of the rows (size, 1) for three units; for two, of the sizes alone."""
    if len(sizes) == 2:
        a, b = sizes
        return [1.0, 0.0] if a == 0 else [0.0, 1.0] if b == 0 else [b / max(a, b), -a / max(a, b)]
    a, b, c = sizes
    u = [b - c, c - a, a - b]
    top = max(map(abs, u))
    return [x / top for x in u] if top else [1.0, -1.0, 0.0]


def fly(pi: np.ndarray, sizes: np.ndarray, draws: np.ndarray, land: bool) -> np.ndarray:
    """The flight phase of one block; with ``land`` the landing phase too (all results 0 or 1)."""
    p, size = pi.tolist(), sizes.astype(float).tolist()
    live: list[int] = []
    for k in range(len(p)):
        if not 0 < p[k] < 1:
            continue
        live.append(k)
        if len(live) == 3:
            _move(p, live, _direction([size[i] for i in live]), float(draws[k]))
            live = [i for i in live if 0 < p[i] < 1]
    if land:
        if len(live) == 2:
            _move(p, live, _direction([size[i] for i in live]), float(draws[live[0]]))
            live = [i for i in live if 0 < p[i] < 1]
        for i in live:
            p[i] = 1.0 if float(draws[i]) < p[i] else 0.0
        return _repair(np.array(p), pi, sizes)
    return np.array(p)


def _repair(taken: np.ndarray, pi: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Brings the words taken nearer to their expectation by exchanging a taken unit for another.

    An exchange keeps the number of rows; each step makes the best one, as
    long as the words' distance from the target shrinks.
    """
    size = sizes.astype(float)
    free = np.flatnonzero((pi > 0) & (pi < 1))
    for _ in range(4):
        error = float(((taken - pi) * size)[free].sum())
        ins = free[taken[free] == 1]
        outs = free[taken[free] == 0]
        if not len(ins) or not len(outs) or abs(error) < 0.5:
            break
        outs = outs[np.argsort(size[outs], kind="stable")]
        wanted = size[ins] - error
        near = np.searchsorted(size[outs], wanted)
        pick = [(abs(error + size[outs[j]] - size[i]), i, outs[j]) for i, k in zip(ins, near, strict=True)
                for j in (k - 1, k) if 0 <= j < len(outs)]
        left, out_of, into = min(pick)
        if left >= abs(error):
            break
        taken[out_of], taken[into] = 0.0, 1.0
    return taken


# -- targets -----------------------------------------------------------------------

def source_targets(sizes: DataFrame, most: float = MOST, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """``source``, ``source_size``, ``target`` from a table of (source, size) rows.

    Sources stand by code point, null last, and weigh ``weights`` in turn;
    they share the words of all, no target exceeds ``most`` times its source,
    and what lies above is shared again by weight.  Sources are numbered by a
    sort over ranges, not in one task.
    """
    totals = written(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    ordered = written(totals.withColumn("null_source", F.col("source").isNull()).repartitionByRange(
        shuffle_partitions(sizes.sparkSession), "null_source", "source").sortWithinPartitions(
        "null_source", "source").withColumn("part", F.spark_partition_id()), "mix-order")
    before = ordered.groupBy("part").count().select(
        F.col("part").alias("b_part"),
        F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("earlier"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("null_source", "source"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = written(
        ordered.withColumn("place", place).join(before, F.col("part") == F.col("b_part")).select(
            "source", "source_size",
            F.get(cycle, ((F.col("place") + F.col("earlier") - 1) % len(weights)).cast("int")).alias("weight")),
        "mix-weights")
    level, capped = None, -1
    while True:
        over = F.lit(False) if level is None else F.col("source_size") * most <= F.col("weight") * level
        row = weighed.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(over, F.col("source_size") * most)).alias("held"),
            F.sum(F.when(~over, F.col("weight"))).alias("weight"), F.count(F.when(over, 1)).alias("capped")).first()
        if row["capped"] == capped or not row["weight"]:
            break
        capped, level = row["capped"], (row["all"] - float(row["held"] or 0)) / row["weight"]
    share = F.least(F.col("weight") * F.lit(level or 0.0), F.col("source_size") * float(most))
    return weighed.select("source", "source_size", share.cast("double").alias("target"))


# -- the mix -------------------------------------------------------------------------

_UNIT = "unit_id long, source string, size long, n long, whole long, pi double, draw long"


def _block_flight(land: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def fly_block(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["draw", "unit_id", "size"], kind="stable").reset_index(drop=True)
        draws = (rows["draw"].to_numpy().astype(np.uint64) >> np.uint64(11)).astype(float) / (1 << 53)
        done = fly(rows["pi"].to_numpy(), rows["size"].to_numpy(), draws, land)
        rows["whole"] = rows["whole"] + (done == 1)
        rows["pi"] = np.where((done == 0) | (done == 1), 0.0, done)
        return rows[["unit_id", "source", "size", "n", "whole", "pi", "draw"]]

    return fly_block


def plan(units: DataFrame, targets: DataFrame, seed: int = 0, block: int = BLOCK) -> DataFrame:
    """``copies`` of every unit's ``n`` rows together: (unit_id, source, size, n) rows with distinct (unit_id, source, size)."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0))
    takes = rate * F.col("n")
    takes = F.when(F.abs(takes - F.round(takes)) < EPS * F.col("n"), F.round(takes)).otherwise(takes)
    t = targets.withColumnRenamed("source", "t_source")
    todo = units.join(t, F.col("source").eqNullSafe(F.col("t_source"))).select(
        "unit_id", "source", "size", "n", F.floor(takes).alias("whole"), (takes - F.floor(takes)).alias("pi"),
        F.xxhash64(F.lit(seed), "unit_id", "source", "size").alias("draw"))
    settled = []
    todo = written(todo, "mix-round")
    while True:
        settled.append(todo.where("pi = 0"))
        todo = todo.where("pi > 0")
        counts = todo.groupBy("source").agg(F.count("*").alias("rows"))
        most = counts.agg(F.max("rows")).first()[0]
        if most is None:
            break
        last = most <= block
        blocks = counts.select(F.col("source").alias("c_source"), F.ceil(F.col("rows") / block).alias("blocks"))
        dealt = todo.join(blocks, F.col("source").eqNullSafe(F.col("c_source"))).withColumn(
            "block", F.pmod(F.xxhash64("draw", F.lit(len(settled))), "blocks"))

        todo = written(dealt.groupBy("source", "block").applyInPandas(_block_flight(last), _UNIT), "mix-round")
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out.select("unit_id", "source", "size", "n", F.col("whole").alias("copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        most: float = MOST, weights: tuple[float, ...] = WEIGHTS, seed: int = 0) -> DataFrame:
    """How often the mix takes each row: one row per row of ``docs``.

    ``id_col``, ``size`` (words, null text: 0), ``source_size``, ``target``,
    ``taken`` (words taken, repeats counted), ``source`` and ``copies``.  A
    null source is a source of its own, last in order.  The takes of rows of
    one id, source and size are dealt over them, no two rows apart by more than
    one; a source without words has rate 1.  An empty table gives no row; other columns are not read.
    """
    sized = _sized(docs, id_col, text_col, source_col)
    planned, targets = _planned(sized, most, weights, seed)
    # one output row for each of a unit's rows, in steps of at most 10,000
    steps = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / 10_000)))
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(10_000), F.col("n") - F.col("step") * 10_000)))
    rows = planned.withColumn("step", steps).withColumn("each", each)
    rows = rows.withColumn("copies", _dealt(F.col("copies"), F.col("n"), F.col("step") * 10_000 + F.col("each") - 1))
    t = targets.withColumnRenamed("source", "t_source")
    return rows.join(t, F.col("source").eqNullSafe(F.col("t_source"))).select(
        F.col("unit_id").alias(id_col), "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


def _dealt(copies: Column, n: Column, at: Column) -> Column:
    """What the row at place ``at`` (from 0) of a unit's ``n`` rows gets of its copies."""
    return F.floor(copies / n) + F.when(at < copies % n, 1).otherwise(0)


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("unit_id"), F.col(source_col).alias("source"),
                       word_count(F.col(text_col)).alias("size"))


def _planned(sized: DataFrame, most: float, weights: tuple[float, ...], seed: int) -> tuple[DataFrame, DataFrame]:
    units = written(sized.groupBy("unit_id", "source", "size").agg(F.count("*").alias("n")), "mix-units")
    sums = units.select("source", (F.col("size") * F.col("n")).alias("size"))
    targets = written(source_targets(sums, most, weights), "mix-targets")
    return plan(units, targets, seed), targets


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    most: float = MOST, weights: tuple[float, ...] = WEIGHTS, seed: int = 0) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, with all columns."""
    planned, _ = _planned(_sized(docs, id_col, text_col, source_col), most, weights, seed)
    uid, usource, usize, un, copies, place, unit, each = fresh(
        docs.columns, "unit_id", "unit_source", "unit_size", "unit_n", "copies", "place", "unit", "each")
    takes = planned.where("copies > 0").select(
        F.col("unit_id").alias(uid), F.col("source").alias(usource), F.col("size").alias(usize), F.col("n").alias(un),
        F.col("copies").alias(copies))
    kept = docs.join(takes, F.col(id_col).cast("long").eqNullSafe(F.col(uid))
                     & F.col(source_col).eqNullSafe(F.col(usource))
                     & (word_count(F.col(text_col)) == F.col(usize)))
    if not planned.where("n > 1").isEmpty():
        # equal rows are numbered, however many there are, to deal out their unit's copies
        many = positions(kept.where(F.col(un) > 1).withColumn(unit, F.xxhash64(uid, usource, usize)), unit, [], place,
                         name="mix-equal")
        dealt = many.withColumn(copies, _dealt(F.col(copies), F.col(un), F.col(place))).drop(unit, place)
        kept = kept.where(F.col(un) == 1).unionByName(dealt.where(F.col(copies) > 0))
    return kept.withColumn(each, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))).select(*docs.columns)
