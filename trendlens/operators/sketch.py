"""Count-min sketch as a relational table.

A sketch is a DataFrame of cells ``(row int, bucket bigint, cnt bigint)`` plus
its parameters.  Each item hashes once (two 32-bit words of its md5) and is
spread over ``depth`` rows by double hashing, ``bucket_i = (h1 + i*h2) mod width``.

Building is one aggregation on ``(row, bucket)``: every task combines its own
items into at most ``depth x width`` partial cells before that shuffle.  By
default items are counted first, a shuffle of each task's distinct items.
Estimating packs the cells of ``BLOCK`` neighbouring buckets of a row into one
row (no row holds more, however wide the sketch); an item's ``depth`` positions
join to their blocks, and the least of the cells found is its estimate.  Blocks
are broadcast while the parameters say that all cells take at most
``BROADCAST_BYTES``; a larger sketch is joined by block.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.functions.hashing import HASH_KINDS, base_hashes, bucket

CELL_SCHEMA = "row int, bucket bigint, cnt bigint"

#: Buckets of a block, and the size up to which all blocks are broadcast.
BLOCK = 64
BROADCAST_BYTES = 8 << 20


class SketchMergeError(ValueError):
    """Raised when sketches with different depth, width or seed are merged."""


@dataclass(frozen=True)
class SketchParams:
    """Shape of a sketch: ``depth`` hash rows of ``width`` counters.

    ``seed`` tags compatibility; ``hash`` picks the item hash (``md5``, the
    portable default, or the cheaper ``xxhash64``).  Sketches merge only when
    all four agree.
    """

    depth: int = 15
    width: int = 1000
    seed: int = 10
    hash: str = "md5"

    def __post_init__(self) -> None:
        if self.depth < 1 or self.width < 1:
            raise ValueError(f"a sketch needs at least one row and one bucket, not {self.depth} x {self.width}")
        if self.hash not in HASH_KINDS:
            raise ValueError(f"unknown hash {self.hash!r}; expected one of {HASH_KINDS}")

    @classmethod
    def from_error(cls, eps: float, confidence: float, seed: int = 10, hash: str = "md5") -> SketchParams:
        """width = ceil(2 / eps), depth = ceil(-log2(1 - confidence))."""
        width = int(math.ceil(2 / eps))
        depth = int(math.ceil(-math.log(1 - confidence) / math.log(2)))
        return cls(depth=depth, width=width, seed=seed, hash=hash)

    @property
    def relative_error(self) -> float:
        """A9 inverse: eps = 2 / width."""
        return 2 / self.width

    @property
    def confidence(self) -> float:
        """A9 inverse: confidence = 1 - 2^-depth."""
        return 1 - 0.5 ** self.depth

    @property
    def cells(self) -> int:
        return self.depth * self.width


def _weight(weight_col: str | None) -> Column:
    if weight_col is None:
        return F.lit(1).cast("bigint")
    n = F.col(weight_col).cast("bigint")
    return F.when(n < 0, F.raise_error(F.lit("a count cannot go down: weights must be 0 or more"))).otherwise(n)


def item_cells(df: DataFrame, col: str, params: SketchParams, keep: list[str] | None = None,
               weight_col: str | None = None) -> DataFrame:
    """The ``depth`` cells of every row's item: ``(*keep, row, bucket[, n])``."""
    h1, h2 = base_hashes(F.col(col), params.hash)
    cols = [F.col(k) for k in (keep or [])]
    hashed = df.select(*cols, h1.alias("_h1"), h2.alias("_h2"), _weight(weight_col).alias("_wt"))
    rows = hashed.select(*cols, "_h1", "_h2", "_wt",
                         F.explode(F.sequence(F.lit(0), F.lit(params.depth - 1))).alias("row"))
    return rows.select(*cols, "row", bucket(F.col("_h1"), F.col("_h2"), F.col("row"), params.width).alias("bucket"),
                       F.col("_wt").alias("n"))


def sketch_cells(df: DataFrame, col: str, params: SketchParams, weight_col: str | None = None,
                 pre_aggregate: bool = True) -> DataFrame:
    """A4: the sketch table of the items in ``col`` (each row adds ``weight_col`` or 1).

    With ``pre_aggregate`` (the default) rows are first summed per item, so
    each distinct item is hashed and spread over ``depth`` rows once; the
    item-level shuffle carries only every task's distinct items.  For items
    that barely repeat (ids), ``pre_aggregate=False`` hashes every row and
    shuffles nothing but each task's ``depth x width`` partial cells.
    """
    items = df.where(F.col(col).isNotNull())
    if pre_aggregate:
        items = items.groupBy(col).agg(F.sum(_weight(weight_col)).alias("_sum"))
        weight_col = "_sum"
    cells = item_cells(items, col, params, weight_col=weight_col)
    return cells.groupBy("row", "bucket").agg(F.sum("n").alias("cnt"))


@dataclass(frozen=True)
class CountMinSketch:
    """A sketch table with its parameters."""

    cells: DataFrame
    params: SketchParams

    def total(self) -> DataFrame:
        """A10: total weight added (every hash row sums to it); one row ``total``."""
        return self.cells.where(F.col("row") == 0).agg(F.coalesce(F.sum("cnt"), F.lit(0)).cast("bigint").alias("total"))

    def _blocks(self) -> DataFrame:
        """``_slot, _cells``: the counters of ``BLOCK`` buckets of a row, by offset; a block without any is absent."""
        per_row = -(-self.params.width // BLOCK)
        slot = F.col("row").cast("bigint") * per_row + F.floor(F.col("bucket") / BLOCK)
        held = self.cells.select(slot.alias("_slot"), F.struct(
            (F.col("bucket") % BLOCK).cast("int").alias("at"), "cnt").alias("_cell"))
        # at most BLOCK cells; most blocks of a used sketch are full, and then sorting them is all
        packed = held.groupBy("_slot").agg(F.array_sort(F.collect_list("_cell")).alias("_held"))
        by_offset = F.map_from_entries("_held")
        return packed.select("_slot", F.when(
            F.size("_held") == BLOCK, F.transform("_held", lambda c: c["cnt"])).otherwise(
            F.transform(F.sequence(F.lit(0), F.lit(BLOCK - 1)), lambda i: F.coalesce(
                F.element_at(by_offset, i), F.lit(0).cast("bigint")))).alias("_cells"))

    def estimate(self, items: DataFrame, col: str = "w", out: str = "estimate",
                 distinct: bool = True, own_count_col: str | None = None) -> DataFrame:
        """A5: ``(col, out)`` with the point estimate of every distinct item.

        The estimate is the minimum over the item's ``depth`` cells; a cell
        never written counts 0.  Pass ``distinct=False`` when ``items`` is
        already one row per item (for example the output of a group-by).

        ``own_count_col`` names the weight each item added when this sketch
        was built from these same rows.  Every cell of an item holds at least
        that weight, so folding it into the minimum never changes the result;
        it keeps the column alive so the item rows feeding the build and the
        estimate are one plan, and Spark computes their shuffle once.
        """
        cols = [col] + ([own_count_col] if own_count_col else [])
        asked = items.select(*cols).where(F.col(col).isNotNull())
        if distinct:
            asked = asked.distinct()
        h1, h2 = base_hashes(F.col(col), self.params.hash)
        hashed = asked.select(*cols, h1.alias("_h1"), h2.alias("_h2"))
        width, per_row = self.params.width, -(-self.params.width // BLOCK)
        spots = hashed.select(*cols, F.explode(F.array(*[
            F.lit(r).cast("bigint") * per_row * BLOCK + bucket(F.col("_h1"), F.col("_h2"), r, width)
            for r in range(self.params.depth)])).alias("_spot"))
        spots = spots.select(*cols, F.shiftright("_spot", BLOCK.bit_length() - 1).alias("_slot"),
                             F.col("_spot").bitwiseAND(F.lit(BLOCK - 1)).cast("int").alias("_at"))
        blocks = self._blocks()
        if self.params.cells * 8 <= BROADCAST_BYTES:
            blocks = F.broadcast(blocks)
        found = spots.join(blocks, "_slot", "left").select(*cols, F.coalesce(
            F.get("_cells", F.col("_at")), F.lit(0).cast("bigint")).alias("_cell"))
        least = F.min("_cell")
        if own_count_col:
            least = F.greatest(least, F.max(own_count_col))
        return found.groupBy(col).agg(least.cast("bigint").alias(out))

    def save(self, path: str, mode: str = "overwrite") -> None:
        """Cells and parameters as Parquet under ``path``."""
        spark = self.cells.sparkSession
        self.cells.write.mode(mode).parquet(f"{path}/cells")
        spark.createDataFrame([(self.params.depth, self.params.width, self.params.seed, self.params.hash)],
                              "depth int, width int, seed int, hash string").write.mode(mode).parquet(f"{path}/params")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> CountMinSketch:
        """Read a sketch written by ``save``."""
        p = spark.read.parquet(f"{path}/params").first()
        return cls(spark.read.parquet(f"{path}/cells"), SketchParams(p["depth"], p["width"], p["seed"], p["hash"]))


def build_sketch(df: DataFrame, col: str, params: SketchParams = SketchParams(),
                 weight_col: str | None = None, pre_aggregate: bool = True) -> CountMinSketch:
    """Sketch of ``col`` (strings, or integers hashed by their decimal text)."""
    return CountMinSketch(sketch_cells(df, col, params, weight_col, pre_aggregate), params)


def build_sketches_by(df: DataFrame, col: str, part: Column, parts: list, params: SketchParams = SketchParams(),
                      weight_col: str | None = None) -> dict:
    """One sketch per value of ``part`` in ``parts``, all from a single pass over ``df``.

    Items are counted per ``(part, item)``, spread over the hash rows and
    summed per ``(row, bucket)`` with one sum per part (a pivot of a known,
    small set of parts).  Each returned sketch is a projection of that one
    aggregate -- the only filter drops its empty cells and reads an
    aggregated value, so Spark cannot push it back into the scan -- and the
    input is read once whatever the number of parts.
    """
    items = df.where(F.col(col).isNotNull()).select(part.alias("_part"), F.col(col),
                                                    _weight(weight_col).alias("_w"))
    counts = items.groupBy("_part", col).agg(F.sum("_w").alias("_sum"))
    spread = item_cells(counts, col, params, keep=["_part"], weight_col="_sum")
    sums = [F.sum(F.when(F.col("_part") == F.lit(p), F.col("n")).otherwise(F.lit(0))).alias(f"_c{i}")
            for i, p in enumerate(parts)]
    cells = spread.groupBy("row", "bucket").agg(*sums)
    # every cell row holds some weight, so ``greatest(all sums) > 0`` is always
    # true; reading all sums keeps the projections on one identical aggregate
    # (column pruning would otherwise give each part its own copy of it)
    any_part = F.greatest(*[F.col(f"_c{i}") for i in range(len(parts))]) > 0 if len(parts) > 1 else F.lit(True)
    return {p: CountMinSketch(cells.where(any_part & (F.col(f"_c{i}") > 0))
                              .select("row", "bucket", F.col(f"_c{i}").cast("bigint").alias("cnt")), params)
            for i, p in enumerate(parts)}


def sketch_blob(df: DataFrame, col: str, eps: float, confidence: float, seed: int = 10,
                out: str = "sketch") -> DataFrame:
    """A4 blob form: Spark's built-in ``count_min_sketch`` aggregate as one binary row.

    Compact to store and ship, but Spark SQL has no reader for it; the table
    form above is the one the estimate, merge and top-k operators use.
    """
    return df.agg(F.count_min_sketch(F.col(col), F.lit(eps), F.lit(confidence), F.lit(seed)).alias(out))


def merge_sketches(*sketches: CountMinSketch) -> CountMinSketch | None:
    """Cell-wise sum; ``None`` when given none; error on a shape or seed mismatch."""
    if not sketches:
        return None
    first = sketches[0].params
    for s in sketches[1:]:
        if s.params != first:
            raise SketchMergeError(f"cannot merge sketches with parameters {first} and {s.params}")
    union = sketches[0].cells
    for s in sketches[1:]:
        union = union.unionByName(s.cells)
    merged = union.groupBy("row", "bucket").agg(F.sum("cnt").cast("bigint").alias("cnt"))
    return CountMinSketch(merged, first)


def lookup_counts(sketch: CountMinSketch, requests: DataFrame, col: str = "query",
                  out: str = "count", stop: DataFrame | None | bool = None) -> DataFrame:
    """J1 + A5: every request row gets the estimate of its word; stop words get 0.

    ``stop=False`` disables the stop-word rule; ``None`` uses the bundled list.
    """
    from trendlens.operators.words import flag_stop_words

    est = sketch.estimate(requests, col, out="_est")
    joined = requests.join(est, col, "left")
    if stop is False:
        return joined.withColumn(out, F.coalesce(F.col("_est"), F.lit(0)).cast("bigint")).drop("_est")
    flagged = flag_stop_words(joined, col, None if stop is None else stop)
    value = F.when(F.col("is_stop"), F.lit(0)).otherwise(F.coalesce(F.col("_est"), F.lit(0)))
    return flagged.withColumn(out, value.cast("bigint")).drop("_est", "is_stop")


def sketch_estimates(items: DataFrame, col: str, params: SketchParams = SketchParams(),
                     out: str = "estimate") -> tuple[DataFrame, CountMinSketch]:
    """A4 + A5 over one input: sketch every item of ``col`` and estimate each distinct item.

    Items are counted once (one shuffle by item, combined map-side); the
    sketch is built from those counts and the same counts are estimated, so
    Spark plans one item shuffle for both.  Result ``(col, out)``.
    """
    from trendlens.operators.words import word_counts

    counts = word_counts(items.where(F.col(col).isNotNull()), col, out="_n")
    sketch = build_sketch(counts, col, params, weight_col="_n", pre_aggregate=False)
    return sketch.estimate(counts, col, out=out, distinct=False, own_count_col="_n"), sketch


def sketch_top_k(words: DataFrame, k: int = 5, col: str = "w", params: SketchParams = SketchParams(),
                 stop: DataFrame | None | bool = None) -> tuple[DataFrame, CountMinSketch]:
    """K1: stop words out, sketch the rest, top-k words by their estimate.

    Words are counted first (one shuffle by word, partially aggregated in
    every task); the sketch is built from those counts and every distinct
    word is then estimated against it.  Result columns ``(col, estimate)``.
    """
    from trendlens.operators.topk import top_k
    from trendlens.operators.words import drop_stop_words

    kept = words if stop is False else drop_stop_words(words, col, None if stop is None else stop)
    est, sketch = sketch_estimates(kept, col, params, out="estimate")
    return top_k(est, k, "estimate", col), sketch
