"""N-gram Jaccard join by count vectors in R-trees.

A document's set holds its distinct ``SHINGLE``-word shingles (fewer words:
the whole sequence).  Two sets link when 100 * intersection >= PERCENT *
union.  The join is exact, and a document is one of a class of equal sets.

1. Shingles are hashed to 64 bits.  A hash's top bits name its group; a set's
   group counts are its point.  The intersection of two sets is at most the
   sum over groups of the smaller count.
2. Linked sets share one of their first ``n - ceil(PERCENT n / 100) + 1``
   shingles in any order that all sets use.  The order here is the hash, with
   shingles that many sets hold last (at most ``HOT`` of them are told to the
   tasks; which ones changes the work, never the result).  The sets that hold
   the same such shingle form a block; only sets of one block are compared.
3. The pairs of blocks of up to ``SMALL`` members, no more than two leaves, are
   bounded directly.  Of a larger block, first each member is compared to the
   block's first member, and then, where the block is not one component yet,
   to ``CENTERS`` members drawn from it, which joins large groups of near copies
   into components without their pairs.
4. Then, in every large block whose members are not yet one component, an
   R-tree of the points is searched for partners in other components: a box
   bounds the overlap by the sum of the smaller of its largest counts and the
   query's.  Points that stay are bounded again by counts of ``FINE`` groups,
   which tell large sets apart.  Blocks beyond ``PART`` members are split into
   parts, which meet in pairs.
5. Surviving pairs are verified on the sets themselves, and links become
   components by rounds of joins.

A component found in step 3 holds only verified links, and step 4 leaves out
no pair of sets in different components, so no link between components is lost.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import batches_of, release_shuffles, shuffle_partitions, written
from trendlens.llm.components import connected_components

SHINGLE = 5
PERCENT = 75
#: Groups of the count vectors (a power of two), and of those that points found by the tree are bounded by.
GROUPS = 256
FINE = 2048
#: Shingles that at least this many sets were seen to hold are ordered last, the commonest ``HOT`` of them.
COMMON = 16
HOT = 1 << 18
#: Members of a block that meet in one tree; larger blocks are split.
PART = 512
LEAF = 16
#: The largest count a byte holds.
FULL = 255
#: Members of a large block that all its members are compared with before its trees are built.
CENTERS = 8
#: Members up to which a block's pairs are bounded directly: no more than two leaves.
SMALL = 2 * LEAF
#: Bits of the filter that keeps sets no pair names from being shuffled for verification: 1 MB, whatever the input.
FILTER_BITS = 1 << 23

_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_BYTES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
#: Bytes hashed at once; words of more than ``LONG`` bytes are hashed alone, by xxh3.
_CHUNK = 1 << 17
LONG = 64
_MIX = [np.uint64(m) for m in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5,
                               0x2545F4914F6CDD1D)]


def _powers(base: int, n: int) -> np.ndarray:
    return np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, np.uint64(base)))])


class _Hasher:
    """64-bit hashes of the words of a byte buffer."""

    def __init__(self):
        self.up = _powers(_BASE, _CHUNK)
        self.down = _powers(pow(_BASE, -1, 1 << 64), _CHUNK)

    def words(self, raw: np.ndarray, starts_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, hash) of every word; no word runs over one of ``starts_at`` (where documents start)."""
        free = ~_SPACES[raw]
        begins = free.copy()
        begins[1:] &= ~free[:-1]
        inside = starts_at[starts_at < len(raw)]
        begins[inside] = free[inside]
        start = np.flatnonzero(begins)
        ends = free.copy()
        ends[:-1] &= ~free[1:]
        inside = inside[inside > 0] - 1
        ends[inside] = free[inside]
        end = np.flatnonzero(ends) + 1
        out = np.empty(len(start), np.uint64)
        at = 0
        while at < len(start):        # runs of words within one chunk of bytes; a longer word is hashed alone
            to = max(at + 1, int(np.searchsorted(end, start[at] + _CHUNK, "right")))
            a, b = int(start[at]), int(end[to - 1])
            if b - a > _CHUNK:
                out[at] = xxhash.xxh3_64_intdigest(_LOWER[raw[a:b]].tobytes())
            else:
                low = _LOWER[raw[a:b]]
                sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTES[low] * self.up[:b - a])])
                s, e = start[at:to] - a, end[at:to] - a
                h = (sums[e] - sums[s]) * self.down[s] + (e - s).astype(np.uint64) * _MIX[0]
                out[at:to] = (h ^ (h >> np.uint64(31))) * _MIX[1]
                # the sums are modulo 2^64, under which some long words meet whatever the base
                for k in np.flatnonzero(e - s > LONG).tolist():
                    out[at + k] = xxhash.xxh3_64_intdigest(low[s[k]:e[k]].tobytes())
            at = to
        return start, out


def _combine(hashes: list[np.ndarray]) -> np.ndarray:
    h = np.full(len(hashes[0]), np.uint64(len(hashes)))
    for k, x in enumerate(hashes):
        h = (h ^ (h >> np.uint64(29))) * _MIX[k % 5] + x
    h = (h ^ (h >> np.uint64(32))) * _MIX[1]
    return h ^ (h >> np.uint64(29))


def shingle_sets(hasher: _Hasher, raw: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each document of a buffer."""
    start, word = hasher.words(raw, offsets[:-1])
    first = np.searchsorted(start, offsets)
    whole = _combine([word[k:len(word) - size + 1 + k] for k in range(size)]) if len(word) >= size else None
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            s = np.sort(whole[a:b - size + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif b > a:
            out.append(_combine([word[k:k + 1] for k in range(a, b)]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def needed_overlap(a, b, percent: int = PERCENT):
    """Smallest intersection with which sets of these sizes link."""
    return -(-percent * (a + b) // (100 + percent))


def _counts(s: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """Group counts in a byte each; ``FULL`` stands for itself or more."""
    group = (s >> np.uint64(64 - groups.bit_length() + 1)).astype(np.int64)
    return np.minimum(np.bincount(group, minlength=groups), FULL).astype(np.uint8)


def _packed(s: np.ndarray) -> bytes:
    """Counts of ``FINE`` groups, mostly 0 and 1: about a third of what Spark's own compression leaves of them."""
    coder = zlib.compressobj(1, zlib.DEFLATED, -15, 8, zlib.Z_RLE)
    return coder.compress(_counts(s, FINE).tobytes()) + coder.flush()


def _unpacked(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(counts, fine) of packed counts, a row each; the coarse counts follow from the fine ones, ``FULL`` included."""
    raw = b"".join([zlib.decompress(x, -15, FINE) for x in column.to_pylist()])
    fine = np.frombuffer(raw, np.uint8).reshape(-1, FINE)
    sums = fine.reshape(len(fine), GROUPS, FINE // GROUPS).sum(2, dtype=np.uint16)
    return np.minimum(sums, FULL).astype(np.uint8), fine


def overlap_bound(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """At least the intersection of sets (or of any set in a box) with these counts, per row."""
    least = np.minimum(x, y)
    bound = least.sum(-1, dtype=np.int64)
    if (least == FULL).any():
        bound[(least == FULL).any(-1)] = np.iinfo(np.int64).max     # the counts themselves are not known
    return bound


# -- sets -------------------------------------------------------------------------------

_SETS = ("kind string, id long, n int, key binary, node long, counts binary, fine binary, hashes array<long>, "
         "seen array<int>")
_SETS_KINDS = [pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.binary(),
               pa.list_(pa.int64()), pa.list_(pa.int32())]
_SETS_NAMES = [c.split()[0] for c in _SETS.split(", ")]
#: Hashes of a task's sets that are counted at once, and digests of sets it remembers.
HELD = 1 << 18
KNOWN = 1 << 18


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column (null as empty)."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def _key(s: np.ndarray) -> bytes | None:
    """128 bits that name a set; None for the empty one."""
    return xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None


def _node(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))


def _each_batch(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Small batches of texts with their sets."""
    hasher = _Hasher()
    for whole in batches:
        for batch in batches_of(whole, "text", _CHUNK):
            yield batch, shingle_sets(hasher, *_buffer(batch.column("text")), size)


def build_sets(texts: DataFrame, size: int = SHINGLE) -> DataFrame:
    """A written table of kind ``doc`` (one row per document) and kind ``hot`` (shingles repeated within a task).

    Of equal sets only the first that a task remembers carries its counts.
    The shingles are not stored: whoever needs them hashes the text again,
    which is cheaper than writing eight bytes for every word.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, fresh, held = set(), [], 0

        def hot() -> pa.RecordBatch:
            value, seen = np.unique(np.concatenate(fresh), return_counts=True)
            often = seen >= 2
            row = ("hot", None, None, None, None, None, None, value[often].view(np.int64), seen[often].astype(np.int32))
            fresh.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, _SETS_KINDS, strict=True)],
                                              names=_SETS_NAMES)

        for batch, sets in _each_batch(batches, size):
            rows: list[list] = [[] for _ in range(5)]
            if len(known) >= KNOWN:
                known.clear()
            for s in sets:
                key = _key(s)
                new = key is not None and key not in known
                if new:
                    known.add(key)
                    fresh.append(s)
                    held += len(s)
                for column, value in zip(rows, (len(s), key, _node(key) if key else None,
                                                _counts(s).tobytes() if new else None,
                                                _packed(s) if new else None), strict=True):
                    column.append(value)
            n = batch.num_rows
            values = [["doc"] * n, batch.column("id"), *rows, [None] * n, [None] * n]
            yield pa.RecordBatch.from_arrays(
                [v if isinstance(v, pa.Array) else pa.array(v, k) for v, k in zip(values, _SETS_KINDS, strict=True)],
                names=_SETS_NAMES)
            if held > HELD:
                yield hot()
                held = 0
        if fresh:
            yield hot()

    return written(texts.mapInArrow(run, _SETS), "shingle-sets", "kind")


def _clashes(sets: DataFrame) -> DataFrame:
    """``node, low``: 64-bit numbers that several sets have, and the digest of the set that keeps the number."""
    return sets.where("kind = 'doc' AND node IS NOT NULL").groupBy("node").agg(
        F.min("key").alias("low"), F.max("key").alias("high")).where("low <> high").select("node", "low")


def _renumbered(rows: DataFrame, clashes: DataFrame | None) -> DataFrame:
    """``rows`` (with ``node`` and ``key``) with ``node`` unique to the set.

    Where the numbers of sets are equal, which some 10^9 sets make likely, all
    but one set take other bits of their digest.
    """
    if clashes is None:
        return rows
    other = F.conv(F.hex(F.substring("key", 9, 7)), 16, 10).cast("long")
    return rows.join(clashes.toDF("clash", "low"), F.col("node") == F.col("clash"), "left").withColumn(
        "node", F.when(F.col("low") != F.col("key"), other).otherwise(F.col("node"))).drop("clash", "low")


# -- blocks --------------------------------------------------------------------------------

_BLOCKS = "kind string, h long, node long, n long, center long, center_n long"
_BLOCKS_NAMES = [c.split()[0] for c in _BLOCKS.split(", ")]


def _blocks(texts: DataFrame, clashes: DataFrame | None, hot: np.ndarray, size: int, percent: int,
            partitions: int) -> DataFrame:
    """Of the prefix shingles ``h`` that two sets or more hold, a written table of two kinds of rows.

    ``pair``: a pair (node, center) of a block of up to ``SMALL`` members, of
    sizes (n, center_n) that allow a link.  ``member``: a member of a larger
    block, with the block's first node as ``center``.
    """
    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[bytes] = set()
        for _, sets in _each_batch(batches, size):
            hashes, nodes, keys, sizes = [], [], [], []
            if len(known) >= KNOWN:
                known.clear()
            for s in sets:
                key = _key(s)
                if key is None or key in known:
                    continue
                known.add(key)
                keep = len(s) - -(-percent * len(s) // 100) + 1
                if len(hot):
                    last = hot[np.minimum(np.searchsorted(hot, s), len(hot) - 1)] == s
                    if last.any():
                        s = np.concatenate([s[~last], s[last]])
                hashes.append(s[:keep])
                nodes.append(np.full(keep, _node(key), np.int64))
                sizes.append(np.full(keep, len(s), np.int32))
                if clashes is not None:
                    keys += [key] * keep
            if hashes:
                columns = [pa.array(np.concatenate(hashes).view(np.int64)), pa.array(np.concatenate(nodes)),
                           pa.array(np.concatenate(sizes))]
                if clashes is not None:
                    columns.append(pa.array(keys, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by (h, node).  A run is held back until it ends or has more than ``SMALL`` members."""
        rest, large_h, center, center_n = [np.zeros(0, np.int64)] * 3, None, 0, 0
        for batch in batches:
            new = [batch.column(c).to_numpy().astype(np.int64) for c in ("h", "node", "n")]
            rows = [np.concatenate(x) for x in zip(rest, new, strict=True)]
            once = np.ones(len(rows[0]), bool)            # a set that several tasks saw comes more than once
            once[1:] = (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])
            h, node, n = (x[once] for x in rows)
            starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
            ends = np.append(starts[1:], len(h))
            # the last run may go on: it stays back unless it is large already
            keep_from = int(starts[-1]) if len(starts) else 0
            if len(starts) and (ends[-1] - starts[-1] > SMALL or h[-1] == large_h):
                keep_from = len(h) - 1                    # its last row stays, so that a repeat of it is seen
            yield emit(h, node, n, starts, ends, keep_from, large_h, center, center_n)
            if len(starts) and keep_from > starts[-1] and h[-1] != large_h:
                large_h, center, center_n = h[-1], node[starts[-1]], n[starts[-1]]
            rest = [x[keep_from:] for x in (h, node, n)]
        h, node, n = rest
        if len(h):
            yield emit(h, node, n, np.zeros(1, np.int64), np.array([len(h)]), len(h), large_h, center, center_n)

    def emit(h, node, n, starts, ends, upto, large_h, center, center_n) -> pa.RecordBatch:
        """Rows before ``upto``; a run of ``large_h`` goes on with its block's center."""
        out = []
        members = ends - starts
        goes_on = (h[starts] == large_h) if large_h is not None and len(starts) else np.zeros(len(starts), bool)
        for m in range(2, SMALL + 1):                     # small runs of one size side by side
            base = starts[(members == m) & ~goes_on & (ends <= upto)]
            if len(base):
                x, y = (base[:, None] + place for place in np.triu_indices(m, 1))
                x, y = x.ravel(), y.ravel()
                fits = 100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])
                x, y = x[fits], y[fits]
                out.append(("pair", h[x], node[x], n[x], node[y], n[y]))
        for k in np.flatnonzero((members > SMALL) | goes_on).tolist():
            at = np.arange(starts[k], min(int(ends[k]), upto))
            first = (center, center_n) if goes_on[k] else (node[starts[k]], n[starts[k]])
            out.append(("member", h[at], node[at], n[at], np.full(len(at), first[0]), np.full(len(at), first[1])))
        kinds = np.concatenate([np.full(len(o[1]), o[0], object) for o in out]) if out else np.zeros(0, object)
        columns = [np.concatenate([o[i] for o in out]) if out else np.zeros(0, np.int64) for i in range(1, 6)]
        return pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.string()), *(pa.array(c.astype(np.int64)) for c in columns)], names=_BLOCKS_NAMES)

    names = ["h", "node", "n"] + ["key"] * (clashes is not None)
    found = texts.select("text").mapInArrow(
        prefixes, "h long, node long, n int" + ", key binary" * (clashes is not None))
    rows = _renumbered(found, clashes).select("h", "node", "n")
    ordered = rows.repartition(partitions, "h").sortWithinPartitions("h", "node")
    return written(ordered.mapInArrow(runs, _BLOCKS), "shingle-blocks", "kind")


def _first_pairs(blocks: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of small blocks, and of large blocks' members with their first, whose prefixes allow a link.

    A shared shingle lies in both prefixes or in the rest of one of the sets.
    So the intersection is at most the small blocks that hold both, plus the
    large blocks that may hold both, plus the longer of the two rests.
    """
    large = blocks.where("kind = 'member'")
    stars = large.where("node <> center").where(_sizes_allow("n", "center_n", percent)).select(
        F.least("node", "center").alias("a"), F.greatest("node", "center").alias("b"))
    small = blocks.where("kind = 'pair'").select(
        F.least("node", "center").alias("a"), F.greatest("node", "center").alias("b"),
        F.when(F.col("node") < F.col("center"), F.col("n")).otherwise(F.col("center_n")).alias("na"),
        F.when(F.col("node") < F.col("center"), F.col("center_n")).otherwise(F.col("n")).alias("nb"))
    pairs = small.groupBy("a", "b").agg(F.count("*").alias("together"), F.first("na").alias("na"),
                                        F.first("nb").alias("nb"))
    held = written(large.groupBy(F.col("node").alias("l_node")).agg(F.count("*").alias("held")), "large-members")
    for side in ("a", "b"):
        pairs = pairs.join(held.withColumnRenamed("held", f"held_{side}"), F.col(side) == F.col("l_node"),
                           "left").drop("l_node")
    rest = F.ceil(F.greatest("na", "nb") * percent / 100) - 1
    most = F.col("together") + F.least(F.coalesce("held_a", F.lit(0)), F.coalesce("held_b", F.lit(0))) + rest
    likely = pairs.where(most * (100 + percent) >= (F.col("na") + F.col("nb")) * percent)
    return likely.select("a", "b").union(stars).distinct()


def _sizes_allow(a: str, b: str, percent: int):
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


# -- the tree ---------------------------------------------------------------------------------

class CountTree:
    """R-tree of count vectors in two levels over leaves of ``LEAF`` points, packed by set size."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray):
        self.order = np.lexsort((counts.argmax(1), sizes))
        self.counts, self.sizes = counts[self.order], sizes[self.order]
        self.leaf_start = np.arange(0, len(sizes), LEAF)
        self.leaf_box, self.leaf_low, self.leaf_high = self._boxes(self.counts, self.sizes, self.sizes, self.leaf_start)
        self.top_start = np.arange(0, len(self.leaf_start), LEAF)
        self.top_box, self.top_low, self.top_high = self._boxes(
            self.leaf_box, self.leaf_low, self.leaf_high, self.top_start)

    @staticmethod
    def _boxes(counts, low, high, starts):
        return (np.maximum.reduceat(counts, starts), np.minimum.reduceat(low, starts),
                np.maximum.reduceat(high, starts))

    def search(self, count: np.ndarray, size: int, percent: int) -> np.ndarray:
        """Places (in the order given) of all points whose bound allows a link with the query."""
        def allowed(box, low, high):
            least = np.maximum(low, -(-percent * size // 100))          # smallest partner in the box that can link
            fits = (least <= high) & (low * percent <= size * 100)
            return fits & (overlap_bound(box, count) >= needed_overlap(least, size, percent))

        tops = np.flatnonzero(allowed(self.top_box, self.top_low, self.top_high))
        if not len(tops):
            return tops
        leaves = _spread(self.top_start[tops], LEAF, len(self.leaf_start))
        leaves = leaves[allowed(self.leaf_box[leaves], self.leaf_low[leaves], self.leaf_high[leaves])]
        if not len(leaves):
            return leaves
        points = _spread(self.leaf_start[leaves], LEAF, len(self.sizes))
        found = allowed(self.counts[points], self.sizes[points], self.sizes[points])
        return self.order[points[found]]


def _spread(starts: np.ndarray, width: int, end: int) -> np.ndarray:
    every = (starts[:, None] + np.arange(width)).ravel()
    return every[every < end]


def _runs_of(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, with the groups' bounds, from rows sorted by ``keys``."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = table if rest is None or not rest.num_rows else pa.concat_tables([rest, table])
        change = _changes(rest, keys)
        if len(change):
            yield rest.slice(0, int(change[-1])), np.concatenate([[0], change])
            rest = rest.slice(int(change[-1]))
    if rest is not None and rest.num_rows:
        yield rest, np.concatenate([[0], _changes(rest, keys), [rest.num_rows]])


def _changes(table: pa.Table, keys: tuple[str, ...]) -> np.ndarray:
    values = [table.column(k).to_numpy() for k in keys]
    return np.flatnonzero(np.logical_or.reduce([v[1:] != v[:-1] for v in values])) + 1


def _pair_batch(left: list[np.ndarray], right: list[np.ndarray]) -> pa.RecordBatch:
    none = [np.zeros(0, np.int64)]
    x, y = np.concatenate(none + left).astype(np.int64), np.concatenate(none + right).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])


def _open_members(blocks: DataFrame, comps: DataFrame) -> DataFrame:
    """``h, node, n, component, members`` of the large blocks whose members are not yet one component, written."""
    rows = blocks.where("kind = 'member'").select("h", "node", "n").join(
        comps.withColumnRenamed("node", "c_node"), F.col("node") == F.col("c_node"), "left").select(
        "h", "node", "n", F.coalesce("component", "node").alias("component"))
    rows = written(rows, "block-members")
    open_blocks = rows.groupBy(F.col("h").alias("o_h")).agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members")).where(
        "low <> high").drop("low", "high")
    return written(rows.join(open_blocks, F.col("h") == F.col("o_h")).drop("o_h"), "open-members")


def _center_pairs(rows: DataFrame, points: DataFrame, percent: int, partitions: int) -> DataFrame:
    """(a, b): members of open blocks with ``CENTERS`` members of the block, drawn by hash, where counts allow a link.

    A block is dealt in parts of about ``PART`` members, each with the block's
    centers before them; a part is streamed past its centers.
    """
    drawn = [F.min(F.struct(F.xxhash64("node", F.lit(k)).alias("draw"), "node", "n", "component")).alias(f"c{k}")
             for k in range(CENTERS)]
    parts = F.ceil(F.col("members") / PART)
    picked = rows.groupBy("h", "members").agg(*drawn).select("h", "members", F.explode(F.array_distinct(F.array(*[
        F.struct(f"c{k}.node", f"c{k}.n", f"c{k}.component") for k in range(CENTERS)]))).alias("c"))
    centers = picked.select("h", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"), F.lit(0).alias("kind"),
                            "c.node", "c.n", "c.component")
    members = rows.select("h", F.pmod(F.xxhash64("node"), parts).alias("part"), F.lit(1).alias("kind"), "node", "n",
                          "component")
    counts = points.select(F.col("node").alias("p_node"), "fine")
    full = centers.unionByName(members).join(counts, F.col("node") == F.col("p_node")).drop("p_node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = [], []
            h, part, kind, node, n, component = (batch.column(c).to_numpy() for c in
                                                 ("h", "part", "kind", "node", "n", "component"))
            counts, fine = _unpacked(batch.column("fine"))
            change = np.flatnonzero((h[1:] != h[:-1]) | (part[1:] != part[:-1]) | (kind[1:] != kind[:-1])) + 1
            for a, b in zip([0, *change.tolist()], [*change.tolist(), len(h)], strict=True):
                if (h[a], part[a]) != at:
                    at, held = (h[a], part[a]), []
                if kind[a] == 0:
                    held += [(node[k], n[k], component[k], counts[k].copy(), fine[k].copy()) for k in range(a, b)]
                    continue
                for c_node, c_n, c_component, *c_counts in held:
                    found = a + np.flatnonzero((component[a:b] != c_component) & (
                        100 * np.minimum(n[a:b], c_n) >= percent * np.maximum(n[a:b], c_n)))
                    for mine, theirs in zip((counts, fine), c_counts, strict=True):
                        if len(found):
                            bound = overlap_bound(mine[found], theirs)
                            found = found[bound >= needed_overlap(n[found].astype(np.int64), int(c_n), percent)]
                    left.append(node[found])
                    right.append(np.full(len(found), c_node))
            yield _pair_batch(left, right)

    ordered = full.repartition(partitions, "h", "part").sortWithinPartitions("h", "part", "kind")
    return ordered.mapInArrow(compare, "a long, b long").distinct()


def _tree_pairs(rows: DataFrame, points: DataFrame, percent: int, partitions: int) -> DataFrame:
    """(a, b) of the pairs of one block, in different components, that the trees let through."""
    dealt = rows.withColumn("parts", F.ceil(F.col("members") / PART)).withColumn(
        "part", F.pmod(F.xxhash64("node"), "parts")).withColumn(
        "meets", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    placed = dealt.select("h", F.least("part", "meets").alias("i"), F.greatest("part", "meets").alias("j"), "part",
                          "node", "n", "component")
    counts = points.select(F.col("node").alias("p_node"), "fine")
    full = placed.join(counts, F.col("node") == F.col("p_node")).drop("p_node")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in _runs_of(batches, "h", "i", "j"):
            yield pairs(table, bounds)

    def pairs(table: pa.Table, bounds: np.ndarray) -> pa.RecordBatch:
        counts, fine = _unpacked(table.column("fine"))
        size, part, i, j, node, comp = (table.column(c).to_numpy() for c in
                                        ("n", "part", "i", "j", "node", "component"))
        left, right = [], []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            own = i[a] == j[a]                            # a part that meets itself
            mine = a + np.flatnonzero(part[a:b] == i[a])
            other = mine if own else a + np.flatnonzero(part[a:b] == j[a])
            if not len(mine) or not len(other):
                continue
            tree = CountTree(counts[other], size[other])
            for q in mine.tolist():
                found = other[tree.search(counts[q], int(size[q]), percent)]
                found = found[comp[found] != comp[q]]
                if own:
                    found = found[found > q]
                if len(found):
                    bound = overlap_bound(fine[found], fine[q])
                    found = found[bound >= needed_overlap(size[found].astype(np.int64), int(size[q]), percent)]
                left.append(np.full(len(found), node[q]))
                right.append(node[found])
        return _pair_batch(left, right)

    ordered = full.repartition(partitions, "h", "i", "j").sortWithinPartitions("h", "i", "j")
    return ordered.mapInArrow(search, "a long, b long").distinct()


# -- verification -------------------------------------------------------------------------------

def _bounded(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose counts allow a link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, GROUPS) for c in ("ca", "cb"))
            na, nb = (batch.column(c).to_numpy().astype(np.int64) for c in ("na", "nb"))
            good = (overlap_bound(x, y) >= needed_overlap(na, nb, percent)) & (
                100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))
            yield batch.select(["a", "b"]).filter(pa.array(good))

    one = points.select(F.col("node").alias("a_node"), F.col("n").alias("na"), F.col("counts").alias("ca"))
    two = points.select(F.col("node").alias("b_node"), F.col("n").alias("nb"), F.col("counts").alias("cb"))
    both = pairs.join(one, F.col("a") == F.col("a_node")).join(two, F.col("b") == F.col("b_node"))
    return both.select("a", "b", "na", "nb", "ca", "cb").mapInArrow(run, "a long, b long")


def _bitmap(wanted: DataFrame) -> np.ndarray:
    """A bitmap of fixed size (``FILTER_BITS``) of the nodes ``w``; they are digests, so their low bits spread evenly."""
    slot = F.pmod(F.col("w"), F.lit(FILTER_BITS))
    per_block = 32_768                                    # positions of one of Spark's bitmaps
    blocks = wanted.groupBy(F.floor(slot / per_block).alias("block")).agg(
        F.bitmap_construct_agg(slot % per_block).alias("bits")).collect()       # at most FILTER_BITS / 32,768 rows
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in blocks:
        out[row["block"] * per_block // 8:(row["block"] + 1) * per_block // 8] = np.frombuffer(row["bits"], np.uint8)
    return out


def _members(texts: DataFrame, clashes: DataFrame | None, wanted: DataFrame, size: int) -> DataFrame:
    """``node, shingles`` of the sets that ``wanted`` (column ``w``) names and a few others, once each.

    Every text is hashed again; a bitmap lets few other sets leave the task.
    A bitmap that a large input fills lets more through, and the reader's join
    decides.  One shuffle by ``node`` serves this and the joins on ``node``.
    """
    held, renumbered = _bitmap(wanted), clashes is not None

    def maybe(key: bytes) -> bool:
        names = [_node(key)] + [int.from_bytes(key[8:15], "big")] * renumbered
        return any(held[(n % FILTER_BITS) >> 3] >> (n % 8) & 1 for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[bytes] = set()
        for _, sets in _each_batch(batches, size):
            if len(known) >= KNOWN:
                known.clear()
            own = []
            for s in sets:
                key = _key(s)
                if key is not None and key not in known and maybe(key):
                    known.add(key)
                    own.append((_node(key), key, s.tobytes()))
            if own:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*own, strict=True), (pa.int64(), pa.binary(), pa.binary()),
                                                    strict=True)], names=["node", "key", "shingles"])

    found = _renumbered(texts.select("text").mapInArrow(run, "node long, key binary, shingles binary"), clashes)
    return found.select("node", "shingles").dropDuplicates(["node"])


def _verified(pairs: DataFrame, texts: DataFrame, clashes: DataFrame | None, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by their whole sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for sa, sb in zip(batch.column("sa"), batch.column("sb"), strict=True):
                x, y = np.frombuffer(sa.as_buffer(), "<u8"), np.frombuffer(sb.as_buffer(), "<u8")
                both = np.sort(np.concatenate([x, y]), kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                good.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    pairs = written(pairs, "set-pairs")
    wanted = pairs.select(F.col("a").alias("w")).union(pairs.select("b")).distinct()
    held = _members(texts, clashes, wanted, size)
    release_shuffles(texts.sparkSession)
    both = pairs.join(held.select(F.col("node").alias("a_node"), F.col("shingles").alias("sa")),
                      F.col("a") == F.col("a_node")).drop("a_node").join(
        held.select(F.col("node").alias("b_node"), F.col("shingles").alias("sb")), F.col("b") == F.col("b_node"))
    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _joined(comps: DataFrame, links: DataFrame) -> DataFrame:
    """The components after more links."""
    return connected_components(comps.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                       percent: int = PERCENT) -> DataFrame:
    """Per document: ``id_col``, ``n_shingles`` and ``component_id`` (the smallest id reachable by links).

    A null or wordless text has no shingles, links with nothing and is its own
    component.  Repeated rows and equal texts are linked (their sets are
    equal).  A null id counts only where no linked document has an id.  An
    empty table gives no row; other columns are not read.
    """
    spark = docs.sparkSession
    partitions = shuffle_partitions(spark)
    texts = _texts(docs, id_col, text_col)
    sets = build_sets(texts, size)
    clashes = _clashes(sets)
    clashes = None if clashes.isEmpty() else written(clashes, "set-clashes")
    rows = _renumbered(sets.where("kind = 'doc'"), clashes)
    hot = sets.where("kind = 'hot'").select(F.explode(F.arrays_zip("hashes", "seen")).alias("s")).groupBy(
        "s.hashes").agg(F.sum("s.seen").alias("seen")).where(F.col("seen") >= COMMON).orderBy(
        F.col("seen").desc(), "hashes").limit(HOT)
    hot = np.sort(np.array([r[0] for r in hot.select("hashes").collect()], np.int64).view(np.uint64))
    blocks = _blocks(texts, clashes, hot, size, percent, partitions)
    points = written(rows.where("counts IS NOT NULL").select("node", "n", "counts", "fine").dropDuplicates(["node"]),
                     "points")
    release_shuffles(spark)
    pairs = written(_first_pairs(blocks, percent), "first-pairs")
    release_shuffles(spark)
    links = written(_verified(_bounded(pairs, points, percent), texts, clashes, size, percent), "star-links")
    release_shuffles(spark)
    comps = written(connected_components(links), "star-components")
    release_shuffles(spark)
    # what the first member leaves open, members drawn from the block join as a rule; the trees find the rest
    near = _center_pairs(_open_members(blocks, comps), points, percent, partitions)
    links = _verified(near, texts, clashes, size, percent)
    comps = written(_joined(comps, links), "center-components")
    release_shuffles(spark)
    found = _tree_pairs(_open_members(blocks, comps), points, percent, partitions)
    comps = _joined(comps, _verified(found, texts, clashes, size, percent))
    slim = rows.select("id", "n", "node")
    firsts = slim.where("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("first"))
    named = written(firsts.join(comps.withColumnRenamed("node", "c_node"), F.col("node") == F.col("c_node"), "left").select(
        "node", "first", F.coalesce("component", "node").alias("component")), "named-sets")
    names = named.groupBy(F.col("component").alias("n_component")).agg(F.min("first").alias("component_id"))
    of_node = named.join(names, F.col("component") == F.col("n_component")).select(
        F.col("node").alias("o_node"), "component_id")
    return slim.join(of_node, F.col("node") == F.col("o_node"), "left").select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component: the one whose id names it.

    Documents without an id, and without words, all stay; so do repeated rows
    of the id that names a component.
    """
    found = jaccard_components(docs.select(id_col, text_col), id_col, text_col, **options)
    gone = found.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).cast("long").alias("g")).distinct()
    renamed = gone.toDF("_gone_id")
    return docs.join(renamed, docs[id_col].cast("long") == renamed["_gone_id"], "left_anti")
