"""Conversation prefix trie from adaptive radix trees.

Every distinct turn (role, text) has a fixed-width id: 16 big-endian bytes of
the SHA-256 of both.  A conversation is the string of its turns' ids, and the
trie of conversations is the radix tree of these strings in which only byte
depths that are whole turns are nodes.

Scale.  Conversations are cut into segments of ``SEGMENT`` turns.  A segment's
key is the 16-byte class of the turns before it (zero for the first segment)
and its own ids, so all segments of all conversations, however long, lie in
one forest of bounded depth.  Keys are dealt by ranges of (key, conversation):
a first turn, or a whole conversation, that a third of all rows share is cut
over as many tasks as it needs.  A task streams its sorted keys in blocks of at
most ``BLOCK_ROWS`` rows; a block is one adaptive radix tree (nodes of 4, 16,
48 and 256 slots that grow, compressed paths).  Nodes on the block's first and
last path may go on in other blocks and are emitted as partial rows (at most
two paths a block), which a grouped sum merges; all others are complete.  What
hangs below a segment's end is added by doubling over the tree of classes
(logarithmic rounds in the longest conversation's segments).

Defined results: rows are taken by turn (null first), then role, then text;
repeated rows are turns like any other; a null role or text is empty.  Rows
without conversation id belong to no conversation and are left out.  A table
without conversations has no node.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlens.llm.common import shuffle_partitions, written
from trendlens.llm.ordered import positions

#: Bytes of a turn's id, and turns of a segment.
WIDTH = 16
SEGMENT = 64
#: Rows and key bytes of one tree.
BLOCK_ROWS = 1 << 15
BLOCK_BYTES = 16 << 20


# -- the tree ------------------------------------------------------------------

class Small:
    """A node of up to 4 or 16 children: sorted bytes beside their children."""

    __slots__ = ("prefix", "value", "size", "bytes", "kids")

    def __init__(self, prefix: bytes, size: int = 4):
        self.prefix, self.value, self.size = prefix, None, size
        self.bytes: list[int] = []
        self.kids: list = []

    def get(self, byte: int):
        at = bisect_left(self.bytes, byte)
        return self.kids[at] if at < len(self.bytes) and self.bytes[at] == byte else None

    def put(self, byte: int, kid) -> None:
        at = bisect_left(self.bytes, byte)
        if at < len(self.bytes) and self.bytes[at] == byte:
            self.kids[at] = kid
        else:
            insort(self.bytes, byte)
            self.kids.insert(at, kid)

    def full(self) -> bool:
        return len(self.bytes) == self.size

    def grown(self):
        wider = Small(self.prefix, 16) if self.size == 4 else Indexed(self.prefix)
        wider.value = self.value
        for byte, kid in self.children():
            wider.put(byte, kid)
        return wider

    def children(self) -> Iterator[tuple[int, object]]:
        return zip(self.bytes, self.kids, strict=True)


class Indexed:
    """A node of up to 48 children: a 256-byte index into them."""

    __slots__ = ("prefix", "value", "index", "kids")

    def __init__(self, prefix: bytes):
        self.prefix, self.value = prefix, None
        self.index, self.kids = bytearray(256), []

    def get(self, byte: int):
        at = self.index[byte]
        return self.kids[at - 1] if at else None

    def put(self, byte: int, kid) -> None:
        at = self.index[byte]
        if at:
            self.kids[at - 1] = kid
        else:
            self.kids.append(kid)
            self.index[byte] = len(self.kids)

    def full(self) -> bool:
        return len(self.kids) == 48

    def grown(self):
        wider = Direct(self.prefix)
        wider.value = self.value
        for byte, kid in self.children():
            wider.put(byte, kid)
        return wider

    def children(self) -> Iterator[tuple[int, object]]:
        return ((byte, self.kids[at - 1]) for byte, at in enumerate(self.index) if at)


class Direct:
    """A node of up to 256 children: one slot a byte."""

    __slots__ = ("prefix", "value", "kids")

    def __init__(self, prefix: bytes):
        self.prefix, self.value, self.kids = prefix, None, [None] * 256

    def get(self, byte: int):
        return self.kids[byte]

    def put(self, byte: int, kid) -> None:
        self.kids[byte] = kid

    def full(self) -> bool:
        return False

    def children(self) -> Iterator[tuple[int, object]]:
        return ((byte, kid) for byte, kid in enumerate(self.kids) if kid is not None)


def _shared(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low = 0                     # equal up to low, not up to n
    while n - low > 1:
        mid = (low + n) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            n = mid
    return low


class RadixTree:
    """An adaptive radix tree from byte strings to values; one string may be the start of another."""

    def __init__(self):
        self.root = None

    def get_or_put(self, key: bytes, make):
        """The key's value; ``make()`` where it had none."""
        if self.root is None:
            self.root = Small(key)
            self.root.value = make()
            return self.root.value
        above, edge, node, at = None, 0, self.root, 0
        while True:
            n = _shared(node.prefix, key[at:at + len(node.prefix)])
            if n < len(node.prefix):
                # the compressed path forks: a node of the shared part goes between
                fork = Small(node.prefix[:n])
                fork.put(node.prefix[n], node)
                node.prefix = node.prefix[n + 1:]
                self._hang(above, edge, fork)
                node = fork
            at += n
            if at == len(key):
                if node.value is None:
                    node.value = make()
                return node.value
            kid = node.get(key[at])
            if kid is None:
                kid = Small(key[at + 1:])
                kid.value = make()
                if node.full():
                    node = node.grown()
                    self._hang(above, edge, node)
                node.put(key[at], kid)
                return kid.value
            above, edge, node, at = node, key[at], kid, at + 1

    def _hang(self, above, edge: int, node) -> None:
        if above is None:
            self.root = node
        else:
            above.put(edge, node)

    def walk(self) -> Iterator[tuple[int, bytes, object]]:
        """(bytes shared with the string before, string, value) in string order."""
        if self.root is None:
            return
        shared, path = 0, bytearray(self.root.prefix)
        if self.root.value is not None:
            yield 0, bytes(path), self.root.value
            shared = len(path)
        stack = [(len(path), self.root.children())]
        while stack:
            depth, kids = stack[-1]
            step = next(kids, None)
            if step is None:
                stack.pop()
                continue
            byte, kid = step
            del path[depth:]
            shared = min(shared, depth)
            path.append(byte)
            path += kid.prefix
            if kid.value is not None:
                yield shared, bytes(path), kid.value
                shared = len(path)
            stack.append((len(path), kid.children()))


# -- nodes of a block --------------------------------------------------------------

class Leaf:
    """What the conversations with one key have in common."""

    __slots__ = ("chars", "convs", "ends", "goes_on", "below", "next")

    def __init__(self, chars, below, following):
        self.chars, self.below, self.next = chars, below, following
        self.convs, self.ends, self.goes_on = [], [], 0


class Open:
    """A node whose subtree is being read."""

    __slots__ = ("depth", "key", "chars", "n", "first", "ends", "goes_on", "children", "leaves", "saved", "below",
                 "next", "rows", "spine")

    def __init__(self, depth: int, key: bytes, chars: int, spine: bool):
        self.depth, self.key, self.chars, self.spine = depth, key, chars, spine
        self.n, self.first, self.ends, self.goes_on = 0, None, [], 0
        self.children = self.leaves = self.saved = 0
        self.below, self.next, self.rows = (0, 0, 0), None, []


def joined(ids: list[int]) -> str:
    return ",".join(map(str, ids))


EMPTY_SHA = hashlib.sha256(b"").hexdigest()

#: A row of a block: a complete node (``partial`` false) or one that other blocks may share.
FIELDS = [("partial", pa.bool_()), ("ident", pa.binary()), ("parent_ident", pa.binary()), ("segment", pa.int64()),
          ("depth", pa.int64()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
          ("chars", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64()),
          ("goes_on", pa.int64()), ("below_children", pa.int64()), ("below_leaves", pa.int64()),
          ("below_saved", pa.int64()), ("above", pa.list_(pa.binary())), ("ends_sha256", pa.string()),
          ("first_end", pa.int64()), ("ends", pa.string())]
BLOCK_SCHEMA = ("partial boolean, ident binary, parent_ident binary, segment long, depth long, conv_id long, "
                "parent_conv_id long, n_convs long, chars long, n_children long, n_leaves long, saved long, "
                "goes_on long, below_children long, below_leaves long, below_saved long, above array<binary>, "
                "ends_sha256 string, first_end long, ends string")
_AT = {name: i for i, (name, _) in enumerate(FIELDS)}


def ident(key: bytes, following: bytes | None) -> bytes:
    """One name for a node in every block: its key's digest, or for a segment's end the class that follows it."""
    return following if following is not None else hashlib.sha256(key).digest()


#: Before a class: the top of the class's own tree, which is the same node as the segment's end above it.
TOP = b"r"


def block_rows(leaves: RadixTree, segment_of, length: int = SEGMENT) -> list[list]:
    """The rows of one tree's nodes; ``segment_of(class bytes)`` is a class's segment number, ``length`` its turns."""
    rows: list[list] = []
    stack: list[Open] = []

    def emit(node: Open, partial: bool) -> list:
        turns = node.depth // WIDTH - 1
        klass = node.key[:WIDTH]
        segment = segment_of(klass)
        row = [None] * len(FIELDS)
        row[_AT["partial"]] = partial
        row[_AT["segment"]], row[_AT["depth"]] = segment, turns + length * segment
        row[_AT["conv_id"]], row[_AT["n_convs"]], row[_AT["chars"]] = node.first, node.n, node.chars
        row[_AT["goes_on"]] = node.goes_on
        row[_AT["n_children"]], row[_AT["n_leaves"]], row[_AT["saved"]] = node.children, node.leaves, node.saved
        row[_AT["below_children"]], row[_AT["below_leaves"]], row[_AT["below_saved"]] = node.below
        if turns == 0:
            row[_AT["ident"]] = TOP + klass
        elif partial or turns == length:
            row[_AT["ident"]] = ident(node.key[:node.depth], node.next)
        if partial:
            # itself and the nodes above it in its segment's tree, which all are partial too
            chain = [TOP + klass, *(hashlib.sha256(node.key[:d]).digest() for d in range(2 * WIDTH, node.depth, WIDTH))]
            row[_AT["above"]] = chain + [row[_AT["ident"]]] if turns else chain
            if turns:
                row[_AT["parent_ident"]] = chain[-1]
            if node.ends:
                row[_AT["first_end"]], row[_AT["ends"]] = node.ends[0], joined(node.ends)
        else:
            row[_AT["ends_sha256"]] = hashlib.sha256(joined(node.ends).encode()).hexdigest() if node.ends else EMPTY_SHA
        rows.append(row)
        return row

    def close(last: bool) -> None:
        node = stack.pop()
        partial = node.spine or last
        if not partial:
            # complete: what lies below the segment's end and the node's own share come in here
            below_children, below_leaves, below_saved = node.below
            own = 1 if node.children == 0 and node.goes_on == 0 else 0
            node.children += below_children
            node.leaves += own + below_leaves
            node.saved += (node.n - 1) * node.chars + below_saved
        row = emit(node, partial)
        top = row[_AT["depth"]] == length * row[_AT["segment"]]
        for kid in node.rows:
            if partial or top:
                kid[_AT["parent_ident"]] = row[_AT["ident"]]
            else:
                kid[_AT["parent_conv_id"]] = node.first
        if stack:
            above = stack[-1]
            above.n += node.n
            above.first = node.first if above.first is None else min(above.first, node.first)
            if not partial:
                above.children += 1
                above.leaves += node.leaves
                above.saved += node.saved
                above.rows.append(row)

    first = True
    for shared, key, leaf in leaves.walk():
        keep = shared // WIDTH * WIDTH
        while stack and stack[-1].depth > keep:
            close(False)
        depth = stack[-1].depth if stack else 0
        for d in range(depth + WIDTH, len(key) + 1, WIDTH):
            turn = d // WIDTH - 2
            stack.append(Open(d, key, leaf.chars[turn] if turn >= 0 else 0, first))
        node = stack[-1]
        node.n += len(leaf.convs)
        node.first = min(leaf.convs) if node.first is None else min(node.first, min(leaf.convs))
        node.ends, node.goes_on, node.below, node.next = leaf.ends, leaf.goes_on, leaf.below, leaf.next
        first = False
    while stack:
        close(True)
    return rows


def _trees(segments: DataFrame, length: int, most_rows: int) -> DataFrame:
    """The rows of all blocks' nodes; ``segments`` as ``_segments`` makes them, with what lies below their ends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, held, size, numbers = RadixTree(), 0, 0, {}
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in
                       ("klass", "segment", "key", "chars", "conv", "ended", "next", "children", "leaves", "saved")]
            for klass, segment, key, chars, conv, ended, following, *below in zip(*columns, strict=True):
                numbers[klass] = segment
                leaf = tree.get_or_put(klass + key, lambda: Leaf(chars, (0, 0, 0), following))
                leaf.convs.append(conv)
                if ended:
                    leaf.ends.append(conv)
                else:
                    leaf.goes_on += 1
                    leaf.below = tuple(x or 0 for x in below)
                held, size = held + 1, size + len(key)
                if held >= most_rows or size >= BLOCK_BYTES:
                    yield from pack(block_rows(tree, numbers.__getitem__, length))
                    tree, held, size, numbers = RadixTree(), 0, 0, {}
        if held:
            yield from pack(block_rows(tree, numbers.__getitem__, length))

    def pack(rows: list[list]) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(rows), 8192):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, (_, k) in zip(zip(*rows[at:at + 8192], strict=True), FIELDS, strict=True)],
                names=[name for name, _ in FIELDS])

    by = ["klass", "key", "conv"]
    dealt = segments.repartitionByRange(shuffle_partitions(segments.sparkSession), *by).sortWithinPartitions(*by)
    return dealt.mapInArrow(run, BLOCK_SCHEMA)


def _merged(blocks: DataFrame) -> DataFrame:
    """The partial nodes of all blocks, merged and completed."""
    partial = blocks.where("partial")
    sums = partial.groupBy("ident").agg(
        F.first("parent_ident").alias("parent_ident"), F.first("above").alias("above"),
        F.first("segment").alias("segment"), F.first("depth").alias("depth"), F.first("chars").alias("chars"),
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("goes_on").alias("goes_on"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"),
        F.max("below_children").alias("below_children"), F.max("below_leaves").alias("below_leaves"),
        F.max("below_saved").alias("below_saved"))
    nodes = written(sums, "trie-partial")
    kids = nodes.where(F.col("parent_ident").isNotNull()).groupBy(F.col("parent_ident").alias("ident")).agg(
        F.count(F.lit(1)).alias("_kids"))
    own = nodes.join(kids, "ident", "left").withColumn("_inside", F.col("n_children") + F.coalesce("_kids", F.lit(0)))
    own = own.withColumn("n_children", F.col("_inside") + F.col("below_children")).withColumn(
        "_leaves", F.col("n_leaves") + F.col("below_leaves")
        + F.when((F.col("_inside") == 0) & (F.col("goes_on") == 0), 1).otherwise(0)).withColumn(
        "_saved", F.col("saved") + F.col("below_saved") + (F.col("n_convs") - 1) * F.col("chars"))
    # a partial node's subtree: its own share and those of the partial nodes below it (paths of at most a segment)
    subtree = own.select(F.explode("above").alias("ident"), "_leaves", "_saved").groupBy("ident").agg(
        F.sum("_leaves").alias("n_leaves"), F.sum("_saved").alias("saved"))
    return own.drop("n_leaves", "saved", "_leaves", "_saved", "_kids", "_inside", "above").join(subtree, "ident")


def _end_digests(blocks: DataFrame) -> DataFrame:
    """(ident, ends_sha256) of partial nodes at which conversations end: pieces streamed in order, one row a block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, sha, out = None, None, []
        for batch in batches:
            for this, ids in zip(batch.column("ident").to_pylist(), batch.column("ends").to_pylist(), strict=True):
                if this != name:
                    if name is not None:
                        out.append((name, sha.hexdigest()))
                    name, sha = this, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.encode())
        if name is not None:
            out.append((name, sha.hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in out], pa.binary()), pa.array([x for _, x in out], pa.string())],
            names=["ident", "ends_sha256"])

    pieces = blocks.where("partial AND ends IS NOT NULL").select("ident", "first_end", "ends")
    return pieces.repartition(shuffle_partitions(blocks.sparkSession), "ident").sortWithinPartitions(
        "ident", "first_end").mapInArrow(run, "ident binary, ends_sha256 string")


# -- conversations as keys -----------------------------------------------------------

def _class(a: str, b: str) -> Column:
    """Two 60-bit halves as 16 big-endian bytes."""
    return F.unhex(F.concat(*(F.lpad(F.hex(F.col(c)), WIDTH, "0") for c in (a, b))))


def _segments(rows: DataFrame, conv: str, pos: str, turn_id: str, chars: str, total: str,
              length: int) -> DataFrame:
    """One row per conversation and segment: ``klass, segment, key, chars, conv, ended, next`` (and ``parent`` class).

    ``rows`` hold a conversation's turns by position and its ``total`` turns;
    a conversation without turns is one row with a null position.
    """
    seg = rows.select(F.col(conv).alias("conv"), F.coalesce(F.floor(F.col(pos) / length), F.lit(0)).alias("segment"),
                      F.col(total).alias("total"), F.struct(F.col(pos).alias("p"), F.col(turn_id).alias("id"),
                                                            F.col(chars).alias("n")).alias("turn"))
    held = seg.groupBy("conv", "segment").agg(
        F.max("total").alias("total"), F.array_sort(F.collect_list("turn")).alias("turns"))   # at most a segment
    held = held.withColumn("turns", F.filter("turns", lambda t: t["p"].isNotNull()))
    cut = written(held.select(
        "conv", "segment", "total",
        F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), "")).alias("key"),
        F.transform("turns", lambda t: t["n"]).alias("chars"),
        (F.col("segment") == F.floor((F.greatest("total", F.lit(1)) - 1) / length)).alias("ended")), "trie-segments")
    # the class of a prefix: the digests of its segments, each tied to its place, combined by exclusive or
    mark = F.sha2(F.concat_ws(":", F.col("segment").cast("string"), F.hex("key")), 256)
    half = lambda k: F.conv(F.substring(mark, k, 15), 16, 10).cast("long")
    before = Window.partitionBy("conv").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    marked = cut.withColumn("_x", half(1)).withColumn("_y", half(16))
    short = marked.where(F.col("total") <= length).withColumns({"_a": zero, "_b": zero})
    long = marked.where(F.col("total") > length).withColumns({
        "_a": F.coalesce(F.bit_xor("_x").over(before), zero), "_b": F.coalesce(F.bit_xor("_y").over(before), zero)})
    rows = short.unionByName(long).withColumns({
        "_na": F.col("_a").bitwiseXOR(F.col("_x")), "_nb": F.col("_b").bitwiseXOR(F.col("_y"))})
    whole = F.octet_length("key") == length * WIDTH
    return rows.select(_class("_a", "_b").alias("klass"), "segment", "key", "chars", "conv", "ended",
                       F.when(whole, _class("_na", "_nb")).alias("next"))


def _with_below(segments: DataFrame, length: int, most_rows: int) -> DataFrame:
    """``segments`` with what hangs below their ends: ``children, leaves, saved`` of the class that follows."""
    zero = F.lit(0).cast("long")
    bare = {c: zero for c in ("children", "leaves", "saved")}
    deepest = segments.agg(F.max("segment")).first()[0]     # one number
    if not deepest:
        return segments.withColumns(bare)
    deep = segments.where("segment > 0")
    blocks = written(_trees(deep.withColumns(bare), length, most_rows), "trie-deep")
    top = F.col("depth") == F.col("segment") * length
    whole = blocks.where(~F.col("partial")).where(top).select("ident", "n_children", "n_leaves", "saved")
    parts = _merged(blocks).where(top).select("ident", "n_children", "n_leaves", "saved")
    roots = whole.unionByName(parts).select(F.expr(f"substring(ident, {len(TOP) + 1})").alias("klass"), F.col("n_children").alias("children"),
                                            F.col("n_leaves").alias("leaves"), "saved")
    parents = deep.where("NOT ended").groupBy(F.col("next").alias("klass")).agg(F.first("klass").alias("up"))
    sums = written(roots.join(parents, "klass", "left"), "trie-classes")
    for _ in range(math.ceil(math.log2(deepest))):
        # sums reach 2^k segments down and ``up`` leads 2^k segments up: both double
        lower = sums.where("up IS NOT NULL").groupBy(F.col("up").alias("klass")).agg(
            F.sum("leaves").alias("_leaves"), F.sum("saved").alias("_saved"))
        higher = sums.select(F.col("klass").alias("up"), F.col("up").alias("_up"))
        sums = written(sums.join(lower, "klass", "left").join(higher, "up", "left").select(
            "klass", "children", (F.col("leaves") + F.coalesce("_leaves", zero)).alias("leaves"),
            (F.col("saved") + F.coalesce("_saved", zero)).alias("saved"), F.col("_up").alias("up")), "trie-classes")
    ends = sums.select(F.col("klass").alias("next"), "children", "leaves", "saved")
    return segments.where("next IS NULL").withColumns(bare).unionByName(
        segments.where("next IS NOT NULL").join(ends, "next", "left"))


def prefix_trie(rows: DataFrame, conv: str = "conv_id", pos: str = "pos", turn_id: str = "turn_id",
                chars: str = "chars", total: str = "total", length: int = SEGMENT,
                most_rows: int = BLOCK_ROWS) -> DataFrame:
    """The trie's nodes.

    ``rows``: the turns of conversations by position from 0, each with its
    16-byte id and the code points of its text, and the conversation's number
    of turns; a conversation without turns is one row with a null position.
    ``length`` is the turns of a segment, ``most_rows`` the rows of a block.
    Per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.
    """
    segments = _segments(rows, conv, pos, turn_id, chars, total, length)
    blocks = written(_trees(_with_below(segments, length, most_rows), length, most_rows), "trie-nodes")
    top = (F.col("segment") > 0) & (F.col("depth") == F.col("segment") * length)
    merged = written(_merged(blocks).join(_end_digests(blocks), "ident", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA))).where(~top), "trie-merged")
    whole = blocks.where(~F.col("partial")).where(~top)
    # children of a segment's end hang from the top of the class that follows it
    end = F.col("depth") == (F.col("segment") + 1) * length
    name = F.when(end, F.concat(F.lit(TOP), F.col("ident"))).otherwise(F.col("ident")).alias("parent_ident")
    named = merged.select(name, F.col("conv_id").alias("_parent")).unionByName(
        whole.where(F.col("ident").isNotNull()).select(name, F.col("conv_id").alias("_parent")))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
               F.col("saved").alias("saved_tokens"), "ends_sha256"]
    settled = whole.where(F.col("parent_ident").isNull()).select(*columns)
    open_ = merged.withColumn("parent_conv_id", F.lit(None).cast("long")).select(
        "parent_ident", *columns).unionByName(
        whole.where(F.col("parent_ident").isNotNull()).select("parent_ident", *columns))
    return settled.unionByName(open_.join(named, "parent_ident", "left").withColumn("parent_conv_id", F.col("_parent"))
                               .drop("parent_ident", "_parent"))


# -- rebuilt conversations -------------------------------------------------------------

#: Conversations share the opening turns of the first conversation of their hundred.
FAMILY = 100
HEADS = 6


def rebuilt(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """``conv_id, pos, turn_id, chars, total`` of every conversation behind a shared head.

    Conversation c is the first h turns of conversation c - c % 100 (all it
    has, if fewer; none if there is none) and its own turns after its first h,
    with h = crc32(c in decimal) % 6.  Without any turn left it is one row
    with a null position.  A remainder has its dividend's sign.
    """
    empty = F.lit("")
    slim = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(role_col, empty).alias("role"), F.coalesce(text_col, empty).alias("text"))
    named = slim.withColumn("turn_id", F.unhex(F.substring(F.sha2(F.concat(
        F.length("role").cast("string"), F.lit(":"), "role", "text"), 256), 1, 2 * WIDTH))).withColumn(
        "chars", F.length("text"))
    own = positions(named, "conv_id", ["turn", "role", "text"], "at", drop=["turn", "role", "text"], name="trie-turns")
    head = F.crc32(F.col("conv_id").cast("string")) % HEADS
    sizes = own.groupBy("conv_id").agg((F.max("at") + 1).alias("n")).withColumn("h", head).withColumn(
        "base", F.col("conv_id") - F.col("conv_id") % FAMILY)
    heads = own.where((F.col("conv_id") % FAMILY == 0) & (F.col("at") < HEADS - 1)).groupBy(
        F.col("conv_id").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("at", "turn_id", "chars"))).alias("heads"))     # at most HEADS - 1
    taken = F.slice(F.coalesce("heads", F.array().cast("array<struct<at:bigint,turn_id:binary,chars:int>>")),
                    F.lit(1), F.col("h").cast("int"))
    convs = written(sizes.join(heads, "base", "left").withColumn("taken", taken).withColumn(
        "total", F.size("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).select(
        "conv_id", "h", "total", "taken"), "trie-heads")
    opening = convs.select("conv_id", F.explode("taken").alias("t"), "total").select(
        "conv_id", F.col("t.at").alias("pos"), "t.turn_id", "t.chars", "total")
    rest = own.join(convs.select("conv_id", "h", "total", F.size("taken").alias("_taken")), "conv_id").where(
        F.col("at") >= F.col("h")).select(
        "conv_id", (F.col("at") - F.col("h") + F.col("_taken")).alias("pos"), "turn_id", "chars", "total")
    none = convs.where("total = 0").select(
        "conv_id", F.lit(None).cast("long").alias("pos"), F.lit(None).cast("binary").alias("turn_id"),
        F.lit(None).cast("int").alias("chars"), "total")
    return opening.unionByName(rest).unionByName(none)


def rebuilt_trie(turns: DataFrame, **options) -> DataFrame:
    """The trie of all rebuilt conversations."""
    return prefix_trie(rebuilt(turns), **options)
