"""Line dedup with two Bloom filters.

A line that many documents repeat stays in one of them.  Most lines stand in
one document only, so they should not travel: every task marks the hashes of
its lines in a filter of hashes seen once and, where a hash is there already,
in a filter of hashes seen twice.  Filters of tasks merge block by block: what
two tasks have seen once has been seen twice.  Only lines whose hash the
merged second filter holds are suspected repeats; their 128-bit digests are
shuffled, and exact counts of documents decide.  A false positive of the
filter costs a row in that shuffle and changes nothing; there are no false
negatives.

A filter has ``BITS`` bits whatever the input; 16 bits for each distinct line
keep false positives rare.  The second filter (``bits / 8`` bytes) is the only
thing broadcast.  Beyond that size more lines are suspected, up to 24 bytes
shuffled for every line; the result stays the same.

Lines are the pieces of a text between ``\\n``; a line's key is the line
without white space (the six ASCII characters) at both ends, with A-Z
lower-cased.  Keys of ``min_chars`` code points or more that stand in
``min_docs`` documents or more lose all their lines except in the document
with the largest id.  Rows of one id are one document; rows without id are one
document, below every other.  A null or empty text is one empty line.  A text
that loses all lines is empty.  Other columns pass unchanged; an empty table
gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import batches_of, fresh, shuffle_partitions, written

#: Bits of each filter, and of the blocks in which filters are merged.
BITS = 1 << 26
BLOCK_BITS = 1 << 19

MIN_CHARS = 40
MIN_DOCS = 5
#: Parts in which the documents of one line learn that it is repeated.
SALTS = 16

WHITE = " \t\n\x0b\x0c\r"


def line_key(line: str, min_chars: int) -> bytes | None:
    """The line's key, or None where it is too short to count (ASCII lower-casing is what bytes do)."""
    line = line.strip(WHITE)
    return line.encode().lower() if len(line) >= min_chars else None


def keys_of(text: str | None, min_chars: int) -> set[bytes]:
    """The distinct keys of a text that count."""
    if text is None or len(text) < min_chars:
        return set()
    return {k for line in text.split("\n") if len(line) >= min_chars and (k := line_key(line, min_chars)) is not None}


def digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


class Bits:
    """A bitmap in which a hash takes two positions."""

    def __init__(self, bits: int, held: np.ndarray | None = None):
        self.mask = np.uint64(bits - 1)
        self.held = np.zeros(bits // 8, np.uint8) if held is None else held

    def _at(self, hashes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        out = []
        for h in (hashes, hashes >> np.uint64(32)):
            p = h & self.mask
            out.append(((p >> np.uint64(3)).astype(np.int64), np.uint8(1) << (p & np.uint64(7)).astype(np.uint8)))
        return out

    def has(self, hashes: np.ndarray) -> np.ndarray:
        (a, x), (b, y) = self._at(hashes)
        return ((self.held[a] & x) != 0) & ((self.held[b] & y) != 0)

    def add(self, hashes: np.ndarray) -> None:
        for at, bit in self._at(hashes):
            np.bitwise_or.at(self.held, at, bit)


def _hashes(keys) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64)


def _packed(bits: np.ndarray) -> bytes:
    return pa.compress(bits.tobytes(), codec="zstd", asbytes=True)


def _unpacked(packed: bytes, size: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(packed, size, codec="zstd", asbytes=True), np.uint8)


def twice_filter(docs: DataFrame, text_col: str, min_chars: int = MIN_CHARS, bits: int = BITS) -> np.ndarray:
    """The merged filter of hashes seen twice: ``bits / 8`` bytes, whatever the input."""
    block_bits = min(bits, BLOCK_BITS)
    size = block_bits // 8

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = Bits(bits), Bits(bits)
        for batch in batches:
            for part in batches_of(batch, text_col):
                # a key that one document repeats is not a repeat
                found = _hashes(k for text in part.column(text_col).to_pylist() for k in keys_of(text, min_chars))
                distinct, counts = np.unique(found, return_counts=True)
                twice.add(distinct[(counts > 1) | once.has(distinct)])
                once.add(distinct)
        rows = []
        for block in range(bits // block_bits):
            a, b = (f.held[block * size:(block + 1) * size] for f in (once, twice))
            if a.any():
                rows.append((block, _packed(a), _packed(b)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else ((), (), ()),
                                            (pa.int32(), pa.binary(), pa.binary()), strict=True)],
            names=["block", "once", "twice"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, once, twice = None, None, None
        for batch in batches:
            for b, x, y in zip(*(batch.column(c).to_pylist() for c in ("block", "once", "twice")), strict=True):
                x, y = _unpacked(x, size), _unpacked(y, size)
                if b != block:
                    if block is not None:
                        yield pack(block, twice)
                    block, once, twice = b, x.copy(), y.copy()
                else:
                    twice |= y | (once & x)
                    once |= x
        if block is not None:
            yield pack(block, twice)

    def pack(block: int, held: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([_packed(held)], pa.binary())],
                                          names=["block", "twice"])

    spark = docs.sparkSession
    marked = docs.select(text_col).mapInArrow(mark, "block int, once binary, twice binary")
    merged = marked.repartition(shuffle_partitions(spark), "block").sortWithinPartitions("block").mapInArrow(
        merge, "block int, twice binary")
    out = np.zeros(bits // 8, np.uint8)
    for row in merged.toLocalIterator():        # at most bits / block_bits rows
        out[row["block"] * size:(row["block"] + 1) * size] = _unpacked(bytes(row["twice"]), size)
    return out


def suspects(docs: DataFrame, id_col: str, text_col: str, text_hash: str, twice: np.ndarray,
             min_chars: int = MIN_CHARS) -> DataFrame:
    """``(doc, text_hash, digest)`` of every line whose hash the filter holds, once per text."""
    shared = docs.sparkSession.sparkContext.broadcast(twice)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Bits(len(shared.value) * 8, shared.value)
        for batch in batches:
            for part in batches_of(batch, text_col):
                keys, rows = [], []
                for i, text in enumerate(part.column(text_col).to_pylist()):
                    found = keys_of(text, min_chars)
                    keys += found
                    rows += [i] * len(found)
                if keys:
                    hit = np.flatnonzero(held.has(_hashes(keys)))
                    at = pa.array([rows[i] for i in hit], pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [part.column(id_col).take(at), part.column(text_hash).take(at),
                         pa.array([digest(keys[i]) for i in hit], pa.binary())], names=["doc", "text_hash", "digest"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_hash, text_col).mapInArrow(
        probe, f"doc {kind}, text_hash long, digest binary")


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                        min_docs: int = MIN_DOCS, bits: int = BITS) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with repeated lines dropped from the texts, and the names of the columns added (``n_lines``, ``n_dropped``).

    A line's documents are counted by (digest, id) first and told by (digest,
    part of the documents), so a line in a third of all documents is spread
    over tasks.  The lines that a text loses are
    gathered by (id, hash of the text): never more than the text has.
    """
    n_lines, n_dropped = fresh(docs.columns, "n_lines", "n_dropped")
    text_hash, = fresh(docs.columns, "_text_hash")
    hashed = docs.withColumn(text_hash, F.xxhash64(F.coalesce(text_col, F.lit(""))))
    twice = twice_filter(docs, text_col, min_chars, bits)
    # read twice: to count, and to tell each text what it loses
    suspected = written(suspects(hashed, id_col, text_col, text_hash, twice, min_chars), "suspects")
    repeated = suspected.groupBy("digest", "doc").agg(F.lit(1).alias("_one")).groupBy("digest").agg(
        F.count(F.lit(1)).alias("docs"), F.max("doc").alias("keeper")).where(F.col("docs") >= min_docs)
    # a line in a third of all documents meets its verdict in SALTS tasks
    salt = F.pmod(F.hash("doc", "text_hash"), F.lit(SALTS)).alias("salt")
    told = repeated.select("digest", "keeper", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    lost = suspected.select("*", salt).join(told, ["digest", "salt"]).where(
        ~F.col("doc").eqNullSafe(F.col("keeper"))).groupBy("doc", "text_hash").agg(
        F.collect_set("digest").alias("_lost"))

    @F.pandas_udf("kept string, n_lines long, n_dropped long")
    def drop(texts: pd.Series, gone: pd.Series) -> pd.DataFrame:
        rows = []
        for text, digests in zip(texts, gone, strict=True):
            lines = text.split("\n")
            if digests is None or not len(digests):
                rows.append((text, len(lines), 0))
                continue
            out = set(map(bytes, digests))
            kept = [x for x in lines if (k := line_key(x, min_chars)) is None or digest(k) not in out]
            rows.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
        return pd.DataFrame(rows, columns=["kept", "n_lines", "n_dropped"])

    doc, theirs, gone, new = fresh([*docs.columns, text_hash, n_lines, n_dropped], "_doc", "_theirs", "_gone", "_new")
    joined = hashed.join(lost.select(F.col("doc").alias(doc), F.col("text_hash").alias(theirs), F.col("_lost").alias(gone)),
                       F.col(id_col).eqNullSafe(F.col(doc)) & (F.col(text_hash) == F.col(theirs)), "left")
    judged = joined.withColumn(new, drop(F.coalesce(text_col, F.lit("")), F.col(gone)))
    columns = [F.col(f"{new}.kept").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return judged.select(*columns, F.col(f"{new}.n_lines").alias(n_lines), F.col(f"{new}.n_dropped").alias(n_dropped)), {
        "n_lines": n_lines, "n_dropped": n_dropped}


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document: ``n_lines`` before dropping, ``n_dropped``, and the digest of what stays."""
    kept, added = drop_repeated_lines(docs.select(id_col, text_col), id_col, text_col, **options)
    return kept.select(id_col, F.col(added["n_lines"]).alias("n_lines"), F.col(added["n_dropped"]).alias("n_dropped"),
                       F.sha2(F.col(text_col), 256).alias("kept_sha256"))
