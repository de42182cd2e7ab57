"""Bloom filter over strings.

Sizing follows the published formulas: ``m = floor(-n ln p / (ln 2)^2)`` bits
and ``k = max(1, round(m / n * ln 2))`` probes; 500 items at 1 % give 4792
bits and 7 probes.  Probe positions use the same double hashing as the
count-min sketch: ``pos_i = (h1 + i*h2) mod m`` for ``i < k``.

The filter is a table of blocks: ``(block bigint, bits binary)``, each block a
bitmap of ``BLOCK_BITS`` positions built by Spark's bitmap aggregate.  Its size
follows the capacity and is spread over tasks like any table.  An item's
positions are grouped by block, so probing takes one row for each block that an
item touches.  A filter of one block (4 KB) is a value of the plan: items are
flagged in one projection.  A larger filter is joined by block: broadcast while
its size, which the capacity fixes, is at most ``BROADCAST_BYTES``, else
shuffled, each block in ``SALTS`` copies that share its probes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.functions.hashing import base_hashes

#: Positions of one block; fixed by Spark's bitmap functions.
BLOCK_BITS = 32_768

#: The size up to which a filter is broadcast, and the copies of a block beyond it.
BROADCAST_BYTES = 8 << 20
SALTS = 8


def bloom_size(capacity: int, fpp: float) -> tuple[int, int]:
    """``(bits, probes)`` for ``capacity`` items at false-positive rate ``fpp``."""
    m = int(-capacity * math.log(fpp) / (math.log(2) ** 2))
    k = max(1, round(m / capacity * math.log(2)))
    return m, k


def positions(c: Column, num_bits: int, num_hashes: int, hash_kind: str = "md5") -> Column:
    """The ``num_hashes`` bit positions of the string ``c``."""
    h1, h2 = base_hashes(c, hash_kind)
    return F.transform(F.sequence(F.lit(0), F.lit(num_hashes - 1)),
                       lambda i: F.pmod(h1 + i.cast("bigint") * h2, F.lit(num_bits).cast("bigint")))


@dataclass(frozen=True)
class BloomFilter:
    """``blocks``: the bit table ``(block, bits)`` of ``num_bits`` bits probed ``num_hashes`` times."""

    blocks: DataFrame
    num_bits: int
    num_hashes: int
    hash_kind: str = "md5"

    def flag(self, items: DataFrame, col: str, out: str = "maybe", lowercase: bool = True) -> DataFrame:
        """``items`` with a boolean ``out``: every probe position of ``col`` is set (no false negatives); a null is never a member."""
        value = F.lower(F.col(col)) if lowercase else F.col(col)
        if self.num_bits <= BLOCK_BITS:
            bits = self.blocks.select("bits").scalar()      # 4 KB, or null where no item was added
            h1, h2 = base_hashes(value, self.hash_kind)
            # hashed in a step of its own, once a row; a filter on the flag stays above it, so that
            # counted words are probed after they are counted, not at each place
            hashed = items.select("*", F.inline(F.array(F.struct(h1.alias("_h1"), h2.alias("_h2")))))
            held = [self._is_set(bits, F.pmod(F.col("_h1") + F.col("_h2") * i, F.lit(self.num_bits).cast("bigint")))
                    for i in range(self.num_hashes)]
            return hashed.withColumn(out, F.coalesce(reduce(and_, held), F.lit(False))).drop("_h1", "_h2")
        # each distinct value is probed once
        asked = items.select(value.alias("_item")).where(F.col("_item").isNotNull()).distinct()
        pos = F.transform(positions(F.col("_item"), self.num_bits, self.num_hashes, self.hash_kind),
                          lambda p: F.struct(F.floor(p / BLOCK_BITS).alias("block"), (p % BLOCK_BITS).alias("bit")))
        grouped = asked.select("_item", pos.alias("_pos")).select("_item", "_pos", F.explode(
            F.array_distinct(F.transform("_pos", lambda p: p["block"]))).alias("block"))
        grouped = grouped.select("_item", "block", F.transform(F.filter(
            "_pos", lambda p: p["block"] == F.col("block")), lambda p: p["bit"]).alias("_bits"))
        if self.num_bits // 8 <= BROADCAST_BYTES:
            probed = grouped.join(F.broadcast(self.blocks), "block", "left")
        else:
            copies = self.blocks.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            probed = grouped.withColumn("_salt", F.pmod(F.hash("_item"), F.lit(SALTS))).join(
                copies, ["block", "_salt"], "left")
        is_set = F.coalesce(F.forall("_bits", lambda b: self._is_set(F.col("bits"), b)), F.lit(False))
        members = probed.groupBy(F.col("_item").alias("_probed")).agg(F.every(is_set).alias("_member"))
        return items.join(members, value == F.col("_probed"), "left").withColumn(
            out, F.coalesce("_member", F.lit(False))).drop("_member", "_probed")

    @staticmethod
    def _is_set(bits: Column, offset: Column) -> Column:
        """Is the bit at ``offset`` set in the block ``bits``?"""
        byte = F.conv(F.hex(F.substring(bits, F.floor(offset / 8).cast("int") + 1, F.lit(1))), 16, 10)
        return F.getbit(byte.cast("int"), (offset % 8).cast("int")) == 1

    def bits_set(self) -> DataFrame:
        """One row: how many bits are set."""
        return self.blocks.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("bits_set"))

    @property
    def expected_fpp(self) -> float:
        """Chance that an absent word passes, given the bits actually set."""
        return (self.bits_set().first()[0] / self.num_bits) ** self.num_hashes


def build_bloom(df: DataFrame, col: str = "w", capacity: int = 500, fpp: float = 0.01,
                lowercase: bool = True, hash_kind: str = "md5") -> BloomFilter:
    """Build from the values of ``col`` (lower-cased by default); nothing passes the driver."""
    m, k = bloom_size(capacity, fpp)
    value = F.lower(F.col(col)) if lowercase else F.col(col)
    pos = df.select(F.explode(positions(value, m, k, hash_kind)).alias("pos"))
    blocks = pos.groupBy(F.floor(F.col("pos") / BLOCK_BITS).alias("block")).agg(
        F.bitmap_construct_agg((F.col("pos") % BLOCK_BITS).cast("long")).alias("bits"))
    return BloomFilter(blocks, m, k, hash_kind)


def bloom_drop(df: DataFrame, bloom: BloomFilter, col: str = "w", lowercase: bool = True) -> DataFrame:
    """Drop rows the filter says might be members (stop words and rare false positives)."""
    return bloom.flag(df, col, "_maybe", lowercase).where(~F.col("_maybe")).drop("_maybe")
