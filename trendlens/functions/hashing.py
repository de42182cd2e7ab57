"""Hash functions used as ids and sketch buckets.

All are built-in JVM expressions; none of them round-trips through Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_string_hash(c: str | Column) -> Column:
    """the 32-bit polynomial string hash (x31 over UTF-16 units), signed int.

    ``java.util.Objects.hashCode`` on the string is exactly that hash, so the
    built-in ``reflect`` evaluates it in the JVM with no per-character lambda.
    """
    return F.call_function("reflect", F.lit("java.util.Objects"), F.lit("hashCode"),
                           _col(c)).cast("int")


def java_string_hash_text(c: str | Column) -> Column:
    """F6 as the decimal string used as a document id (``"-534010419"``)."""
    return java_string_hash(c).cast("string")


def content_id(content_type: str | Column, content_name: str | Column) -> Column:
    """md5 hex of ``type + name`` hashed as UTF-16LE code units.

    A null name takes part as the text ``null`` (string concatenation rule).
    """
    joined = F.concat(_col(content_type), F.coalesce(_col(content_name).cast("string"), F.lit("null")))
    return F.md5(F.encode(joined, "UTF-16LE"))


HASH_KINDS = ("md5", "xxhash64")


def base_hashes(c: str | Column, kind: str = "md5") -> tuple[Column, Column]:
    """F7 base pair as two unsigned 32-bit values in bigints.

    ``md5``: the two leading 32-bit words of ``md5(utf8(c))`` (portable: the
    same formula runs in other SQL engines, which is how results are checked).
    ``xxhash64``: the low and high halves of Spark's seeded 64-bit xxHash of
    the text -- much cheaper per item, for large jobs that need no parity.
    """
    text = _col(c).cast("string")
    if kind == "md5":
        digest = F.md5(text)
        h1 = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
        h2 = F.conv(F.substring(digest, 9, 8), 16, 10).cast("bigint")
        return h1, h2
    if kind == "xxhash64":
        x = F.xxhash64(text)
        return x.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(x, 32)
    raise ValueError(f"unknown hash kind {kind!r}; expected one of {HASH_KINDS}")


def bucket(h1: Column, h2: Column, i: Column | int, width: int) -> Column:
    """F7 double hashing: ``bucket_i = (h1 + i * h2) mod width`` (h1, h2 >= 0)."""
    i_col = i if isinstance(i, Column) else F.lit(i)
    return F.pmod(h1 + i_col.cast("bigint") * h2, F.lit(width).cast("bigint"))
