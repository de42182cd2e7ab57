"""Column-level text helpers.

Two word rules exist on purpose:

- ``words`` (F2) serves counting: split on one space, keep punctuation, ``@``
  and ``#`` inside words, drop empty pieces.
- ``analyze`` serves search: lower-case, split on runs of anything that is
  not a letter or digit, drop empty pieces.  No stemming, no stop words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the search analyser's token boundary (any run of characters that
# are neither letters nor digits).
ANALYZER_SPLIT = r"[^\p{L}\p{N}]+"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lower_text(c: str | Column) -> Column:
    """lower-case."""
    return F.lower(_col(c))


def java_regex_quote(literal: str) -> str:
    """Quote a literal for a Java regex, as ``Pattern.quote`` does."""
    return "\\Q" + literal.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def split_keep_empty(c: str | Column, sep: str) -> Column:
    """split on a literal separator and keep empty pieces (``a,,b,`` -> a,'',b,'')."""
    return F.split(_col(c), java_regex_quote(sep), -1)


def words(c: str | Column, sep: str = " ") -> Column:
    """F2 as an array: split on ``sep`` (a regex; default one space), drop ''."""
    return F.array_remove(F.split(_col(c), sep), "")


def analyze(c: str | Column) -> Column:
    """Search analyser: lower-case, split on non letter/digit runs, drop ''.

    ``array_remove`` rather than a lambda filter keeps it in generated code.
    """
    return F.array_remove(F.split(F.lower(_col(c)), ANALYZER_SPLIT), "")


def explode_words(df: DataFrame, text_col: str, out: str = "w", sep: str = " ",
                  lowercase: bool = True, keep: list[str] | None = None) -> DataFrame:
    """F1+F2 as rows: one row per non-empty word of ``text_col``.

    The empty-piece filter runs after the explode so it stays inside the
    generated code of the scan stage instead of a lambda per array.
    """
    text = F.lower(F.col(text_col)) if lowercase else F.col(text_col)
    cols = [F.col(k) for k in (keep or [])]
    return (df.select(*cols, F.explode(F.split(text, sep)).alias(out))
              .where(F.col(out) != ""))


def explode_word_runs(df: DataFrame, text_col: str, out: str = "words", sep: str = " ", run: int = 32) -> DataFrame:
    """F1+F2 as rows of up to ``run`` neighbouring pieces of ``text_col`` (an array ``out``); empty pieces stay.

    For Python workers: a row costs the way there far more than a word does,
    and a row with all words of a text would have no bound.
    """
    # a text is split once: its pieces are the one element of the outer array
    pieces = F.array(F.split(F.lower(F.col(text_col)), sep))
    runs = F.transform(pieces, lambda p: F.transform(
        F.sequence(F.lit(1), F.size(p), F.lit(run)), lambda i: F.slice(p, i, run)))
    return df.where(F.col(text_col).isNotNull()).select(F.explode(F.get(runs, F.lit(0))).alias(out))


def to_json_row(*cols: str) -> Column:
    """the named columns as one JSON object string."""
    return F.to_json(F.struct(*[F.col(c) for c in cols]))


def as_text(c: str | Column) -> Column:
    """number to decimal string."""
    return _col(c).cast("string")
