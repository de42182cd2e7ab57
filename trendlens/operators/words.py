"""Word streams: split, stop-word exclusion, exact counts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.functions.text import analyze, explode_word_runs, explode_words
from trendlens.sources.stopwords import ENGLISH_STOP_WORDS

#: Bytes of words that a task counts at once, and of counted words that it holds before it sends them on.
COUNT_BYTES = 16 << 20
HELD_BYTES = 32 << 20


def tokens(df: DataFrame, text_col: str = "text", out: str = "w", sep: str = " ",
           keep: list[str] | None = None, count: str | None = None) -> DataFrame:
    """P3 + F2: lower-case ``text_col`` and emit one row per non-empty word.

    With ``count``, a task's equal words are one row and this column has their
    number: an aggregate without a shuffle and without state, for streams
    whose next operator keeps the state.  A word comes once a task, or once
    for every ``HELD_BYTES`` of a task's different words.
    """
    if count is None:
        return explode_words(df, text_col, out=out, sep=sep, keep=keep)
    if keep:
        raise ValueError("words that are counted keep no columns")
    runs = explode_word_runs(df, text_col, out=out, sep=sep)
    return runs.mapInArrow(_count_runs, "w string, n bigint").select(
        F.col("w").alias(out), F.col("n").alias(count)).where(F.col(out) != "")


def _count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``w, n`` of the words in a task's arrays; memory is bounded, so a word may come again."""
    held, taken, size = None, [], 0
    for batch in batches:
        taken.append(batch.column(0).flatten())
        size += taken[-1].nbytes
        if size >= COUNT_BYTES:
            held, taken, size = _counted(taken, held), [], 0
            if held.nbytes >= HELD_BYTES:
                yield from held.to_batches()
                held = None
    if taken:
        held = _counted(taken, held)
    if held is not None:
        yield from held.to_batches()


def _counted(words: list[pa.Array], held: pa.Table | None) -> pa.Table:
    """``w, n`` of ``words``, added to those held."""
    counts = pa.table({"w": pa.chunked_array(words)}).group_by("w", use_threads=False).aggregate(
        [([], "count_all")]).rename_columns(["w", "n"])
    if held is None:
        return counts
    return pa.concat_tables([held, counts]).group_by("w", use_threads=False).aggregate(
        [("n", "sum")]).rename_columns(["w", "n"])


StopWords = DataFrame | list | tuple | None


def _cleaned(stop: DataFrame) -> DataFrame:
    """One column ``_stop_w``: stripped, lower-cased, distinct, no blank and no null."""
    return stop.select(F.lower(F.trim(F.col("w"))).alias("_stop_w")).where(F.col("_stop_w") != "").distinct()


def _values(stop: list | tuple | None) -> list[str]:
    words = ENGLISH_STOP_WORDS if stop is None else stop
    return list(dict.fromkeys(w.strip().lower() for w in words if w and w.strip()))


def drop_stop_words(df: DataFrame, col: str = "w", stop: StopWords = None) -> DataFrame:
    """J2 exact: drop rows whose lower-cased ``col`` is a stop word; a null is none and stays.

    A stop list given as values (default: the bundled list) becomes a ``NOT
    IN`` over a literal set -- a hash lookup inside the scan's generated code.
    One given as a DataFrame (column ``w``) is a left-anti join, whose kind
    Spark picks from sizes.  Both forms are cleaned alike and give equal rows.
    """
    if isinstance(stop, DataFrame):
        return df.join(_cleaned(stop), F.lower(F.col(col)) == F.col("_stop_w"), "left_anti")
    return df.where(F.coalesce(~F.lower(F.col(col)).isin(_values(stop)), F.lit(True)))


def flag_stop_words(df: DataFrame, col: str = "w", stop: StopWords = None,
                    out: str = "is_stop") -> DataFrame:
    """Keep every row and add a boolean ``out`` telling whether ``col`` is a stop word (false for null)."""
    if not isinstance(stop, DataFrame):
        return df.withColumn(out, F.coalesce(F.lower(F.col(col)).isin(_values(stop)), F.lit(False)))
    side = _cleaned(stop).withColumn("_stop_hit", F.lit(True))
    joined = df.join(side, F.lower(F.col(col)) == F.col("_stop_w"), "left")
    return joined.withColumn(out, F.coalesce(F.col("_stop_hit"), F.lit(False))).drop("_stop_w", "_stop_hit")


def word_counts(df: DataFrame, col: str = "w", out: str = "count") -> DataFrame:
    """Exact count per word; partial aggregation combines each task's words before the shuffle."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(out))


def track_filter(posts: DataFrame, keywords: list[str] | tuple[str, ...] | None,
                 text_col: str = "text", lang_col: str = "lang", language: str = "en") -> DataFrame:
    """With keywords, keep posts in ``language`` that mention any keyword.

    A keyword matches when all of its analysed words are analysed words of the
    text (case-insensitive; ``#``/``@`` and punctuation are boundaries).  With
    no keywords nothing is filtered, not even the language.
    """
    if not keywords:
        return posts
    # the keywords' analysed words, by the same expression as the texts (one folded row)
    kw_words = [list(r) for r in posts.sparkSession.range(1).select(
        *[analyze(F.lit(k)).alias(f"k{i}") for i, k in enumerate(keywords)]).first()]
    kw_words = [w for w in kw_words if w]
    if not kw_words:
        return posts.where(F.lit(False))
    toks = analyze(F.col(text_col))
    singles = sorted({w[0] for w in kw_words if len(w) == 1})
    multis = [w for w in kw_words if len(w) > 1]
    exact = []
    if singles:
        # one hashed overlap test for every one-word keyword at once
        exact.append(F.arrays_overlap(toks, F.array(*[F.lit(w) for w in singles])))
    for words_ in multis:
        exact.append(F.size(F.array_except(F.array(*[F.lit(w) for w in words_]), toks)) == 0)
    # every analysed token is a substring of the lower-cased text, so this
    # cheap test is a necessary condition and spares the split for most posts
    lowered = F.lower(F.col(text_col))
    maybe = F.lit(False)
    for words_ in kw_words:
        pre = F.lit(True)
        for w in words_:
            pre = pre & (F.instr(lowered, w) > 0)
        maybe = maybe | pre
    cond = (F.col(lang_col) == F.lit(language)) & maybe
    any_exact = exact[0]
    for e in exact[1:]:
        any_exact = any_exact | e
    return posts.where(cond & any_exact)
