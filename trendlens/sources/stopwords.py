"""Stop-word sources.

``ENGLISH_STOP_WORDS`` is the bundled English list.  ``read_stop_words`` loads
any one-word-per-line UTF-8 file and cleans it the same way: strip a byte-order
mark and CR line ends, trim, lower-case, drop empty lines, de-duplicate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The English stop-word list, in its published line order
# (193 lines; "a" and "should" appear twice, so 191 distinct words).
_ENGLISH_STOP_WORDS_TEXT = """
a about above after again against all am an and any are aren't as at be because
been before being below between both but by can't cannot could couldn't did didn't
do does doesn't doing don't down during each few for from further had hadn't has
hasn't have haven't having he he'd he'll he's her here here's hers herself him
himself his how how's i i'd i'll i'm i've if in into is isn't it it's its itself
let's me more most mustn't my myself no nor not of off on once only or other ought
our ours ourselves out over own same shan't she she'd she'll she's should shouldn't
so some such than that that's the their theirs them themselves then there there's
these they they'd they'll they're they've this those through to too u under until
up very was wasn't we we'd we'll we're we've were weren't what what's when when's
where where's which while who who's whom why why's with won't would wouldn't you
you'd you'll you're you've your yours yourself yourselves rt - will & a y just can
should like get por de que el follow much one
"""

ENGLISH_STOP_WORDS_LINES: tuple[str, ...] = tuple(_ENGLISH_STOP_WORDS_TEXT.split())
ENGLISH_STOP_WORDS: tuple[str, ...] = tuple(dict.fromkeys(ENGLISH_STOP_WORDS_LINES))


def stop_words_df(spark: SparkSession, words: tuple[str, ...] | list[str] | None = None) -> DataFrame:
    """The stop words as a one-column DataFrame ``w`` (bundled list by default)."""
    data = ENGLISH_STOP_WORDS if words is None else tuple(dict.fromkeys(w.strip().lower() for w in words))
    return spark.createDataFrame([(w,) for w in data if w], "w string")


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, UTF-8; cleaned (BOM, CR, blanks, case, duplicates)."""
    raw = spark.read.text(path)
    cleaned = F.lower(F.trim(F.regexp_replace(F.col("value"), "^﻿|\r$", "")))
    return raw.select(cleaned.alias("w")).where(F.col("w") != "").distinct()
