"""Column-level helpers: text splitting, analyser, hashes."""

from trendlens.functions.hashing import (
    base_hashes,
    bucket,
    content_id,
    java_string_hash,
    java_string_hash_text,
)
from trendlens.functions.text import (
    ANALYZER_SPLIT,
    analyze,
    as_text,
    explode_words,
    java_regex_quote,
    lower_text,
    split_keep_empty,
    to_json_row,
    words,
)

__all__ = [
    "ANALYZER_SPLIT", "analyze", "as_text", "base_hashes", "bucket", "content_id",
    "explode_words", "java_regex_quote", "java_string_hash", "java_string_hash_text",
    "lower_text", "split_keep_empty", "to_json_row", "words",
]
