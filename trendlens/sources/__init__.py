"""Readers for posts, stop words and fixed sentences, plus table adapters."""

from trendlens.sources.fixed import FIXED_SENTENCES, fixed_sentences
from trendlens.sources.posts import (
    POST_SCHEMA,
    conversations_as_posts,
    documents_as_posts,
    pages_as_posts,
    parse_raw_posts,
    posts_from_kafka,
    read_posts,
    read_posts_stream,
)
from trendlens.sources.stopwords import (
    ENGLISH_STOP_WORDS,
    ENGLISH_STOP_WORDS_LINES,
    read_stop_words,
    stop_words_df,
)

__all__ = [
    "ENGLISH_STOP_WORDS", "ENGLISH_STOP_WORDS_LINES", "FIXED_SENTENCES", "POST_SCHEMA",
    "conversations_as_posts", "documents_as_posts", "fixed_sentences", "pages_as_posts",
    "parse_raw_posts", "posts_from_kafka", "read_posts", "read_posts_stream", "read_stop_words", "stop_words_df",
]
