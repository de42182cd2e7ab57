"""Structured Streaming jobs: running counts, running sketch, running top-k."""

from trendlens.streaming.landing import land_posts
from trendlens.streaming.live_index import live_index, running_search_index
from trendlens.streaming.running import (
    running_approx_top_k,
    running_doc_counts,
    running_sketch_top_k,
    running_word_top_k,
)
from trendlens.streaming.snapshots import Snapshots
from trendlens.streaming.state import own_sketch_top_k, poll, running_counts_state, running_own_sketch

__all__ = ["Snapshots", "land_posts", "live_index", "own_sketch_top_k", "poll", "running_approx_top_k",
           "running_counts_state", "running_doc_counts", "running_own_sketch", "running_search_index",
           "running_sketch_top_k", "running_word_top_k"]
