"""trendlens: trending-word counting, sketches and text search on Spark.

Every operator is a plain function from DataFrame(s) to a DataFrame built from
built-in Column expressions, so Catalyst plans it and it runs wherever the
SparkSession runs.  Sub-packages:

- ``functions``  Column-level helpers (word split, analyser, hashes).
- ``sources``    readers for posts, stop words and the fixed sentences.
- ``operators``  stop-word removal, Bloom filter, count-min sketch, top-k,
                 counted document store, text search, entity extraction.
- ``streaming``  the same operators as Structured Streaming jobs.
- ``plans``      named end-to-end queries on the test tables.
"""

from trendlens.session import checkpoint_root, get_session

__all__ = ["get_session", "checkpoint_root"]
