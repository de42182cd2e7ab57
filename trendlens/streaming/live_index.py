"""A search index kept current by a stream of posts.

Each micro-batch publishes, under one commit:

- ``store``: the texts whose counts changed (a delta of the keyed store);
- ``postings``: the postings of those texts, sorted by term.

A posting belongs to the text its version's store row holds.  Where another
text takes over an id (two texts with one 32-bit id: the smaller one stays), or
a text is seen again, a later version holds the document's postings anew; a
reader takes, for the documents a query matches, only the postings of their
newest version.  Every ``compact_every`` batches both tables are written whole
instead, which bounds how many versions a reader unions.  A micro-batch costs
the tokenisation of its changed texts plus a share of one compaction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from trendlens.operators.search import SearchIndex
from trendlens.operators.store import STORE_KEYS, doc_store
from trendlens.streaming.running import start_foreach_batch
from trendlens.streaming.snapshots import Snapshots, new_attempt

STORE_COLUMNS = [*STORE_KEYS, "text", "count"]


def running_search_index(posts: DataFrame, snapshots: Snapshots, checkpoint: str,
                         compact_every: int = 16, trigger: dict | None = None,
                         name: str | None = None, state_partitions: int | None = None,
                         id_mode: str = "java") -> StreamingQuery:
    """Count posts into the store and keep its search index current (tables ``store``, ``postings``)."""
    counts = doc_store(posts, id_mode=id_mode)

    def publish(batch: DataFrame, batch_id: int) -> None:
        spark, attempt = batch.sparkSession, new_attempt()
        changed = batch.select(*STORE_COLUMNS).persist()
        try:
            prev = snapshots.latest_commit(spark, before=batch_id)
            state, base = changed, batch_id
            if prev is not None and batch_id - prev[1] >= compact_every:
                old = snapshots.read_keyed(spark, "store", STORE_KEYS, version=prev[0])
                state = old.join(changed.select(*STORE_KEYS), STORE_KEYS, "left_anti").unionByName(changed)
            elif prev is not None:
                base = prev[1]
            path = snapshots.path("store", batch_id, attempt)
            state.write.parquet(path)
            postings = SearchIndex.postings_of(spark.read.schema(state.schema).parquet(path))
            postings.sortWithinPartitions("field", "term").write.parquet(
                snapshots.path("postings", batch_id, attempt))
            snapshots.commit(spark, batch_id, base, attempt)
        finally:
            changed.unpersist()

    return start_foreach_batch(counts, publish, checkpoint, "update", trigger, name, state_partitions)


def live_index(spark: SparkSession, snapshots: Snapshots) -> SearchIndex | None:
    """The search index as of the latest committed micro-batch (None before the first)."""
    chain = snapshots.chain(spark)
    if not chain:
        return None
    return SearchIndex(snapshots.read_versions(spark, "store", chain),
                       snapshots.read_versions(spark, "postings", chain), version_col="_v")
