"""Batch-versioned snapshot tables written from ``foreachBatch``.

Layout under ``root`` (a folder in the shared checkpoint directory):

    data/<table>/v=<batch_id>/<attempt>/   the table's rows written by that attempt at the batch
    commits/                               one row per commit: (batch, base, attempt, chain), appended last

Small tables (a top-k, sketch cells) are written whole every batch
(``publish``).  Keyed tables that grow with the stream (the counted store)
use ``upsert``: a batch writes only its changed rows (a delta) and, every
``compact_every`` batches, a full base instead; the commit row's ``chain`` names
that base and the deltas after it, with the attempt that wrote each, so one row
of the commit folder tells a reader all it needs and a writer reads none while
it follows its own last commit.  ``read_keyed`` takes the chain and keeps, per
key, the row of the newest version.  So a micro-batch costs O(changed rows)
plus an amortised share of one compaction, and a reader merges at most
``compact_every`` deltas.

A replayed micro-batch rebuilds from the last committed version *before* its
own id and writes to a folder of its own, which its commit names; of several
commits for one batch the latest counts.  So replays neither lose nor double
count, and nothing that a reader may hold is ever rewritten.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

COMMIT_SCHEMA = "batch bigint, base bigint, attempt string, chain array<struct<v:bigint,attempt:string>>"


def new_attempt() -> str:
    """A name for one attempt at a batch; later attempts sort after earlier ones."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


class Snapshots:
    def __init__(self, root: str):
        self.root = root.rstrip("/")
        # the last commit this object wrote: a micro-batch normally follows
        # the one just published, which then needs no lookup
        self._last: tuple[int, list[tuple[int, str]]] | None = None

    def path(self, table: str, version: int, attempt: str) -> str:
        return f"{self.root}/data/{table}/v={version}/{attempt}"

    # -- commits -------------------------------------------------------------
    def commit(self, spark: SparkSession, batch_id: int, base: int, attempt: str) -> None:
        """The batch's commit; ``base`` is itself or the base of the commit before it."""
        chain = [(int(batch_id), attempt)]
        if base != batch_id:
            chain = [*self.chain(spark, before=batch_id), *chain]
        spark.createDataFrame([(int(batch_id), int(base), attempt, chain)], COMMIT_SCHEMA).coalesce(1) \
            .write.mode("append").parquet(f"{self.root}/commits")
        self._last = (int(batch_id), chain)

    def _rows(self, spark: SparkSession) -> DataFrame | None:
        """The commit rows; None before the first."""
        try:
            return spark.read.schema(COMMIT_SCHEMA).parquet(f"{self.root}/commits")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _commits(self, spark: SparkSession) -> DataFrame | None:
        """One row per committed batch: its latest commit; None before the first."""
        rows = self._rows(spark)
        if rows is None:
            return None
        last = rows.groupBy("batch").agg(F.max(F.struct("attempt", "base")).alias("c"))
        return last.select("batch", "c.base", "c.attempt")

    def chain(self, spark: SparkSession, before: int | None = None) -> list[tuple[int, str]]:
        """(version, attempt) of the base and deltas of the highest commit (below ``before`` when given); one read.

        At most ``compact_every`` + 1 of them, oldest first; none before the first commit.
        """
        if before is not None and self._last is not None and self._last[0] == before - 1:
            return self._last[1]
        rows = self._rows(spark)
        if rows is None:
            return []
        if before is not None:
            rows = rows.where(F.col("batch") < before)
        head = rows.orderBy(F.col("batch").desc(), F.col("attempt").desc()).limit(1).collect()
        return [(int(c["v"]), c["attempt"]) for c in head[0]["chain"]] if head else []

    def latest_commit(self, spark: SparkSession, before: int | None = None) -> tuple[int, int] | None:
        """``(version, base)`` of the highest commit (below ``before`` when given)."""
        chain = self.chain(spark, before)
        return (chain[-1][0], chain[0][0]) if chain else None

    def latest_version(self, spark: SparkSession, before: int | None = None) -> int | None:
        """Highest committed version (below ``before`` when given); None when there is none."""
        c = self.latest_commit(spark, before)
        return None if c is None else c[0]

    # -- whole tables ----------------------------------------------------------
    def publish(self, spark: SparkSession, tables: dict[str, DataFrame], batch_id: int,
                attempt: str | None = None) -> None:
        """Write every table whole for ``batch_id``, then the commit."""
        attempt = attempt or new_attempt()
        for name, df in tables.items():
            df.write.parquet(self.path(name, batch_id, attempt))
        self.commit(spark, batch_id, batch_id, attempt)

    def read(self, spark: SparkSession, table: str, version: int | None = None) -> DataFrame | None:
        """A whole table at ``version`` (default: the latest committed); None before the first commit."""
        chain = self.chain(spark, None if version is None else version + 1)
        if not chain or version is not None and chain[-1][0] != version:
            return None
        return spark.read.parquet(self.path(table, *chain[-1]))

    # -- keyed tables: base + deltas ---------------------------------------------
    def upsert(self, spark: SparkSession, table: str, changed: DataFrame, keys: list[str], batch_id: int,
               compact_every: int = 16) -> None:
        """``changed`` rows replace theirs by key, as version ``batch_id``.

        ``changed`` is computed once, also where a compaction reads it twice.
        """
        prev, attempt = self.chain(spark, before=batch_id), new_attempt()
        if not prev or batch_id - prev[0][0] >= compact_every:
            held = changed.persist()
            try:
                state = held
                if prev:
                    old = self._merged(spark, table, keys, prev)
                    state = old.join(held.select(*keys), keys, "left_anti").unionByName(held)
                state.write.parquet(self.path(table, batch_id, attempt))
            finally:
                held.unpersist()
            self.commit(spark, batch_id, batch_id, attempt)
        else:
            changed.write.parquet(self.path(table, batch_id, attempt))
            self.commit(spark, batch_id, prev[0][0], attempt)

    def obsolete_versions(self, spark: SparkSession, keep_bases: int = 1) -> DataFrame | None:
        """Committed versions no reader needs: those older than the ``keep_bases``-th newest base.

        Returns a DataFrame ``(batch)`` (it grows with the stream's history,
        so it is not collected here); a lifecycle job removes
        ``data/*/v=<batch>`` for each row.
        """
        commits = self._commits(spark)
        if commits is None:
            return None
        bases = commits.where(F.col("batch") == F.col("base")).select("batch") \
            .orderBy(F.col("batch").desc()).limit(keep_bases).agg(F.min("batch").alias("oldest_kept"))
        oldest = bases.first()["oldest_kept"]
        if oldest is None:
            return commits.limit(0).select("batch")
        return commits.where(F.col("batch") < oldest).select("batch")

    def read_keyed(self, spark: SparkSession, table: str, keys: list[str],
                   version: int | None = None) -> DataFrame | None:
        """The keyed table as of a committed version (default: the latest)."""
        chain = self.chain(spark, None if version is None else version + 1)
        return self._merged(spark, table, keys, chain) if chain else None

    def _merged(self, spark: SparkSession, table: str, keys: list[str], chain: list[tuple[int, str]]) -> DataFrame:
        union = self.read_versions(spark, table, chain)
        if len(chain) == 1:
            return union.drop("_v")
        # keys are unique within a version, so each key has at most 1 + compact_every rows
        newest = Window.partitionBy(*keys).orderBy(F.col("_v").desc())
        return union.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") == 1).drop("_v", "_rank")

    def read_versions(self, spark: SparkSession, table: str, chain: list[tuple[int, str]]) -> DataFrame:
        """All rows of a base and the deltas after it, with their version ``_v``."""
        schema, union = None, None
        for v, attempt in chain:
            reader = spark.read if schema is None else spark.read.schema(schema)
            part = reader.parquet(self.path(table, v, attempt))
            schema = schema or part.schema
            part = part.withColumn("_v", F.lit(v))
            union = part if union is None else union.unionByName(part)
        return union
