"""Training-data pipeline: from documents to token ids.

Stages, in order; each takes (spark, docs, sf_dir) and returns a DataFrame,
which is written as Parquet and read again as the next stage's documents.
All but the last return the columns of documents.

1. quality   documents that the quality classifier rejects go
2. jaccard   of each group of near duplicates, the document with the smallest id stays
3. secrets   secrets in texts are replaced, lengths follow
4. mix       documents are taken as often as the mix to source targets says
5. bpe       token ids of every document taken, and digests of ids and of the text decoded from them
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.llm import bpe_automaton, cube_mix, jaccard_join, quality, secret_scan
from trendlens.llm.common import read_table
from trendlens.llm.queries import WORD_BPE
from trendlens.session import scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents the classifier, fitted on ``labels``, does not reject."""
    labels = read_table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    judged, added = quality.classify(docs, labels)
    return judged.where(F.col(added["keep"])).select(*docs.columns)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group."""
    return jaccard_join.keep_one(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets; every document stays."""
    return secret_scan.redact_documents(docs, length_col="n_chars")


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents as the mix to source targets says."""
    return cube_mix.mixed_documents(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document taken: ids (little-endian unsigned 32-bit) and digests of ids and decoded text."""
    return bpe_automaton.encode_texts(docs, WORD_BPE).select(
        "doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("jaccard", jaccard_stage),
    ("secrets", secrets_stage),
    ("mix", mix_stage),
    ("bpe", bpe_stage),
]

#: The classifier and the sampling have no SQL form; tests compare each stage to a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
