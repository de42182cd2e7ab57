"""The operators' registered queries, each over its whole table, and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.llm import (
    bpe_automaton,
    chat_windows,
    cube_mix,
    jaccard_join,
    license_scan,
    line_dedup,
    nn_descent,
    piecewise_hash,
    prefix_trie,
    quality,
    secret_scan,
    structure_repair,
    token_files,
)
from trendlens.llm.common import read_table
from trendlens.llm.oracle import ORACLE

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


#: A conversation whose texts hold the marks of common templates.
MARKS = r"\### Assistant: </turn> ok"


def op1_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the sources' targets by balanced sampling."""
    return cube_mix.mix(read_table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents the classifier keeps, with their chances and evidence."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang")
    labels = read_table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    judged, _ = quality.classify(docs, labels, keep_text=False)
    return judged.where("keep").drop("keep")


def op3_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold template marks, formatted and read back."""
    turns = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    marked = spark.createDataFrame([(-7, 0, "user", MARKS), (-7, 1, "assistant", MARKS)], turns.schema)
    return chat_windows.format_and_read(turns.unionByName(marked))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written as rANS segments and read back."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return token_files.read_tokens(token_files.write_tokens(docs, BYTE_BPE))


def op5_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded by the tokenization automaton, decoded, and digested."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return bpe_automaton.digests(bpe_automaton.encode_texts(docs, WORD_BPE))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and template matches of all documents."""
    return license_scan.scan_documents(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest neighbours of every hundredth vector among all others."""
    vectors = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return nn_descent.nearest_neighbours(vectors, F.col("vec_id") % 100 == 0)


def op9_piecewise_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and their likeness."""
    return piecewise_hash.fingerprint_documents(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    return secret_scan.scan_documents(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, each behind the opening turns of its hundred."""
    return prefix_trie.rebuilt_trie(read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that others repeat."""
    return line_dedup.digests(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by rule and repaired."""
    return structure_repair.repair_damaged(read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_cube_mix": op1_cube_mix,
    "op2_quality": op2_quality,
    "op3_chat_windows": op3_chat_windows,
    "op4_token_files": op4_token_files,
    "op5_bpe_automaton": op5_bpe_automaton,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_license_scan": op7_license_scan,
    "op8_nn_descent": op8_nn_descent,
    "op9_piecewise_hash": op9_piecewise_hash,
    "op10_secret_scan": op10_secret_scan,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_line_dedup": op12_line_dedup,
    "op13_structure_repair": op13_structure_repair,
}

__all__ = ["ORACLE", "QUERIES"]
