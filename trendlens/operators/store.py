"""Counted store of distinct texts.

Posts are parsed, lower-cased into sentences, wrapped as documents keyed by
``(index, type, id)`` with ``id`` the 32-bit string hash of the sentence, and
counted per key: the first (smallest) text is kept, the count is the number
of posts.  Both aggregates combine map-side, so a text repeated in a third of
all posts is reduced inside every task before the one shuffle on the key.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.functions.hashing import java_string_hash_text
from trendlens.functions.text import to_json_row

# Default index and type names of stored documents.
DEFAULT_INDEX = "my_index"
DEFAULT_TYPE = "my_type"

STORE_KEYS = ["index", "type", "id"]


def parse_posts(posts: DataFrame) -> DataFrame:
    """Post -> ``(text, tweetId, user)`` with the author's screen name."""
    return posts.select("text", F.col("id").alias("tweetId"), F.col("user.screen_name").alias("user"))


def sentences(df: DataFrame, text_col: str = "text", out: str = "sentence") -> DataFrame:
    """The lower-cased text; other fields are dropped."""
    return df.select(F.lower(F.col(text_col)).alias(out))


def doc_id(text_col: str = "sentence", id_mode: str = "java") -> F.Column:
    """P4 id: ``java`` = decimal 32-bit string hash (parity, collisions merge texts, X5);
    ``sha2`` = SHA-256 hex (collision-free option)."""
    if id_mode == "java":
        return java_string_hash_text(F.col(text_col))
    if id_mode == "sha2":
        return F.sha2(F.col(text_col), 256)
    raise ValueError(f"unknown id_mode {id_mode!r}")


def build_documents(df: DataFrame, sentence_col: str = "sentence", index: str = DEFAULT_INDEX,
                    doc_type: str = DEFAULT_TYPE, id_mode: str = "java") -> DataFrame:
    """P4 + P9: append a ``document`` struct ``(index, type, text, id)``; earlier columns stay."""
    document = F.struct(F.lit(index).alias("index"), F.lit(doc_type).alias("type"),
                        F.col(sentence_col).alias("text"), doc_id(sentence_col, id_mode).alias("id"))
    return df.select("*", document.alias("document"))


def document_info(df: DataFrame, document_col: str = "document") -> DataFrame:
    """P5 + P9: append ``id, index, type`` read out of the document struct."""
    d = F.col(document_col)
    return df.select("*", d["id"].alias("id"), d["index"].alias("index"), d["type"].alias("type"))


def drop_nulls(df: DataFrame, *cols: str) -> DataFrame:
    """Keep rows where every named column is non-null."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def count_documents(docs: DataFrame, document_col: str = "document") -> DataFrame:
    """A1 + A2: one row per ``(index, type, id)`` with the kept text and the post count.

    ``min(text)`` rather than "first seen" so that two texts sharing a hash id
    resolve the same way on every run.
    """
    d = F.col(document_col)
    return (docs.select(d["index"].alias("index"), d["type"].alias("type"), d["id"].alias("id"),
                        d["text"].alias("text"))
                .groupBy(*STORE_KEYS)
                .agg(F.min("text").alias("text"), F.count(F.lit(1)).alias("count")))


def doc_store(posts: DataFrame, index: str = DEFAULT_INDEX, doc_type: str = DEFAULT_TYPE,
              id_mode: str = "java") -> DataFrame:
    """Posts -> counted store ``(index, type, id, text, count)``."""
    parsed = drop_nulls(parse_posts(posts), "text")
    if not posts.isStreaming:
        # count equal texts first: a hash aggregate that combines map-side, so
        # ids are hashed and texts compared once per distinct text; a stream
        # keeps one aggregate, the only stateful step an update query may have
        counted = sentences(parsed).groupBy("sentence").agg(F.count(F.lit(1)).alias("_n"))
        d = F.col("document")
        return (build_documents(counted, "sentence", index, doc_type, id_mode)
                .select(d["index"].alias("index"), d["type"].alias("type"), d["id"].alias("id"),
                        d["text"].alias("text"), "_n")
                .groupBy(*STORE_KEYS).agg(F.min("text").alias("text"), F.sum("_n").alias("count")))
    return count_documents(build_documents(sentences(parsed), "sentence", index, doc_type, id_mode))


def hits_json(df: DataFrame, out: str = "json") -> DataFrame:
    """Q-OUT / F4: append ``{"text": ..., "count": ...}`` as a JSON string."""
    return df.withColumn(out, to_json_row("text", "count"))


def write_store(store: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``overwrite`` drops and recreates the stored index; ``append`` keeps it and adds rows of new keys only.

    Appending to a folder that does not exist yet writes the whole store.
    """
    if mode == "append":
        try:
            held = store.sparkSession.read.schema(store.schema).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
        else:
            store = store.join(held.select(*STORE_KEYS), STORE_KEYS, "left_anti")
    store.write.mode(mode).parquet(path)


def update_store(store: DataFrame, changed: DataFrame) -> DataFrame:
    """S7 keep-and-update: ``store`` with the counts of ``changed`` added, one row per key.

    Where both hold a key, the counts are summed and the smaller text stays,
    as if all posts had been counted at once.
    """
    return store.select(*STORE_KEYS, "text", "count").unionByName(changed.select(*STORE_KEYS, "text", "count")) \
        .groupBy(*STORE_KEYS).agg(F.min("text").alias("text"), F.sum("count").alias("count"))


def parse_search_args(df: DataFrame, col: str = "args", keep: list[str] | None = None) -> DataFrame:
    """``"<query> <index> <type>"`` -> ``query, indices[1], types[1]`` (and the columns ``keep``).

    Index and type are the last two space-free words, so a query holding
    spaces survives (quirk X6).
    """
    pattern = r"(?s)^(.*) (\S+) (\S+)$"
    return df.select(
        *(keep or []),
        F.regexp_extract(F.col(col), pattern, 1).alias("query"),
        F.array(F.regexp_extract(F.col(col), pattern, 2)).alias("indices"),
        F.array(F.regexp_extract(F.col(col), pattern, 3)).alias("types"))


def dedupe_requests(requests: DataFrame) -> DataFrame:
    """A3: identical requests collapse to one."""
    return requests.dropDuplicates(["query", "indices", "types"])
