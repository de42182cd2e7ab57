"""The physical plans the README promises, checked on the executed plans."""

import contextlib
import io

from pyspark.sql import functions as F

from trendlens.operators.entities import extract_entities
from trendlens.operators.search import SearchIndex, Term, search
from trendlens.operators.sketch import SketchParams, build_sketch, sketch_top_k
from trendlens.operators.store import doc_store
from trendlens.operators.words import drop_stop_words, tokens, word_counts
from trendlens.sources import conversations_as_posts, documents_as_posts

SF = "/root/testdata/sf0.001"


def executed_plan(df) -> str:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    # adaptive plans print the final plan, then the initial one; keep the final
    # (nested subquery plans carry their own, indented, markers)
    return buf.getvalue().split("\n+- == Initial Plan ==")[0]


def _words(spark):
    return tokens(spark.read.parquet(f"{SF}/documents.parquet").select("text"), "text")


def test_bundled_stop_words_are_a_literal_set_not_a_join(spark):
    plan = executed_plan(word_counts(drop_stop_words(_words(spark))))
    assert "INSET" in plan.upper()
    assert "Join" not in plan


def test_sketch_top_k_shares_the_word_shuffle(spark):
    top, _ = sketch_top_k(_words(spark), 5, "w", SketchParams(15, 1000))
    plan = executed_plan(top)
    assert "ReusedExchange" in plan
    # the estimates read the word counts that the sketch was built from; nothing is split twice
    assert plan.count("ReusedExchange [w") == 1
    assert "TakeOrderedAndProject" in plan


def test_sketch_estimate_joins_blocks_of_cells(spark):
    # a small sketch is broadcast in blocks; a large one is joined by block; no row holds all cells
    small = executed_plan(build_sketch(_words(spark), "w", SketchParams(5, 100)).estimate(_words(spark), "w"))
    assert "BroadcastHashJoin" in small and "_slot" in small and "Subquery" not in small
    words = spark.range(50).select(F.col("id").cast("string").alias("w"))
    wide = build_sketch(words, "w", SketchParams(15, 2_000_000)).estimate(words, "w")
    assert "Broadcast" not in wide._jdf.queryExecution().optimizedPlan().toString()
    assert {r["estimate"] for r in wide.collect()} == {1}


def test_term_search_pushes_the_term_into_the_scan(spark):
    store = doc_store(documents_as_posts(spark.read.parquet(f"{SF}/documents.parquet")))
    index = SearchIndex.build(store)
    plan = executed_plan(search(index, Term("the")))
    assert "EqualTo(term,the)" in plan or "In(term, [the])" in plan
    assert "split(" not in plan                 # nothing is re-tokenised at query time
    # the document scan carries a dynamic pruning filter on its bucket; it prunes
    # when the hits side is the broadcast one (documents larger than the hits)
    assert "dynamicpruningexpression(" in plan


def test_entities_need_no_shuffle(spark):
    posts = conversations_as_posts(spark.read.parquet(f"{SF}/conversations.parquet"))
    plan = executed_plan(extract_entities(posts))
    assert "Exchange" not in plan


def test_hot_word_and_hot_text_counts(spark):
    # one word is a third of all tokens; one text is a third of all posts
    n = 3000
    rows = spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot hot topic")).otherwise(F.concat(F.lit("cold "), F.col("id").cast("string"))).alias("text"))
    counts = {r["w"]: r["count"] for r in word_counts(tokens(rows, "text")).where(F.col("w").isin("hot", "topic")).collect()}
    assert counts == {"hot": 2 * (n // 3), "topic": n // 3}
    posts = rows.select("id", "text", F.struct(F.lit(None).cast("bigint").alias("id"),
                                               F.lit("u").alias("screen_name")).alias("user"))
    store = doc_store(posts)
    hot = store.where(F.col("text") == "hot hot topic").first()
    assert hot["count"] == n // 3
    assert store.count() == 1 + n - n // 3
