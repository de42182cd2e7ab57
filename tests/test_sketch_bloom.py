import math

import pytest
from pyspark.sql import functions as F

from trendlens.operators.bloom import bloom_drop, bloom_size, build_bloom
from trendlens.operators.sketch import (
    CountMinSketch,
    SketchMergeError,
    SketchParams,
    build_sketch,
    lookup_counts,
    merge_sketches,
    sketch_top_k,
)
from trendlens.operators.topk import top_k
from trendlens.operators.words import drop_stop_words, tokens, word_counts
from trendlens.sources import fixed_sentences, stop_words_df


def _doc_words(spark, sf="/root/testdata/sf0.001"):
    return tokens(spark.read.parquet(f"{sf}/documents.parquet").select("text"), "text")


def test_sizing_from_error_targets():
    p = SketchParams.from_error(0.002, 0.999)
    assert (p.width, p.depth) == (1000, 10)
    q = SketchParams(15, 1000)
    assert q.relative_error == pytest.approx(0.002)
    assert q.confidence == pytest.approx(1 - 2 ** -15)


def test_single_cell_sketch_estimates_total(spark):
    words = drop_stop_words(tokens(fixed_sentences(spark), "sentence"))
    sk = build_sketch(words, "w", SketchParams(1, 1))
    assert sk.total().first()["total"] == 17
    est = sk.estimate(words, "w").collect()
    assert {r["estimate"] for r in est} == {17}


def test_estimates_bound_exact_counts(spark):
    words = drop_stop_words(_doc_words(spark))
    params = SketchParams(5, 200)
    sk = build_sketch(words, "w", params)
    exact = word_counts(words, "w", "exact")
    total = sk.total().first()["total"]
    est = sk.estimate(words, "w").join(exact, "w")
    rows = est.select((F.col("estimate") - F.col("exact")).alias("err")).collect()
    assert all(r["err"] >= 0 for r in rows)
    within = sum(r["err"] <= params.relative_error * total for r in rows)
    assert within / len(rows) >= params.confidence - 0.05


def test_build_without_pre_aggregation_is_the_same(spark):
    words = drop_stop_words(_doc_words(spark))
    a = build_sketch(words, "w", SketchParams(4, 50)).cells
    b = build_sketch(words, "w", SketchParams(4, 50), pre_aggregate=False).cells
    assert sorted(a.collect()) == sorted(b.collect())


def test_merge_equals_sketch_of_union(spark):
    words = drop_stop_words(_doc_words(spark))
    left = words.where(F.length("w") % 2 == 0)
    right = words.where(F.length("w") % 2 == 1)
    p = SketchParams(4, 64)
    merged = merge_sketches(build_sketch(left, "w", p), build_sketch(right, "w", p))
    whole = build_sketch(words, "w", p)
    assert sorted(merged.cells.collect()) == sorted(whole.cells.collect())


def test_merge_rules(spark):
    words = tokens(fixed_sentences(spark), "sentence")
    assert merge_sketches() is None
    with pytest.raises(SketchMergeError):
        merge_sketches(build_sketch(words, "w", SketchParams(2, 10)), build_sketch(words, "w", SketchParams(2, 11)))
    with pytest.raises(SketchMergeError):
        merge_sketches(build_sketch(words, "w", SketchParams(2, 10, 1)), build_sketch(words, "w", SketchParams(2, 10, 2)))


def test_negative_weight_is_an_error(spark):
    df = spark.createDataFrame([("a", 1), ("b", -1)], "w string, n bigint")
    with pytest.raises(Exception, match="a count cannot go down"):
        build_sketch(df, "w", SketchParams(2, 10), weight_col="n").cells.collect()


def test_save_and_load(spark, tmp_path):
    words = tokens(fixed_sentences(spark), "sentence")
    sk = build_sketch(words, "w", SketchParams(3, 20, 7))
    sk.save(str(tmp_path / "sk"))
    back = CountMinSketch.load(spark, str(tmp_path / "sk"))
    assert back.params == sk.params
    assert sorted(back.cells.collect()) == sorted(sk.cells.collect())


def test_integer_items(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("k"))
    sk = build_sketch(df, "k", SketchParams(5, 1000))
    got = {r["k"]: r["estimate"] for r in sk.estimate(df, "k").collect()}
    assert got == {k: 10 for k in range(10)}


def test_lookup_request_words(spark):
    words = drop_stop_words(tokens(fixed_sentences(spark), "sentence"))
    sk = build_sketch(words, "w", SketchParams(15, 1000))
    req = spark.range(1).select(F.explode(F.split(F.lit("to the apple cow"), " ")).alias("query"))
    got = {r["query"]: r["count"] for r in lookup_counts(sk, req).collect()}
    assert got == {"to": 0, "the": 0, "apple": 0, "cow": 1}


def test_sketch_top_k_matches_exact_when_wide(spark):
    words = _doc_words(spark)
    top, _ = sketch_top_k(words, 5, "w", SketchParams(15, 100_000))
    exact = top_k(word_counts(drop_stop_words(words), "w", "count"), 5, "count", "w")
    assert [(r["w"], r["estimate"]) for r in top.collect()] == [(r["w"], r["count"]) for r in exact.collect()]


def test_bloom_sizing_and_membership(spark):
    assert bloom_size(500, 0.01) == (4792, 7)
    stop = stop_words_df(spark)
    bloom = build_bloom(stop, "w")
    assert bloom.expected_fpp < 1e-3
    # no false negatives: every stop word is caught
    assert bloom_drop(stop, bloom, "w").count() == 0
    words = _doc_words(spark)
    kept = bloom_drop(words, bloom, "w")
    exact = drop_stop_words(words)
    # the exact anti-join keeps at least what the filter keeps (false positives only remove)
    assert kept.subtract(exact).count() == 0
    assert kept.count() >= exact.count() * (1 - 0.01)
    assert not math.isnan(bloom.expected_fpp)


def test_large_bloom_is_a_table(spark):
    items = spark.range(2_000_000).selectExpr("cast(id as string) AS w")
    bloom = build_bloom(items, "w", capacity=2_000_000, hash_kind="xxhash64")
    assert bloom.num_bits > 19_000_000 and bloom.blocks.count() == -(-bloom.num_bits // 32_768)
    asked = spark.range(0, 4_000_000, 1000).selectExpr("cast(id as string) AS w")
    flagged = bloom.flag(asked, "w").selectExpr("maybe", "cast(w as long) < 2000000 AS member").groupBy("member").agg(
        F.avg(F.col("maybe").cast("int")).alias("rate")).collect()
    rate = {r["member"]: r["rate"] for r in flagged}
    assert rate[True] == 1.0 and rate[False] < 0.03


def test_bloom_keeps_nulls_and_repeats(spark):
    bloom = build_bloom(spark.createDataFrame([("a",)], "w string"), "w")
    df = spark.createDataFrame([("A",), (None,), ("b",), ("b",)], "w string")
    assert sorted(str(r["w"]) for r in bloom_drop(df, bloom, "w").collect()) == ["None", "b", "b"]


def test_words_are_probed_after_they_are_counted(spark):
    bloom = build_bloom(spark.createDataFrame([("a",)], "w string"), "w")
    df = spark.createDataFrame([("A b b",), ("b c",), (None,)], "text string")
    kept = bloom_drop(word_counts(tokens(df, "text"), "w", out="count"), bloom, "w")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate inline") < plan.index("Aggregate [w#")
    assert kept.columns == ["w", "count"]
    assert sorted((r["w"], r["count"]) for r in kept.collect()) == [("b", 3), ("c", 1)]


def test_builtin_alternatives(spark):
    from trendlens.operators.sketch import sketch_blob
    from trendlens.operators.topk import approx_top_k

    words = drop_stop_words(tokens(fixed_sentences(spark, 3), "sentence"))
    top = approx_top_k(words, "w", 3)
    assert top.columns == ["w", "count"] and {r["count"] for r in top.collect()} == {3}
    blob = sketch_blob(words, "w", 0.01, 0.99).first()["sketch"]
    assert isinstance(blob, (bytes, bytearray)) and len(blob) > 0


def test_xxhash_option(spark, tmp_path):
    words = drop_stop_words(_doc_words(spark))
    fast = SketchParams(5, 200, hash="xxhash64")
    sk = build_sketch(words, "w", fast)
    exact = word_counts(words, "w", "exact")
    est = sk.estimate(words, "w").join(exact, "w")
    assert est.where(F.col("estimate") < F.col("exact")).count() == 0
    assert sk.total().first()["total"] == words.count()
    with pytest.raises(SketchMergeError):
        merge_sketches(sk, build_sketch(words, "w", SketchParams(5, 200)))
    sk.save(str(tmp_path / "x"))
    assert CountMinSketch.load(spark, str(tmp_path / "x")).params == fast
    with pytest.raises(ValueError):
        SketchParams(hash="crc")
    bloom = build_bloom(stop_words_df(spark), "w", hash_kind="xxhash64")
    assert bloom_drop(stop_words_df(spark), bloom, "w").count() == 0


def test_sketches_by_part_equal_separate_sketches(spark):
    from trendlens.operators.sketch import build_sketches_by

    words = drop_stop_words(_doc_words(spark)).withColumn("long", F.length("w") > 4)
    p = SketchParams(4, 64)
    parts = build_sketches_by(words, "w", F.col("long"), [True, False], p)
    for flag in (True, False):
        alone = build_sketch(words.where(F.col("long") == flag), "w", p)
        assert sorted(parts[flag].cells.collect()) == sorted(alone.cells.collect())
