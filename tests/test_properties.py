"""Property tests on random inputs."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trendlens.functions import java_string_hash
from trendlens.operators.search import wildcard_to_like
from trendlens.operators.sketch import SketchParams, build_sketch, merge_sketches

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

bmp_text = st.text(alphabet=st.characters(max_codepoint=0xFFFF, blacklist_categories=("Cs",)), max_size=40)


def java_hash(s: str) -> int:
    h = 0
    for i in range(0, len(s.encode("utf-16-be")), 2):
        unit = int.from_bytes(s.encode("utf-16-be")[i:i + 2], "big")
        h = (h * 31 + unit) & 0xFFFFFFFF
    return h - (1 << 32) if h >= (1 << 31) else h


@SETTINGS
@given(st.lists(bmp_text, min_size=1, max_size=8))
def test_java_hash_matches_definition(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r["h"] for r in df.select(java_string_hash("s").alias("h")).collect()]
    assert got == [java_hash(t) for t in texts]


def glob_matches(pattern: str, word: str) -> bool:
    rx = "".join("." if c == "?" else ".*" if c == "*" else re.escape(c) for c in pattern)
    return re.fullmatch(rx, word, flags=re.S) is not None


@SETTINGS
@given(st.text(alphabet="ab?*%_\\", max_size=6), st.lists(st.text(alphabet="ab%_\\", max_size=6), max_size=8))
def test_wildcard_like_translation(spark, pattern, words):
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = sorted(r["w"] for r in df.where(F.col("w").like(wildcard_to_like(pattern))).collect())
    assert got == sorted(w for w in words if glob_matches(pattern, w))


@SETTINGS
@given(st.lists(st.sampled_from([f"w{i}" for i in range(40)]), min_size=1, max_size=200),
       st.lists(st.sampled_from([f"w{i}" for i in range(40)]), max_size=200))
def test_sketch_bounds_and_merge(spark, left, right):
    p = SketchParams(4, 16)
    a = spark.createDataFrame([(w,) for w in left], "w string")
    b = spark.createDataFrame([(w,) for w in right], "w string") if right else a.limit(0)
    whole = a.unionByName(b)
    merged = merge_sketches(build_sketch(a, "w", p), build_sketch(b, "w", p))
    direct = build_sketch(whole, "w", p)
    assert sorted(merged.cells.collect()) == sorted(direct.cells.collect())
    exact = {}
    for w in left + right:
        exact[w] = exact.get(w, 0) + 1
    est = {r["w"]: r["estimate"] for r in direct.estimate(whole, "w").collect()}
    assert all(est[w] >= n for w, n in exact.items())
    assert direct.total().first()["total"] == len(left) + len(right)
