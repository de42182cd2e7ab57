import hashlib

from pyspark.sql import functions as F

from trendlens.functions import analyze, base_hashes, content_id, java_string_hash, split_keep_empty, words


def java_hash(s: str) -> int:
    h = 0
    for unit in s.encode("utf-16-be").hex(" ", 2).split():
        h = (h * 31 + int(unit, 16)) & 0xFFFFFFFF
    return h - (1 << 32) if h >= (1 << 31) else h


def test_split_keep_empty(spark):
    df = spark.createDataFrame([("a,,b,",), ("a.b",)], "s string")
    got = df.select(split_keep_empty("s", ",").alias("x"), split_keep_empty("s", ".").alias("y")).collect()
    assert got[0]["x"] == ["a", "", "b", ""]
    assert got[1]["y"] == ["a", "b"]


def test_words_drop_empty_and_keep_punctuation(spark):
    df = spark.createDataFrame([("a  b",), ("@laclippers love, it\tnow",)], "s string")
    got = [r["w"] for r in df.select(words("s").alias("w")).collect()]
    assert got[0] == ["a", "b"]
    assert got[1] == ["@laclippers", "love,", "it\tnow"]


def test_analyzer(spark):
    df = spark.createDataFrame([("Hello, World! été 42x -- #tag",)], "s string")
    assert df.select(analyze("s").alias("t")).first()["t"] == ["hello", "world", "été", "42x", "tag"]


def test_java_string_hash_matches_definition(spark):
    texts = ["the cow jumped over the moon", "", "i love my new apple iphone", "é€ unicode ß"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r["h"] for r in df.select(java_string_hash("s").alias("h")).collect()]
    assert got == [java_hash(t) for t in texts]
    assert got[0] == -534010419


def test_content_id_is_md5_of_utf16le(spark):
    df = spark.createDataFrame([("url", "http://x/a"), ("source", None)], "t string, n string")
    got = [r["c"] for r in df.select(content_id("t", "n").alias("c")).collect()]
    assert got[0] == hashlib.md5("urlhttp://x/a".encode("utf-16-le")).hexdigest()
    assert got[1] == hashlib.md5("sourcenull".encode("utf-16-le")).hexdigest()


def test_base_hashes_are_md5_words(spark):
    df = spark.createDataFrame([("apple",)], "w string")
    h1, h2 = base_hashes(F.col("w"))
    row = df.select(h1.alias("a"), h2.alias("b")).first()
    digest = hashlib.md5(b"apple").hexdigest()
    assert row["a"] == int(digest[:8], 16)
    assert row["b"] == int(digest[8:16], 16)
