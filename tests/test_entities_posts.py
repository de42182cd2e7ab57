import hashlib

from pyspark.sql import functions as F

from trendlens.operators.entities import extract_entities
from trendlens.sources import (
    POST_SCHEMA,
    conversations_as_posts,
    documents_as_posts,
    pages_as_posts,
    parse_raw_posts,
    read_posts,
)


def test_entities_of_fixture_posts(spark, posts_path):
    ents = extract_entities(read_posts(spark, posts_path))
    rows = ents.collect()
    by_post = {}
    for r in rows:
        by_post.setdefault(r["tweet_id"], set()).add((r["content_type"], r["content_name"]))
    assert by_post[1] == {
        ("account_mentioned", "11"), ("account_mentioned", "12"), ("account_retweeted", "91"),
        ("status_retweeted", "90"), ("reply_to_account", "81"), ("reply_to_status", "80"),
        ("url", "http://x/a"), ("url", "http://t/2"), ("hashtag", "apple"), ("source", "web"),
        ("place_country-code", "US"), ("place_fullname", "Raleigh, NC"),
    }
    assert sum(1 for r in rows if r["tweet_id"] == 1) == 12
    assert 2 not in by_post
    assert by_post[3] == {("source", "web")}
    for r in rows:
        want = hashlib.md5((r["content_type"] + r["content_name"]).encode("utf-16-le")).hexdigest()
        assert r["content_id"] == want
    one = [r for r in rows if r["tweet_id"] == 1][0]
    assert one["user_id"] == 7 and one["created_at"] is not None


def test_parse_raw_posts_splits_bad_lines(spark, raw_posts_path):
    raw = spark.read.text(raw_posts_path)
    posts, bad = parse_raw_posts(raw)
    assert sorted(r["id"] for r in posts.collect()) == [1, 2, 3]
    assert [r["_corrupt"] for r in bad.collect()] == ["{bad"]
    assert posts.schema == POST_SCHEMA


def test_adapters_have_post_schema(spark):
    sf = "/root/testdata/sf0.001"
    docs = documents_as_posts(spark.read.parquet(f"{sf}/documents.parquet"))
    conv = conversations_as_posts(spark.read.parquet(f"{sf}/conversations.parquet"))
    pages = pages_as_posts(spark.read.parquet(f"{sf}/pages.parquet"))
    for df in (docs, conv, pages):
        assert [f.name for f in df.schema.fields] == [f.name for f in POST_SCHEMA.fields]
    replies = extract_entities(conv).where(F.col("content_type") == "reply_to_status")
    expected = spark.read.parquet(f"{sf}/conversations.parquet").where(
        (F.col("turn") > 0) & (F.col("conv_id") * 1000 + F.col("turn") - 1 > 0)).count()
    assert replies.count() == expected
    assert extract_entities(pages).where(F.col("content_type") == "url").count() > 0


def test_posts_from_kafka_shaped_rows(spark, raw_posts_path):
    from trendlens.sources import posts_from_kafka

    lines = [r["value"] for r in spark.read.text(raw_posts_path).collect()]
    records = spark.createDataFrame([(None, bytearray(v.encode())) for v in lines], "key binary, value binary")
    posts, bad = posts_from_kafka(records)
    assert sorted(r["id"] for r in posts.collect()) == [1, 2, 3]
    assert bad.count() == 1
