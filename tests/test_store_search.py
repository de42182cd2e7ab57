import json

import pytest
from pyspark.sql import functions as F

from trendlens.operators.search import (
    Bool,
    Boosting,
    Fuzzy,
    MatchAll,
    MultiMatch,
    Prefix,
    SearchIndex,
    Term,
    Wildcard,
    ranked,
    search,
    wildcard_to_like,
)
from trendlens.sources import documents_as_posts
from trendlens.operators.store import (
    build_documents,
    count_documents,
    dedupe_requests,
    doc_store,
    document_info,
    hits_json,
    parse_posts,
    parse_search_args,
    sentences,
)
from trendlens.sources import fixed_sentences, read_posts

# FIXTURES.md section 5 (d2 is inserted twice).
DOCS = {
    "d1": "i love my new apple iphone",
    "d2": "apple pie recipe",
    "d3": "the man bought an apple",
    "d4": "this applet is an application",
    "d5": "man on the moon",
    "d6": "aptly named ripple",
    "d7": "samsung iphone rival",
    "d8": "apply the aplpe topic",
}
IDS = {"d1": "1048939208", "d2": "-279539928", "d3": "-1827356601", "d4": "-1217082225",
       "d5": "-1759698773", "d6": "-1426478107", "d7": "-531354955", "d8": "1191042688"}
KEY_OF = {v: k for k, v in IDS.items()}


@pytest.fixture(scope="module")
def store(spark):
    texts = list(DOCS.values()) + [DOCS["d2"]]
    posts = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id bigint, text string") \
        .select("id", F.col("text"), F.struct(F.lit(None).cast("bigint").alias("id"),
                                              F.lit("u").alias("screen_name")).alias("user"))
    return doc_store(posts).cache()


def test_fixed_sentence_ids(spark):
    docs = build_documents(sentences(fixed_sentences(spark).withColumnRenamed("sentence", "text")))
    got = [r["document"]["id"] for r in docs.collect()]
    assert got == ["-534010419", "1402758217", "-916945893", "1664573905", "-776483666"]


def test_store_counts_and_ids(store):
    rows = {KEY_OF[r["id"]]: (r["text"], r["count"], r["index"], r["type"]) for r in store.collect()}
    assert set(rows) == set(DOCS)
    assert rows["d2"] == ("apple pie recipe", 2, "my_index", "my_type")
    assert all(rows[k][1] == 1 for k in rows if k != "d2")


def test_parse_and_document_info(spark, posts_path):
    parsed = parse_posts(read_posts(spark, posts_path))
    assert parsed.columns == ["text", "tweetId", "user"]
    docs = document_info(build_documents(sentences(parsed)))
    assert set(docs.columns) >= {"document", "id", "index", "type"}
    counted = count_documents(docs)
    assert counted.count() == 3


def test_sha2_ids(spark):
    df = spark.createDataFrame([("x",)], "sentence string")
    doc = build_documents(df, id_mode="sha2").first()["document"]
    assert len(doc["id"]) == 64


def test_hits_json(spark):
    df = spark.createDataFrame([("apple pie recipe", 2)], "text string, count bigint")
    assert json.loads(hits_json(df).first()["json"]) == {"text": "apple pie recipe", "count": 2}


def test_request_parsing_keeps_spaces(spark):
    df = spark.createDataFrame([('{"q": "a b"} my_index my_type',), ('{"q": "a b"} my_index my_type',)], "args string")
    parsed = parse_search_args(df)
    row = parsed.first()
    assert (row["query"], row["indices"], row["types"]) == ('{"q": "a b"}', ["my_index"], ["my_type"])
    assert dedupe_requests(parsed).count() == 1


def test_wildcard_translation():
    assert wildcard_to_like("a??l*") == "a__l%"
    assert wildcard_to_like("50%_*") == "50\\%\\_%"


EXPECTED = [
    (Term("man"), {"d3", "d5"}),
    (Term("apple"), {"d1", "d2", "d3"}),
    (MultiMatch("apple", ("text",)), {"d1", "d2", "d3"}),
    (Bool(must=(Term("apple"),), must_not=(Term("iphone"),)), {"d2", "d3"}),
    (Bool(must=(Term("apple"), Term("iphone"))), {"d1"}),
    (Fuzzy("applic", prefix_length=0, boost=1.0), {"d1", "d2", "d3", "d4", "d8"}),
    (MatchAll(), set(DOCS)),
    (Prefix("app", boost=2.0), {"d1", "d2", "d3", "d4", "d8"}),
    (Wildcard("a??l*"), {"d1", "d2", "d3", "d4", "d6", "d8"}),
    (Boosting(Term("apple"), Term("iphone"), 0.2), {"d1", "d2", "d3"}),
]


@pytest.mark.parametrize("lazy", [True, False])
def test_the_ten_searches(spark, store, lazy):
    index = SearchIndex.from_store(store) if lazy else SearchIndex.build(store)
    for q, expected in EXPECTED:
        got = {KEY_OF[r["id"]] for r in search(index, q).collect()}
        assert got == expected, q


def test_scores_and_order(spark, store):
    index = SearchIndex.from_store(store)
    boosted = ranked(search(index, Boosting(Term("apple"), Term("iphone"), 0.2))).collect()
    assert KEY_OF[boosted[-1]["id"]] == "d1"
    plain = {KEY_OF[r["id"]]: r["score"] for r in search(index, Term("apple")).collect()}
    assert boosted[-1]["score"] == pytest.approx(plain["d1"] * 0.2, abs=1e-6)
    # constant-score queries give the boost
    assert {r["score"] for r in search(index, Prefix("app", boost=2.0)).collect()} == {2.0}
    # sqrt(tf) * idf^2 / sqrt(doc_len): "man" in d5 (4 tokens), N = 8, df = 2
    import math
    idf = 1 + math.log(8 / 3)
    man = {KEY_OF[r["id"]]: r["score"] for r in search(index, Term("man")).collect()}
    assert man["d5"] == pytest.approx(round(idf * idf / 2, 6))
    top2 = ranked(search(index, Term("apple")), size=2).collect()
    assert len(top2) == 2


def test_index_restrict(spark, store):
    index = SearchIndex.from_store(store)
    assert search(index, MatchAll(), indices=["other"]).count() == 0
    assert search(index, MatchAll(), indices=["my_index"], types=["my_type"]).count() == 8


def test_index_of_an_empty_store(spark, store, tmp_path):
    empty = SearchIndex.build(store.limit(0), str(tmp_path / "empty"))
    assert search(empty, Term("apple")).count() == 0
    assert search(empty, MatchAll()).count() == 0


def test_many_document_buckets_are_pruned_alike(spark):
    store = doc_store(documents_as_posts(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")))
    one, many = SearchIndex.build(store), SearchIndex.build(store, doc_buckets=8)
    assert many.doc_buckets == 8 and many.docs.select("_b").distinct().count() == 8
    by_bytes = SearchIndex.build(store, bucket_bytes=20_000)
    assert by_bytes.doc_buckets > 8
    for q in (Term("the"), Bool(must=(Term("the"),), should=(Term("under"),)), MatchAll(), Bool(must_not=(Term("the"),))):
        rows = [sorted(search(i, q).collect()) for i in (one, many, by_bytes)]
        assert rows[0] == rows[1] == rows[2] and rows[0]


def test_match_all_reads_the_documents_once(spark):
    from test_plans import executed_plan

    store = doc_store(documents_as_posts(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")))
    assert "Join" not in executed_plan(search(SearchIndex.build(store), MatchAll()))
