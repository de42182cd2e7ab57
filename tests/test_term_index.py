"""The written term index: ranged postings, dictionary, gram and deletion indexes, one-pass trees, block maxima."""

import random
import re

import pytest
from pyspark.sql import functions as F
from test_plans import executed_plan

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
    search_requests,
)
from trendlens.operators.store import doc_store
from trendlens.operators.term_index import RANGE, deletions, pattern_grams
from trendlens.sources import documents_as_posts

SF = "/root/testdata/sf0.001"

QUERIES = [
    Term("the"), Term("absent"), MultiMatch("the Trash of"), Bool(must=(Term("the"), Term("of"))),
    Bool(must=(Term("the"),), should=(Term("of"), Prefix("th"))), Bool(should=(Term("trash"), Term("under")), must_not=(Term("the"),)),
    Bool(must_not=(Term("the"),)), Fuzzy("thes"), Fuzzy("thrund"), Prefix("thr", boost=2.0), Wildcard("t??e*"), Wildcard("*x?y"),
    Wildcard("*"), Boosting(Term("the"), Term("of"), 0.2), MatchAll(),
    Bool(must=(Bool(should=(Term("the"), Fuzzy("of"))), Wildcard("*a*")), must_not=(Boosting(Term("trash"), Term("is"), 0.5),)),
]


@pytest.fixture(scope="module")
def store(spark):
    return doc_store(documents_as_posts(spark.read.parquet(f"{SF}/documents.parquet"))).cache()


@pytest.fixture(scope="module")
def index(store):
    return SearchIndex.build(store, ranges=9)


def rows(hits):
    return sorted((r["id"], r["count"], r["score"]) for r in hits.collect())


@pytest.mark.parametrize("query", QUERIES, ids=str)
def test_the_dictionary_finds_what_a_scan_of_all_postings_finds(index, store, query):
    assert rows(search(index, query)) == rows(search(SearchIndex.from_store(store), query))


def test_a_common_term_spans_ranges_and_df_is_looked_up(index):
    terms = {r["term"]: r for r in index.terms.terms.where(F.col("term").isin("the", "of", "trash")).collect()}
    held = {r["term"]: (r["n"], r["low"], r["high"]) for r in index.postings.groupBy("term").agg(
        F.count("*").alias("n"), F.min(RANGE).alias("low"), F.max(RANGE).alias("high")).collect()}
    for t, r in terms.items():
        assert (r["df"], r["first"], r["last"]) == held[t]
        assert [b[RANGE] for b in r["blocks"]] == list(range(r["first"], r["last"] + 1))
        assert sum(b["n"] for b in r["blocks"]) == r["df"]


def test_a_hot_term_is_cut_over_ranges(spark):
    # one word in every document, a third of all postings
    texts = [(i, f"hot w{i} v{i}") for i in range(600)]
    posts = spark.createDataFrame(texts, "id long, text string").select(
        "id", "text", F.struct(F.lit(None).cast("long").alias("id"), F.lit("u").alias("screen_name")).alias("user"))
    index = SearchIndex.build(doc_store(posts), ranges=12)
    hot = index.terms.terms.where("term = 'hot'").first()
    assert hot["last"] - hot["first"] >= 2 and hot["df"] == 600
    assert search(index, Term("hot")).count() == 600


def test_a_term_reads_its_ranges_only(index):
    plan = executed_plan(search(index, Term("trash")))
    found = re.search(r"PartitionFilters: \[isnotnull\(_r#\d+\), \(?_r#\d+ (=|IN)", plan) or re.search(
        r"PartitionFilters: \[[^\]]*_r#\d+ (=|IN|INSET)", plan)
    assert found and "df" not in plan.split("Scan parquet")[0].replace("df#", "")   # nothing counts documents per term


@pytest.mark.parametrize("query", [
    Bool(must=(Term("the"),), should=(Term("of"), Prefix("thr"))), Bool(should=(Term("the"), Term("trash")), must_not=(Term("of"),)),
    Boosting(Term("trash"), Term("the"), 0.2)], ids=str)
def test_a_tree_reads_the_postings_once(index, query):
    plan = executed_plan(search(index, query))
    # one scan of the postings and one of the documents
    assert plan.count("FileScan parquet") == 2


def test_fuzzy_measures_candidates_of_the_deletion_index(index):
    words = [r["term"] for r in index.terms.terms.select("term").distinct().collect()]
    rng = random.Random(3)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            above, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                above, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, above + (x != y))
        return row[-1]

    asked = [*rng.sample(words, 4), "", "a", "thrundish", "étre"]
    asked += [w[:1] + "q" + w[2:] for w in asked if len(w) > 3]
    for word in asked:
        for edits in (0, 1, 2):
            got = {r["term"] for r in index.terms.near("text", word, edits).select("term").collect()}
            assert got == {w for w in words if abs(len(w) - len(word)) <= edits and distance(w, word) <= edits}, (word, edits)
    # three edits: the dictionary is compared whole
    assert {r["term"] for r in index.terms.near("text", "thrund", 3).select("term").collect()} == {
        w for w in words if distance(w, "thrund") <= 3}


def test_deletions_meet_for_any_two_words_within_the_edits():
    rng = random.Random(5)
    for _ in range(300):
        word = "".join(rng.choice("ab") for _ in range(rng.randrange(12)))
        other = list(word)
        for _ in range(2):
            at = rng.randrange(len(other) + 1)
            kind = rng.choice("ids")
            if kind == "i":
                other.insert(at, rng.choice("abc"))
            elif other and at < len(other):
                other[at:at + 1] = [] if kind == "d" else [rng.choice("abc")]
        assert set(deletions(word)) & set(deletions("".join(other)))


def test_pattern_grams():
    assert pattern_grams("*x?y") == ["y\x03"]
    assert pattern_grams("trash") == sorted(["\x02t", "tr", "ra", "as", "sh", "h\x03"])
    assert pattern_grams("*") == pattern_grams("??") == []


def test_wildcards_read_terms_that_hold_the_grams(index):
    words = [r["term"] for r in index.terms.terms.select("term").distinct().collect()]
    for pattern in ("t??e*", "*x?y", "*ing", "a*", "?", "*e*e*e*", "é*", "the", "th_*", ""):
        rule = re.compile("".join({"?": ".", "*": ".*"}.get(c, re.escape(c)) for c in pattern), re.S)
        got = [r["term"] for r in index.terms.like("text", pattern, search_like(pattern)).select("term").collect()]
        assert sorted(got) == sorted(w for w in words if rule.fullmatch(w)), pattern


def search_like(pattern):
    from trendlens.operators.search import wildcard_to_like
    return wildcard_to_like(pattern)


@pytest.mark.parametrize("query", [
    Term("the", boost=3.0), Term("absent"), MultiMatch("the trash of under"), Fuzzy("thes"),
    Bool(should=(Term("the"), Term("of"))), Bool(must=(Term("the"),), must_not=(Term("of"),)), MatchAll()], ids=str)
@pytest.mark.parametrize("size", [10])
def test_the_best_hits_are_the_first_of_all(index, query, size):
    got = [(r["id"], r["score"]) for r in search(index, query, size=size).collect()]
    assert got == [(r["id"], r["score"]) for r in ranked(search(index, query), size).collect()]


def test_block_maxima_skip_ranges(spark):
    texts = [(i, "the of " + " ".join(f"f{i}x{j}" for j in range(i % 40))) for i in range(1500)]
    posts = spark.createDataFrame(texts, "id long, text string").select(
        "id", "text", F.struct(F.lit(None).cast("long").alias("id"), F.lit("u").alias("screen_name")).alias("user"))
    index = SearchIndex.build(doc_store(posts), ranges=200)
    for query in (Term("the"), MultiMatch("the of")):
        blocks = index.top_blocks(query, 5)
        read, held = sum(b["n"] for b in blocks if b["kept"]), sum(b["n"] for b in blocks)
        assert 5 <= read < held / 2, (query, read, held)
        got = [(r["id"], r["score"]) for r in search(index, query, size=5).collect()]
        assert got == [(r["id"], r["score"]) for r in ranked(search(index, query), 5).collect()]


def test_restricted_indices_have_their_own_counts(spark, store):
    two = store.unionByName(store.where(F.length("text") < 400).withColumn("index", F.lit("other")))
    index, lazy = SearchIndex.build(two, ranges=5), SearchIndex.from_store(two)
    for q in (Term("the"), MultiMatch("the trash"), Fuzzy("thes")):
        for indices in (None, ["other"], ["my_index"], ["none"]):
            a, b = (sorted((r["index"], r["id"], r["score"]) for r in search(i, q, indices).collect()) for i in (index, lazy))
            assert a == b
            best = search(index, q, indices, size=3).select("score").collect()
            assert best == ranked(search(lazy, q, indices), 3).select("score").collect()


def test_requests_are_answered_like_searches(spark, store, index):
    asked = [(1, "match", "the trash under of"), (2, "term", "the"), (3, "match", "the trash under of"), (4, "match", ""),
             (5, "match", "Nothing, here?"), (6, "term", "The")]
    requests = spark.createDataFrame([(i, k, v, "my_index", "my_type") for i, k, v in asked],
                                     "request_id long, kind string, value string, index string, type string")
    for source in (index, SearchIndex.from_store(store)):
        got = search_requests(source, requests).collect()
        for i, kind, value in asked:
            one = MultiMatch(value) if kind == "match" else Term(value)
            want = [] if i == 3 else sorted((r["id"], r["score"]) for r in search(index, one).collect())
            assert sorted((r["id"], r["score"]) for r in got if r["request_id"] == i) == want
        best = search_requests(source, requests, size=3).where("request_id = 2")
        assert sorted((r["id"], r["score"]) for r in best.collect()) == sorted(
            (r["id"], r["score"]) for r in search(index, Term("the"), size=3).collect())


def test_requests_in_many_blocks_make_one_row_a_hit(spark, store, index, monkeypatch):
    from trendlens.operators import search as module

    rng, words = random.Random(3), ["the", "trash", "under", "of", "is", "absent", "ties", "to"]
    # ids repeat and may be null; their requests' scores add up
    asked = [(None if i == 7 else i // 2, "match", " ".join(rng.sample(words, 5)), "my_index", "my_type") for i in range(10)]
    requests = spark.createDataFrame(asked, "request_id long, kind string, value string, index string, type string")
    first: dict[str, int | None] = {}
    for i, _, value, *_ in asked:
        first[value] = i if first.get(value) is None else first[value] if i is None else min(first[value], i)
    want: dict[tuple, float] = {}
    for value, i in first.items():
        for hit in search(SearchIndex.from_store(store), MultiMatch(value)).collect():
            want[i, hit["id"]] = want.get((i, hit["id"]), 0.0) + hit["score"]
    for limits in ((256, 1 << 15, 1 << 21), (3, 5, 2)):
        for name, value in zip(("REQUEST_BLOCK", "ANSWERED_ROWS", "PRODUCTS"), limits, strict=True):
            monkeypatch.setattr(module, name, value)
        found = search_requests(index, requests)
        got = {(r["request_id"], r["id"]): r["score"] for r in found.collect()}
        assert found.count() == len(got) and got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-5 for k in want)
    # a (request, document) pair is made as a hit, not for each token the two share
    plan = found._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "sum(" not in plan


def test_many_resolved_terms_become_a_table(index, monkeypatch):
    from trendlens.operators import search as module

    want = rows(search(index, Prefix("t")))
    monkeypatch.setattr(module, "MOST_VALUES", 3)
    assert rows(search(index, Prefix("t"))) == want and want


def test_empty_texts_and_an_empty_index(spark, store):
    empty = SearchIndex.build(store.limit(0))
    for q in (Term("the"), Fuzzy("the"), Wildcard("t*"), Prefix("t"), MatchAll(), MultiMatch("")):
        assert search(empty, q).collect() == [] and search(empty, q, size=3).collect() == []
    bare = store.limit(1).withColumn("text", F.lit("")).unionByName(store.limit(1).withColumn("id", F.lit("x")))
    assert search(SearchIndex.build(bare), MatchAll()).count() == 2


def test_written_rows_hold_many_postings_and_the_same_ones(spark):
    from trendlens.operators.term_index import CHUNK, read_rows

    # keys repeat, with one length and with two; parts of keys and texts are null; one document is longer than a stretch
    texts = [("a", "t", f"{i % 90}", f"The of, w{i} x{i % 7} the {'y ' * (i % 3)}") for i in range(300)]
    texts += [("a", "t", "1", "the the of"), ("a", "t", "1", "the of of"), ("a", "t", "1", "the"), (None, "t", None, "the é ß日本語漢字")]
    texts += [("b", None, "1", None), ("b", "t", "2", ""), ("b", None, "3", "the long" + " of longer" * 3000)]
    store = spark.createDataFrame(texts, "index string, type string, id string, text string").withColumn(
        "count", F.lit(1).cast("bigint")).withColumn("url", F.concat_ws(" ", F.lit("w1 the"), "id", F.substring("text", 1, 9)))
    store = store.repartition(3)

    def found(df):
        return sorted(map(str, df.select("index", "type", "id", "field", "doc_len", "term", "tf").collect()))

    once = store.groupBy("index", "type", "id").agg(*[F.max(c).alias(c) for c in ("text", "count", "url")])
    for docs in (store, once):
        built = SearchIndex.build(docs, ranges=4, chunk=CHUNK, fields=("text", "url"))
        want = found(SearchIndex.postings_of(docs, ("text", "url")))
        assert found(built.postings) == want
        path = built.postings.inputFiles()[0].split("/_r=")[0]
        rows_of = read_rows(spark, path).select(F.size("ids").alias("n"), "weight", F.array_max(F.transform(
            F.arrays_zip("lens", "tfs"), lambda p: F.sqrt(p["tfs"]) / F.sqrt(p["lens"]))).alias("most")).collect()
        assert sum(r["n"] for r in rows_of) == len(want) and len(rows_of) < len(want) * 0.8
        assert max(r["n"] for r in rows_of) <= CHUNK and all(r["weight"] == r["most"] for r in rows_of)


def test_grams_are_those_of_the_marked_term(spark):
    from trendlens.operators.term_index import grams_of

    words = ["", "a", "aaaa", "trash", "日本語", "é"]
    got = grams_of(spark.createDataFrame([("text", w) for w in words], "field string, term string")).collect()
    want = {(f"\x02{w}\x03"[i:i + 2], w) for w in words for i in range(len(w) + 1)}
    assert sorted((r["gram"], r["term"]) for r in got) == sorted(want)
    by_number = [r["gram"] for r in sorted(got, key=lambda r: r["_p"])]
    assert [g.encode() for g in by_number] == sorted(g.encode() for g in by_number)
