from trendlens.operators.topk import order_by_count, top_k, top_k_string
from trendlens.operators.words import drop_stop_words, flag_stop_words, tokens, track_filter, word_counts
from trendlens.sources import (
    ENGLISH_STOP_WORDS,
    ENGLISH_STOP_WORDS_LINES,
    fixed_sentences,
    read_posts,
    read_stop_words,
    stop_words_df,
)


def test_bundled_stop_list_shape():
    assert len(ENGLISH_STOP_WORDS_LINES) == 193
    assert len(ENGLISH_STOP_WORDS) == 191
    for w in ("a", "ours", "rt", "-", "&", "u", "y", "don't"):
        assert w in ENGLISH_STOP_WORDS


def test_read_stop_words_cleans_bom_crlf_blanks_duplicates(spark, tmp_path):
    lines = list(ENGLISH_STOP_WORDS_LINES)
    lines[97] = lines[97] + " "          # trailing blank, as on the published line 98
    body = "﻿" + "\r\n".join(lines) + "\r\n"
    path = tmp_path / "stop.txt"
    path.write_text(body, encoding="utf-8")
    got = sorted(r["w"] for r in read_stop_words(spark, str(path)).collect())
    assert got == sorted(ENGLISH_STOP_WORDS)


def _fixed_counts(spark, cycles=1, stop=True):
    words = tokens(fixed_sentences(spark, cycles), "sentence")
    if stop:
        words = drop_stop_words(words)
    return {r["w"]: r["count"] for r in word_counts(words).collect()}


def test_fixed_sentences_word_counts(spark):
    raw = _fixed_counts(spark, stop=False)
    assert sum(raw.values()) == 36 and len(raw) == 28
    assert (raw["the"], raw["to"], raw["and"], raw["be"]) == (5, 3, 2, 2)
    kept = _fixed_counts(spark)
    assert sorted(kept) == sorted("ago apples bought candy cow eat four jumped man many moon person "
                                  "score seven store went years".split())
    assert set(kept.values()) == {1}
    assert set(_fixed_counts(spark, cycles=4).values()) == {4}


def test_top_k_exact_and_string(spark):
    words = drop_stop_words(tokens(fixed_sentences(spark, 2), "sentence"))
    top = top_k(word_counts(words), 5, "count", "w")
    assert [(r["w"], r["count"]) for r in top.collect()] == [
        ("ago", 2), ("apples", 2), ("bought", 2), ("candy", 2), ("cow", 2)]
    s = top_k_string(top, "count", "w").first()["topk"]
    assert s == "ago:2|apples:2|bought:2|candy:2|cow:2|"


def test_order_by_count_fixture(spark):
    rows = [("a", 10), ("b", 30), ("c", 20), ("d", 60), ("e", 80), ("f", 150), ("g", 5)]
    df = spark.createDataFrame(rows, "text string, count bigint")
    assert [r["text"] for r in order_by_count(df).collect()] == list("fedbcag")
    s = top_k_string(top_k(df, 5, "count", "text"), "count", "text").first()["topk"]
    assert s == "f:150|e:80|d:60|b:30|c:20|"


def test_top_k_string_of_nothing_is_empty(spark):
    empty = spark.createDataFrame([], "word string, count bigint")
    assert top_k_string(empty, "count", "word").collect()[0]["topk"] == ""


def test_flag_stop_words(spark):
    df = spark.createDataFrame([("The",), ("apple",)], "w string")
    got = {r["w"]: r["is_stop"] for r in flag_stop_words(df).collect()}
    assert got == {"The": True, "apple": False}


def test_user_stop_list(spark):
    df = spark.createDataFrame([("x",), ("y",), ("z",)], "w string")
    stop = stop_words_df(spark, ["X", "z"])
    assert [r["w"] for r in drop_stop_words(df, "w", stop).collect()] == ["y"]


def test_track_filter(spark, posts_path):
    posts = read_posts(spark, posts_path)
    assert [r["id"] for r in track_filter(posts, ["apple"]).orderBy("id").collect()] == [1]
    assert track_filter(posts, []).count() == 3
    assert [r["id"] for r in track_filter(posts, ["nothing here"]).collect()] == [2]
    assert track_filter(posts, ["here nothing else"]).count() == 0
    assert [r["id"] for r in track_filter(posts, ["#apple"]).collect()] == [1]


def test_taps_keep_rows(spark):
    from trendlens.operators.taps import tap, with_partition

    df = spark.range(10)
    tapped, obs = tap(df, "t")
    assert tapped.count() == 10
    assert obs.get["rows"] == 10
    assert with_partition(df).select("partition").distinct().count() >= 1


def test_stop_list_forms_give_equal_rows(spark):
    words = spark.createDataFrame([("the",), ("x",), (None,), ("The",), ("y ",), ("",)], "w string")
    listed = [" The", "", None, "Y "]
    table = spark.createDataFrame([(w,) for w in listed], "w string")
    for stop in (listed, table):
        assert sorted(str(r["w"]) for r in drop_stop_words(words, "w", stop).collect()) == ["", "None", "x", "y "]
        from trendlens.operators.words import flag_stop_words
        flags = {str(r["w"]): r["is_stop"] for r in flag_stop_words(words, "w", stop).collect()}
        assert flags == {"the": True, "x": False, "None": False, "The": True, "y ": False, "": False}
