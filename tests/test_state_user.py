"""State asked through the state store, state of our own, user functions, and the store's append."""

from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlens.functions.user import SplitWords, reduce_groups, row_function
from trendlens.operators.sketch import SketchParams, build_sketch, sketch_top_k
from trendlens.operators.store import doc_store, update_store, write_store
from trendlens.operators import words as words_module
from trendlens.operators.words import drop_stop_words, tokens, word_counts
from trendlens.plans import queries
from trendlens.sources import documents_as_posts, read_posts_stream
from trendlens.streaming import (
    Snapshots,
    land_posts,
    own_sketch_top_k,
    poll,
    running_counts_state,
    running_doc_counts,
    running_own_sketch,
)
from trendlens.streaming import state as state_module

SF = "/root/testdata/sf0.001"


def _posts(spark):
    return documents_as_posts(spark.read.parquet(f"{SF}/documents.parquet"))


def test_a_running_count_is_asked_through_the_state_store(spark, tmp_path):
    landing, ckpt = str(tmp_path / "landing"), str(tmp_path / "ckpt")
    land_posts(_posts(spark), landing, 4)
    assert running_counts_state(spark, ckpt) is None
    query = running_doc_counts(read_posts_stream(spark, landing, 1), Snapshots(str(tmp_path / "s")), ckpt, state_partitions=3)
    asked = [(b, a.agg(F.sum("count")).first()[0] if a is not None else 0)
             for b, a in poll(query, lambda: running_counts_state(spark, ckpt), 0.05)]
    assert [b for b, _ in asked] == sorted({b for b, _ in asked})
    assert [n for _, n in asked] == sorted(n for _, n in asked)
    want = sorted(doc_store(_posts(spark)).select("index", "type", "id", "text", "count").collect())
    assert sorted(running_counts_state(spark, ckpt).collect()) == want


def test_a_state_of_our_own_survives_a_restart(spark, tmp_path):
    posts, params = _posts(spark), SketchParams(5, 500)
    landing, ckpt = str(tmp_path / "landing"), str(tmp_path / "ckpt")
    snaps = Snapshots(str(tmp_path / "s"))
    land_posts(posts.where("id % 2 = 0"), landing, 2)
    run = lambda: running_own_sketch(
        read_posts_stream(spark, landing, 1), snaps, ckpt, params, parts=3, state_partitions=2).awaitTermination()
    run()
    posts.where("id % 2 = 1").repartition(2).write.mode("append").json(landing)
    run()
    state = snaps.read_keyed(spark, "sketch", ["part"])
    assert state.count() == 3 and state.agg(F.max(F.size("words"))).first()[0] <= 64
    want, _ = sketch_top_k(tokens(posts, "text"), 5, "w", params)
    assert own_sketch_top_k(state, 5, params).collect() == want.collect()


def test_a_tasks_equal_words_are_counted_before_they_travel(spark):
    texts = [("A  b a " * 500,), ("",), (None,), ("  ",), (" ".join(f"w{i}" for i in range(100)),), ("À b",)]
    df = spark.createDataFrame(texts, "text string").repartition(2)
    got = tokens(df, "text", out="word", count="n").collect()
    want = {r["w"]: r["count"] for r in word_counts(tokens(df, "text")).collect()}
    assert len(got) <= 2 * len(want) and want["a"] == 1000
    assert sum((Counter({r["word"]: r["n"]}) for r in got), Counter()) == want


def test_counted_words_stay_whole_in_bounded_memory(monkeypatch):
    rows = [["a", "b", "a"], [], ["c" * 30, "b"], ["a"]] * 10
    batches = [pa.record_batch([pa.array([r], pa.list_(pa.string()))], ["w"]) for r in rows]
    for limits in ((16 << 20, 32 << 20), (40, 10_000), (40, 1)):
        monkeypatch.setattr(words_module, "COUNT_BYTES", limits[0])
        monkeypatch.setattr(words_module, "HELD_BYTES", limits[1])
        got = [r for b in words_module._count_runs(iter(batches)) for r in b.to_pylist()]
        assert (len(got) > 3) == (limits[1] == 1)
        total = Counter()
        for r in got:
            total[r["w"]] += r["n"]
        assert total == {"a": 30, "b": 20, "c" * 30: 10}
    assert list(words_module._count_runs(iter([]))) == []


def test_words_travel_packed_to_a_state_of_our_own():
    words = [f"w{i:04}" for i in range(1000)] + ["x" * 9000, "y", "z" * 9000]
    batch = pa.record_batch([[i % 3 for i in range(1003)], words, range(1, 1004)], ["part", "w", "n"])
    [packed] = state_module._pack(iter([batch.slice(0, 0), batch]))
    rows = packed.to_pylist()
    assert len(rows) < 20 and max(len(r["words"]) for r in rows) <= state_module.ROW_WORDS
    assert max(sum(map(len, r["words"])) for r in rows) <= state_module.ROW_BYTES + 9000
    got = sorted((r["part"], w, n) for r in rows for w, n in zip(r["words"], r["counts"], strict=True))
    assert got == sorted(zip(*(c.to_pylist() for c in batch.columns), strict=True))


def test_a_state_of_our_own_holds_every_word(spark, tmp_path):
    # words that repeat in a text and over texts, more of them than a packed row and a step of the updater take
    df = spark.range(400).select("id", F.concat_ws(" ", F.lit("often Often the"), F.transform(
        F.sequence(F.col("id") * 100, F.col("id") * 100 + 149), lambda i: F.concat(F.lit("w"), i))).alias("text"))
    posts = df.unionByName(spark.createDataFrame([(900, None), (901, ""), (902, "x" * 20_000)], "id long, text string"))
    landing, params = str(tmp_path / "landing"), SketchParams(4, 700)
    land_posts(posts, landing, 4)
    snaps = Snapshots(str(tmp_path / "s"))
    query = running_own_sketch(read_posts_stream(spark, landing, 2), snaps, str(tmp_path / "ckpt"), params, parts=2,
                               state_partitions=2)
    query.awaitTermination()
    state = snaps.read_keyed(spark, "sketch", ["part"])
    cells = state.select(F.posexplode("cells").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).where("n > 0")
    want = build_sketch(drop_stop_words(tokens(posts, "text")), "w", params).cells
    assert {r["at"]: r["n"] for r in cells.collect()} == {r["row"] * 700 + r["bucket"]: r["cnt"] for r in want.collect()}
    assert own_sketch_top_k(state, 1, params).first()["w"] == "often"


def test_row_functions(spark):
    df = spark.createDataFrame([(1, "A  b"), (2, ""), (3, None), (4, "c")], "id long, text string")
    got = [(r["id"], r["w"]) for r in row_function(df, SplitWords, "text").collect()]
    assert sorted(got) == [(1, "a"), (1, "b"), (4, "c")]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text")
    mine = row_function(docs, SplitWords, "text").groupBy("w").count()
    assert sorted(mine.collect()) == sorted(word_counts(tokens(docs, "text")).collect())


def test_reducers_merge_the_parts_of_a_hot_group(spark):
    # one key holds a third of the rows and more
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 50).alias("k"), "id")
    got = reduce_groups(rows.repartition(6), ["k"], lambda: (0, None), lambda v, r: (
        v[0] + r["id"], r["id"] if v[1] is None else min(v[1], r["id"])), lambda a, b: (a[0] + b[0], min(a[1], b[1])),
        lambda v: {"total": v[0], "least": v[1]}, T.StructType().add("total", "long").add("least", "long"))
    assert sorted(got.collect(), key=str) == sorted(rows.groupBy("k").agg(
        F.sum("id").alias("total"), F.min("id").alias("least")).collect(), key=str)
    assert reduce_groups(rows.limit(0), ["k"], int, max, max, dict, T.StructType().add("x", "long")).collect() == []


def test_append_adds_new_keys_only(spark, tmp_path):
    store, path = doc_store(_posts(spark)).cache(), str(tmp_path / "store")
    write_store(store.where("length(text) < 500"), path, mode="append")     # nothing there yet
    for _ in range(2):
        write_store(store, path, mode="append")
        held = spark.read.parquet(path)
        assert held.count() == store.count() == held.select("index", "type", "id").distinct().count()
    assert sorted(update_store(spark.read.parquet(path), store.limit(0)).select("id", "count").collect()) == sorted(
        store.select("id", "count").collect())


def test_sketches_of_any_width_estimate(spark):
    words = spark.range(2000).select((F.col("id") % 100).cast("string").alias("w"))
    for params in (SketchParams(1, 1), SketchParams(3, 63), SketchParams(3, 64), SketchParams(2, 65), SketchParams(15, 100_000)):
        sketch = build_sketch(words, "w", params)
        asked = words.unionByName(spark.createDataFrame([("absent",), (None,)], "w string"))
        got = {r["w"]: r["estimate"] for r in sketch.estimate(asked, "w").collect()}
        assert len(got) == 101 and all(n >= 20 for w, n in got.items() if w != "absent")
        if params.width == 1:
            assert set(got.values()) == {2000}
        if params.width == 100_000:
            assert set(got.values()) == {0, 20}


def test_user_functions_equal_their_builtin_twins(spark):
    got = {r["lang"]: (r["docs"], r["chars"]) for r in queries.user_reduced(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = docs.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("c")).collect()
    assert got == {r["lang"]: (r["n"], r["c"]) for r in want}


def test_batches_of_ten_records(spark, tmp_path):
    landing, seen = str(tmp_path / "landing"), {}
    land_posts(_posts(spark).limit(57), landing, 1, records=10)
    query = read_posts_stream(spark, landing, 1).writeStream.foreachBatch(
        lambda df, batch: seen.update({batch: df.count()})).option(
        "checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(seen.values(), reverse=True) == [10, 10, 10, 10, 10, 7]
