from pyspark.sql import functions as F

from trendlens.operators.sketch import SketchParams
from trendlens.operators.store import doc_store
from trendlens.operators.topk import top_k
from trendlens.operators.words import drop_stop_words, tokens, word_counts
from trendlens.sources import documents_as_posts, read_posts_stream
from trendlens.streaming import Snapshots, land_posts, running_doc_counts, running_sketch_top_k, running_word_top_k

SF = "/root/testdata/sf0.001"


def _posts(spark):
    return documents_as_posts(spark.read.parquet(f"{SF}/documents.parquet"))


def _run(query):
    query.awaitTermination()
    assert query.exception() is None


def test_snapshot_versions(spark, tmp_path):
    snaps = Snapshots(str(tmp_path / "snaps"))
    assert snaps.latest_version(spark) is None
    assert snaps.read(spark, "t") is None
    for v in (0, 1, 2):
        snaps.publish(spark, {"t": spark.createDataFrame([(v,)], "x int")}, v)
    assert snaps.latest_version(spark) == 2
    assert snaps.latest_version(spark, before=2) == 1
    # a replayed batch is published anew, and a reader of the first attempt keeps its rows
    held = snaps.read(spark, "t", 1)
    snaps.publish(spark, {"t": spark.createDataFrame([(9,)], "x int")}, 1)
    assert held.first()["x"] == 1
    assert snaps.read(spark, "t", 1).first()["x"] == 9
    assert snaps.read(spark, "t").first()["x"] == 2


def test_stream_doc_counts_equal_batch_after_restart(spark, tmp_path):
    posts = _posts(spark)
    first, second = posts.where(F.col("id") % 2 == 0), posts.where(F.col("id") % 2 == 1)
    landing = str(tmp_path / "landing")
    land_posts(first, landing, 2)
    snaps = Snapshots(str(tmp_path / "snaps"))
    ckpt = str(tmp_path / "ckpt")
    _run(running_doc_counts(read_posts_stream(spark, landing, 1), snaps, ckpt))
    half = snaps.latest_version(spark)
    # more posts land; the same query restarts from its checkpoint
    second.repartition(2).write.mode("append").json(landing)
    _run(running_doc_counts(read_posts_stream(spark, landing, 1), snaps, ckpt))
    assert snaps.latest_version(spark) > half
    got = sorted(snaps.read_keyed(spark, "store", ["index", "type", "id"]).collect())
    want = sorted(doc_store(posts).select("index", "type", "id", "text", "count").collect())
    assert got == want


def test_keyed_upsert_deltas_and_compaction(spark, tmp_path):
    snaps = Snapshots(str(tmp_path / "snaps"))
    batches = [[("a", 1), ("b", 1)], [("a", 2)], [("c", 1)], [("b", 5)], [("a", 3), ("d", 1)]]
    expected = {}
    for i, rows in enumerate(batches):
        snaps.upsert(spark, "t", spark.createDataFrame(rows, "k string, n bigint"), ["k"], i, compact_every=2)
        expected.update(dict(rows))
        got = {r["k"]: r["n"] for r in snaps.read_keyed(spark, "t", ["k"]).collect()}
        assert got == expected
    # a delta holds only its batch's rows; a base holds everything
    assert snaps.latest_commit(spark) == (4, 4)
    assert snaps.read(spark, "t", 3).count() == 1
    assert snaps.read(spark, "t", 4).count() == 4
    # older versions stay readable, and a fresh reader finds the same state
    assert {r["k"]: r["n"] for r in snaps.read_keyed(spark, "t", ["k"], version=1).collect()} == {"a": 2, "b": 1}
    assert Snapshots(str(tmp_path / "snaps")).latest_commit(spark, before=4) == (3, 2)
    # versions 0..3 are below the newest base (4) and no reader needs them
    assert sorted(r["batch"] for r in snaps.obsolete_versions(spark).collect()) == [0, 1, 2, 3]
    assert sorted(r["batch"] for r in snaps.obsolete_versions(spark, keep_bases=2).collect()) == [0, 1]
    # replaying batch 3 gives the same result
    snaps.upsert(spark, "t", spark.createDataFrame([("b", 5)], "k string, n bigint"), ["k"], 3, compact_every=2)
    assert {r["k"]: r["n"] for r in snaps.read_keyed(spark, "t", ["k"], version=3).collect()} == \
        {"a": 2, "b": 5, "c": 1}


def test_stream_word_top_k_equals_batch(spark, tmp_path):
    landing = land_posts(_posts(spark), str(tmp_path / "landing"), 3)
    snaps = Snapshots(str(tmp_path / "snaps"))
    _run(running_word_top_k(read_posts_stream(spark, landing, 1), snaps, str(tmp_path / "ckpt"), k=5))
    got = [(r["w"], r["count"]) for r in snaps.read(spark, "topk").orderBy(F.desc("count"), "w").collect()]
    exact = top_k(word_counts(drop_stop_words(tokens(_posts(spark), "text")), "w", "count"), 5, "count", "w")
    assert got == [(r["w"], r["count"]) for r in exact.collect()]


def test_stream_sketch_top_k_wide_equals_exact(spark, tmp_path):
    landing = land_posts(_posts(spark), str(tmp_path / "landing"), 3)
    snaps = Snapshots(str(tmp_path / "snaps"))
    params = SketchParams(5, 100_000)
    _run(running_sketch_top_k(read_posts_stream(spark, landing, 1), snaps, str(tmp_path / "ckpt"), 5, params))
    got = [(r["w"], r["estimate"]) for r in snaps.read(spark, "topk").orderBy(F.desc("estimate"), "w").collect()]
    exact = top_k(word_counts(drop_stop_words(tokens(_posts(spark), "text")), "w", "count"), 5, "count", "w")
    assert got == [(r["w"], r["count"]) for r in exact.collect()]
    # the sketch state stays bounded by depth x width cells
    assert snaps.read(spark, "cells").count() <= params.cells


def test_poll_snapshots_while_running(spark, tmp_path):
    # T4: a caller re-reads the published state while the query keeps running
    import time

    from trendlens.sources import fixed_sentences

    landing = str(tmp_path / "landing")
    sentences = fixed_sentences(spark, 3).select(F.col("sentence").alias("text"))
    land_posts(sentences, landing, 3)
    snaps = Snapshots(str(tmp_path / "snaps"))
    q = running_word_top_k(read_posts_stream(spark, landing, 1), snaps, str(tmp_path / "ckpt"), k=5,
                           trigger={"processingTime": "1 second"})
    try:
        seen = []
        deadline = time.time() + 120
        while time.time() < deadline:
            v = snaps.latest_version(spark)
            if v is not None:
                seen.append(sorted((r["w"], r["count"]) for r in snaps.read(spark, "topk", v).collect()))
                if v == 2:          # one micro-batch per landed file: versions 0, 1, 2
                    break
            time.sleep(0.5)
        assert q.isActive
        # S4 cycled three times: after all three files every kept word counts 3
        assert seen and seen[-1] == [("ago", 3), ("apples", 3), ("bought", 3), ("candy", 3), ("cow", 3)]
    finally:
        q.stop()


def test_stream_approx_top_k(spark, tmp_path):
    from trendlens.streaming import running_approx_top_k

    landing = land_posts(_posts(spark), str(tmp_path / "landing"), 3)
    snaps = Snapshots(str(tmp_path / "snaps"))
    _run(running_approx_top_k(read_posts_stream(spark, landing, 1), snaps, str(tmp_path / "ckpt"), k=5))
    got = [(r["w"], r["count"]) for r in snaps.read(spark, "topk").orderBy(F.desc("count"), "w").collect()]
    exact = top_k(word_counts(drop_stop_words(tokens(_posts(spark), "text")), "w", "count"), 5, "count", "w")
    # the leading words stand far above the rest, so the summary finds them exactly
    assert got == [(r["w"], r["count"]) for r in exact.collect()]


def test_live_search_index_equals_batch_index(spark, tmp_path):
    from trendlens.operators.search import Bool, Fuzzy, MatchAll, Prefix, SearchIndex, Term, search
    from trendlens.streaming import live_index, running_search_index

    # every post twice, dealt over three files: texts are seen again in later batches
    posts = _posts(spark).unionByName(_posts(spark))
    landing = land_posts(posts, str(tmp_path / "landing"), 3)
    snaps = Snapshots(str(tmp_path / "snaps"))
    # three micro-batches, one base: the last read is the base plus two deltas
    _run(running_search_index(read_posts_stream(spark, landing, 1), snaps, str(tmp_path / "ckpt"),
                              compact_every=3))
    assert snaps.latest_commit(spark) == (2, 0)
    live = live_index(spark, snaps)
    built = SearchIndex.build(doc_store(posts), str(tmp_path / "built"))
    for q in (Term("the"), Term("under"), MatchAll(), Prefix("thr"), Fuzzy("thrund"),
              Bool(must=(Term("the"),), must_not=(Term("under"),))):
        got = sorted(search(live, q).select("id", "count", "score").collect())
        want = sorted(search(built, q).select("id", "count", "score").collect())
        assert got == want, q
    # the appended postings do repeat rows; the index reads them once
    raw = sum(snaps.read(spark, "postings", v).count() for v in (0, 1, 2))
    assert raw > built.postings.count()


def test_state_partitions_apply_to_the_stream_only(spark, tmp_path):
    landing = land_posts(_posts(spark), str(tmp_path / "landing"), 2)
    snaps = Snapshots(str(tmp_path / "snaps"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    q = running_word_top_k(read_posts_stream(spark, landing, 1), snaps, str(tmp_path / "ckpt"), k=5,
                           state_partitions=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    _run(q)
    state = tmp_path / "ckpt" / "state" / "0"
    assert sorted(p.name for p in state.iterdir() if p.name.isdigit()) == ["0", "1", "2"]


def test_id_takeover_on_the_live_index(spark, tmp_path):
    # "zz b[" and "zz az" have one 32-bit id; the smaller text takes the document over
    from trendlens.operators.search import SearchIndex, Term, search
    from trendlens.streaming import live_index, running_search_index

    posts = _posts(spark).limit(1)
    rows = [posts.withColumn("text", F.lit(t)) for t in ("zz b[", "zz az")]
    landing, snaps = str(tmp_path / "landing"), Snapshots(str(tmp_path / "snaps"))
    for i, part in enumerate(rows):
        part.coalesce(1).write.mode("append").json(landing)
        _run(running_search_index(read_posts_stream(spark, landing, 1), snaps, str(tmp_path / "ckpt"), compact_every=9))
    live, built = live_index(spark, snaps), SearchIndex.from_store(doc_store(rows[0].unionByName(rows[1])))
    for term, texts in (("b", []), ("az", ["zz az"]), ("zz", ["zz az"])):
        for index in (live, built):
            assert [r["text"] for r in search(index, Term(term)).collect()] == texts, term


def test_changed_rows_are_computed_once_per_compaction(spark, tmp_path):
    snaps = Snapshots(str(tmp_path / "snaps"))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    for i in range(3):
        changed = spark.range(100).withColumn("n", F.lit(i)).mapInArrow(count, "id long, n int")
        snaps.upsert(spark, "t", changed, ["id"], i, compact_every=1)
        assert seen.value == 100 * (i + 1)
    assert snaps.read_keyed(spark, "t", ["id"]).where("n = 2").count() == 100


def test_a_broken_commit_folder_is_an_error(spark, tmp_path):
    import pytest

    root = tmp_path / "snaps"
    (root / "commits").mkdir(parents=True)
    (root / "commits" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet|corrupt|read"):
        Snapshots(str(root)).latest_commit(spark)
