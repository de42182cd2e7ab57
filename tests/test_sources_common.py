import contextlib
import io

import pytest
from pyspark.sql import functions as F

from trendlens.operators.store import update_store, write_store
from trendlens.session import checkpoint_root, scratch_path
from trendlens.sources.tables import FAN_OUT, read_table, session_fan_out


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_fan_out_is_explicit(spark):
    assert read_table(spark, "/root/testdata/sf0.001", "documents", fan_out=7).rdd.getNumPartitions() == 7
    assert session_fan_out(spark) is None
    spark.conf.set(FAN_OUT, "5")
    try:
        assert session_fan_out(spark) == 5
    finally:
        spark.conf.unset(FAN_OUT)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


def test_scratch_keeps_the_scheme(spark):
    assert scratch_path(spark, "x").startswith("file:/")


def test_read_table_prunes_columns(spark):
    df = read_table(spark, "/root/testdata/sf0.001", "documents", ["doc_id", "lang"])
    assert df.columns == ["doc_id", "lang"]
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in _plan(df)


def test_write_store_overwrite_and_append(spark, tmp_path):
    path = str(tmp_path / "store")
    one = spark.createDataFrame([("my_index", "my_type", "1", "a", 1)], "index string, type string, id string, text string, count bigint")
    write_store(one, path)
    two = spark.createDataFrame([("my_index", "my_type", "1", "0", 2), ("my_index", "my_type", "2", "b", 1)], one.schema)
    merged = update_store(spark.read.parquet(path), two)           # keep and update: one row per key
    assert sorted((r["id"], r["text"], r["count"]) for r in merged.collect()) == [("1", "0", 3), ("2", "b", 1)]
    write_store(one, path)                                         # recreate
    assert spark.read.parquet(path).count() == 1
    assert spark.read.parquet(path).where(F.col("count") == 1).count() == 1


def test_cluster_conf_sizes_partitions_from_input():
    from trendlens.session import cluster_conf

    conf = cluster_conf(100 * 1024 ** 4, cores=4000)              # 100 TB on 4000 cores
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 1024 ** 4 // (128 * 1024 ** 2)
    assert cluster_conf(10 * 1024 ** 2, cores=8)["spark.sql.shuffle.partitions"] == "16"
