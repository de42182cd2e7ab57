"""Time core pipelines on 1x, 4x and 16x copies of the sf0.1 documents.

Usage: python tools/scaling_check.py [sf_dir]

The copies are unioned lazily (nothing is written); every copy repeats every
text, so the counted store also sees hot duplicates that must combine
map-side.
"""

import os
import sys
import time
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from trendlens.session import get_session
spark = get_session("local[8]", shuffle_partitions=8)
spark.sparkContext.setLogLevel("ERROR")
from pyspark.sql import DataFrame, functions as F
from trendlens.operators.words import tokens, drop_stop_words, word_counts
from trendlens.operators.topk import top_k
from trendlens.operators.sketch import sketch_top_k, SketchParams
from trendlens.operators.store import doc_store
from trendlens.sources import documents_as_posts
from trendlens.sources.tables import read_table
base = read_table(spark, sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1", "documents", ["doc_id", "text", "lang", "source"])
def copies(n):
    # n copies of the table, each copy's ids shifted so texts stay the same but posts differ
    return reduce(DataFrame.unionByName, [base.withColumn("doc_id", F.col("doc_id") + i * 10_000_000) for i in range(n)]).repartition(8 * n)
jobs = {
    "topk_exact": lambda d: top_k(word_counts(drop_stop_words(tokens(d, "text")), "w", "count"), 5, "count", "w"),
    "topk_cms": lambda d: sketch_top_k(tokens(d, "text"), 5, "w", SketchParams(15, 1000))[0],
    "doc_counts": lambda d: doc_store(documents_as_posts(d)),
}
for n in (1, 4, 16):
    d = copies(n)
    row = []
    for name, fn in jobs.items():
        best = min((lambda t0: (fn(d).write.format("noop").mode("overwrite").save(), time.perf_counter() - t0)[1])(time.perf_counter()) for _ in range(2))
        row.append(f"{name} {best:.2f}s")
    print(f"x{n:<3}", " | ".join(row), flush=True)
