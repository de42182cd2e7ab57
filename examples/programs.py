"""The three programs of a trending-text deployment, on Structured Streaming.

    python examples/programs.py topk     [--posts DIR] [--polls N] [--every SEC]
    python examples/programs.py count    [--posts DIR] [--words "to the apple"]
    python examples/programs.py search   [--posts DIR]

Each starts a stream over the JSON post files in ``--posts`` (default: the
sf0.001 ``documents`` table landed as posts in a scratch folder), then polls
what the stream publishes, as a caller would, and prints one line per poll:

- ``topk``: the five most frequent non-stop words by count-min estimate,
  rendered ``w:c|w:c|...``;
- ``count``: the estimate of every word of a request (stop words answer 0);
- ``search``: the ten search kinds (term, multi-match, bool and / not, fuzzy,
  match-all, prefix, wildcard, boosting) against the live index, as JSON hits.
"""

from __future__ import annotations

import argparse
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from trendlens import get_session  # noqa: E402
from trendlens.operators.search import (  # noqa: E402
    Bool,
    Boosting,
    Fuzzy,
    MatchAll,
    MultiMatch,
    Prefix,
    Term,
    Wildcard,
    ranked,
    search,
)
from trendlens.operators.sketch import CountMinSketch, SketchParams, lookup_counts  # noqa: E402
from trendlens.operators.topk import top_k_string  # noqa: E402
from trendlens.session import scratch_path  # noqa: E402
from trendlens.sources import documents_as_posts, read_posts_stream  # noqa: E402
from trendlens.streaming import Snapshots, land_posts, live_index, running_search_index, running_sketch_top_k  # noqa: E402


def searches(a: str, b: str) -> dict:
    return {
        f"term {a}": Term(a),
        f"multi_match {a}": MultiMatch(a),
        f"bool {a} -{b}": Bool(must=(Term(a),), must_not=(Term(b),)),
        f"bool {a} +{b}": Bool(must=(Term(a), Term(b))),
        f"fuzzy {a}": Fuzzy(a, prefix_length=0, boost=1.0),
        "match_all": MatchAll(),
        f"prefix {a[:3]}": Prefix(a[:3], boost=2.0),
        f"wildcard {a[0]}??{a[3:4]}*": Wildcard(f"{a[0]}??{a[3:4]}*"),
        f"boosting {a} / {b}": Boosting(Term(a), Term(b), 0.2),
    }


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("program", choices=["topk", "count", "search"])
    ap.add_argument("--posts", help="folder of JSON-lines posts (default: sf0.001 documents, landed)")
    ap.add_argument("--polls", type=int, default=5)
    ap.add_argument("--every", type=float, default=4.0)
    ap.add_argument("--words", default="to the apple")
    ap.add_argument("--terms", default="under,ties", help="two search terms: a,b")
    args = ap.parse_args()

    spark = get_session("local[*]", app_name=f"trendlens-{args.program}")
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_path(spark, f"program-{args.program}")
    posts_dir = args.posts or land_posts(
        documents_as_posts(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")), f"{root}/posts", 4)
    posts = read_posts_stream(spark, posts_dir, max_files_per_trigger=1)
    snaps = Snapshots(f"{root}/snapshots")
    trigger = {"processingTime": "1 second"}

    if args.program in ("topk", "count"):
        # the word-count program uses a narrower sketch than the top-k one
        params = SketchParams(15, 1000 if args.program == "topk" else 100, 10)
        query = running_sketch_top_k(posts, snaps, f"{root}/ckpt", k=5, params=params, trigger=trigger)
    else:
        query = running_search_index(posts, snaps, f"{root}/ckpt", trigger=trigger)

    try:
        for poll in range(args.polls):
            time.sleep(args.every)
            version = snaps.latest_version(spark)
            if version is None:
                print(f"RESULT {poll}: nothing published yet")
                continue
            if args.program == "topk":
                top = snaps.read(spark, "topk", version)
                print(f"RESULT {poll}: {top_k_string(top, 'estimate', 'w').first()['topk']}")
            elif args.program == "count":
                sketch = CountMinSketch(snaps.read(spark, "cells", version), params)
                req = spark.range(1).select(F.explode(F.split(F.lit(args.words), " ")).alias("query"))
                counts = {r["query"]: r["count"] for r in lookup_counts(sketch, req).collect()}
                print(f"RESULT {poll}: {counts}")
            else:
                index = live_index(spark, snaps)
                a, b = args.terms.split(",")
                for label, q in searches(a, b).items():
                    hits = [r["json"][:60] for r in ranked(search(index, q), size=3).collect()]
                    print(f"RESULT {poll} {label}: {len(hits)} shown {hits}")
    finally:
        query.stop()
        spark.stop()


if __name__ == "__main__":
    main()
