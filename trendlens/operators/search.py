"""Text search over the counted store.

Queries are typed objects (``Term``, ``MultiMatch``, ``Bool``, ``Fuzzy``,
``MatchAll``, ``Prefix``, ``Wildcard``, ``Boosting``); ``search`` compiles one
into DataFrame operations over the store and returns every hit with its score:

    index, type, id, text, count, score, json

Scoring contract (the search server's own rules are external; these are ours):

- a matched term ``t`` in document ``d`` scores
  ``sqrt(tf) * (1 + ln(N / (df + 1)))^2 / sqrt(doc_len) * boost``, with ``tf``
  the occurrences of ``t`` in ``d``, ``df`` the documents holding ``t``, ``N``
  the documents searched and ``doc_len`` the analysed tokens of ``d``;
- term, match and fuzzy queries sum their matched terms per field, and a
  multi-field match keeps the best field;
- prefix, wildcard and match-all give the constant ``boost``;
- bool sums its must and matched should clauses and drops must-not hits;
  boosting multiplies a positive hit by ``negative_boost`` when the negative
  query also matches;
- scores are rounded to 6 places; ``ranked`` orders by score, then id.

Work plan.  The store is indexed once (``SearchIndex.build``).  A query is a
tree over leaves, each a set of terms of one field.  The leaves are resolved
against the dictionary first (``term_index``), which also gives df and the
ranges of postings to read; then one read of the postings serves all leaves of
the tree, a bit of a mask per leaf; a sum per document and leaf follows, and the
tree is one expression over these sums.  ``N`` is a scalar subquery.  A search
for the best ``size`` hits of a sum of terms reads only postings ranges that can
still hold one of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlens.functions.text import analyze
from trendlens.operators.store import STORE_KEYS, hits_json
from trendlens.operators.term_index import (
    CHUNK,
    RANGE,
    TermIndex,
    count_terms,
    read_postings,
    read_rows,
    weight,
    write_postings,
    write_terms,
)

KEYS = STORE_KEYS
SCORE_DIGITS = 6


@dataclass(frozen=True)
class Term:
    value: str
    field: str = "text"
    boost: float = 1.0


@dataclass(frozen=True)
class MultiMatch:
    text: str
    fields: tuple[str, ...] = ("text",)
    boost: float = 1.0


@dataclass(frozen=True)
class Fuzzy:
    value: str
    field: str = "text"
    fuzziness: int | None = None   # None = by length: 0-2 -> 0, 3-5 -> 1, longer -> 2
    prefix_length: int = 0
    boost: float = 1.0

    @property
    def max_edits(self) -> int:
        if self.fuzziness is not None:
            return self.fuzziness
        n = len(self.value)
        return 0 if n <= 2 else (1 if n <= 5 else 2)


@dataclass(frozen=True)
class MatchAll:
    boost: float = 1.0


@dataclass(frozen=True)
class Prefix:
    value: str
    field: str = "text"
    boost: float = 1.0


@dataclass(frozen=True)
class Wildcard:
    pattern: str
    field: str = "text"
    boost: float = 1.0


@dataclass(frozen=True)
class Bool:
    must: tuple = ()
    must_not: tuple = ()
    should: tuple = field(default=())


@dataclass(frozen=True)
class Boosting:
    positive: object
    negative: object
    negative_boost: float


def wildcard_to_like(pattern: str) -> str:
    """``?`` -> one character, ``*`` -> any run; LIKE's own specials are escaped."""
    out = []
    for ch in pattern:
        if ch in "\\%_":
            out.append("\\" + ch)
        elif ch == "?":
            out.append("_")
        elif ch == "*":
            out.append("%")
        else:
            out.append(ch)
    return "".join(out)


@dataclass(frozen=True)
class Leaf:
    """Terms of one field that a query asks for.

    ``pick`` names them: ``in`` (the values), ``prefix``, ``like`` (a wildcard
    pattern) or ``near`` (value, edits, prefix).  A scored leaf adds up its
    terms' scores; a constant one gives ``boost``.
    """

    field: str
    pick: str
    values: tuple
    boost: float
    scored: bool

    def test(self, term: Column) -> Column:
        """The leaf as a condition on a term (where there is no dictionary)."""
        if self.pick == "in":
            return term.isin(list(self.values))
        if self.pick == "prefix":
            return term.startswith(self.values[0])
        if self.pick == "like":
            return term.like(wildcard_to_like(self.values[0]))
        value, edits, prefix = self.values
        close = (F.abs(F.length(term) - F.lit(len(value))) <= edits) & (F.levenshtein(term, F.lit(value), edits) >= 0)
        return term.startswith(prefix) & close if prefix else close

    def terms(self, index: TermIndex) -> DataFrame:
        if self.pick == "in":
            return index.exact(self.field, list(self.values))
        if self.pick == "prefix":
            return index.prefixed(self.field, self.values[0])
        if self.pick == "like":
            return index.like(self.field, self.values[0], wildcard_to_like(self.values[0]))
        return index.near(self.field, *self.values)


class Tree:
    """A query over the sums ``_s<i>`` of its leaves (null: no term of leaf i in the document)."""

    def __init__(self, spark, query):
        self.spark, self.leaves = spark, []
        self.root = self._node(query)

    def _leaf(self, *args) -> tuple:
        leaf = Leaf(*args)
        if leaf not in self.leaves:
            self.leaves.append(leaf)
        return "leaf", self.leaves.index(leaf)

    def _node(self, q) -> tuple:
        if isinstance(q, Term):
            return self._leaf(q.field, "in", (q.value,), float(q.boost), True)
        if isinstance(q, MultiMatch):
            tokens = tuple(query_tokens(self.spark, q.text))
            return "best", [self._leaf(f, "in", tokens, float(q.boost), True) for f in q.fields]
        if isinstance(q, Fuzzy):
            return self._leaf(q.field, "near", (q.value, q.max_edits, q.value[:q.prefix_length]), float(q.boost), True)
        if isinstance(q, MatchAll):
            return "all", float(q.boost)
        if isinstance(q, Prefix):
            return self._leaf(q.field, "prefix", (q.value,), float(q.boost), False)
        if isinstance(q, Wildcard):
            return self._leaf(q.field, "like", (q.pattern,), float(q.boost), False)
        if isinstance(q, Bool):
            return "bool", [[self._node(c) for c in part] for part in (q.must, q.should, q.must_not)]
        if isinstance(q, Boosting):
            return "boost", (self._node(q.positive), self._node(q.negative), float(q.negative_boost))
        raise TypeError(f"unsupported query {q!r}")

    def hit(self, node: tuple) -> Column:
        kind, what = node
        if kind == "leaf":
            return F.col(f"_s{what}").isNotNull()
        if kind == "all":
            return F.lit(True)
        if kind == "best":
            return reduce(or_, [self.hit(n) for n in what])
        if kind == "boost":
            return self.hit(what[0])
        must, should, must_not = what
        conds = [self.hit(n) for n in must] or ([reduce(or_, [self.hit(n) for n in should])] if should else [F.lit(True)])
        return reduce(and_, conds + [~self.hit(n) for n in must_not])

    def score(self, node: tuple) -> Column:
        """The score of a document that the node hits."""
        kind, what = node
        if kind == "leaf":
            return F.col(f"_s{what}")
        if kind == "all":
            return F.lit(what)
        if kind == "best":
            scores = [self.score(n) for n in what]
            return F.greatest(*scores) if len(scores) > 1 else scores[0]
        if kind == "boost":
            positive, negative, factor = what
            return self.score(positive) * F.when(self.hit(negative), F.lit(factor)).otherwise(F.lit(1.0))
        must, should, _ = what
        if not must and not should:
            return F.lit(1.0)
        parts = [self.score(n) for n in must]
        parts += [F.when(self.hit(n), self.score(n)).otherwise(F.lit(0.0)) for n in should]
        return reduce(lambda a, b: a + b, parts)

    def hits_nothing_read(self, node: tuple | None = None) -> bool:
        """Does a document without any term of the leaves match?"""
        kind, what = node or self.root
        if kind == "bool":
            must, should, must_not = what
            none = self.hits_nothing_read
            return (all(map(none, must)) if must else any(map(none, should)) if should else True) and not any(
                map(none, must_not))
        return kind == "all" or kind == "boost" and self.hits_nothing_read(what[0])

    def sum_of_terms(self, node: tuple | None = None) -> bool:
        """Is the score a sum or best of term scores, so that more postings never lower it?"""
        kind, what = node or self.root
        if kind == "leaf":
            return self.leaves[what].scored and self.leaves[what].boost >= 0
        if kind == "best":
            return all(map(self.sum_of_terms, what))
        return kind == "bool" and not what[0] and bool(what[1]) and not what[2] and all(map(self.sum_of_terms, what[1]))


def _wanted(block: dict) -> tuple:
    return block["field"], block["term"], block["df"], block["mask"], block[RANGE]


BUCKET = "_b"

#: Resolved terms that are kept as values of the plan; more are written as a table.
MOST_VALUES = 4096

#: Requests scored together; (term, block) rows that are broadcast; rows and products a task holds at once.
REQUEST_BLOCK = 256
MOST_BROADCAST = 100_000
ANSWERED_ROWS = 1 << 15
PRODUCTS = 1 << 21

RESOLVED = f"field string, term string, df bigint, mask bigint, {RANGE} int"


def key_bucket(buckets: int) -> Column:
    """The document bucket: ``pmod(hash(index, type, id), buckets)``."""
    return F.pmod(F.hash(*[F.col(k) for k in KEYS]), F.lit(buckets))


class SearchIndex:
    """A searchable copy of the counted store.

    ``docs``: ``index, type, id, text, count`` -- one row per stored document.
    ``postings``: ``index, type, id, field, doc_len, term, tf`` -- one row per
    document and distinct analysed term, counted without a shuffle because
    the store is partitioned by document key.  ``stats``: documents per
    ``(index, type)``, so ``N`` never needs a scan of the documents.
    ``terms``: the dictionary (``term_index``); None where the index is not
    written (``from_store``) or grows (a live index), whose postings are
    filtered by term instead.

    ``build`` writes all of it as Parquet under the shared checkpoint folder;
    documents are partitioned into hash buckets of their key, so joining a
    query's hits back to the documents reads only the buckets holding hits
    (dynamic partition pruning) instead of every stored text.  Every query
    after the build reads the index; nothing is re-tokenised.
    """

    def __init__(self, docs: DataFrame, postings: DataFrame, fields: tuple[str, ...] = ("text",),
                 stats: DataFrame | None = None, doc_buckets: int | None = None,
                 version_col: str | None = None, terms: TermIndex | None = None, n_docs: int | None = None):
        self.docs = docs
        self.postings = postings
        self.fields = fields
        self.stats = stats
        self.doc_buckets = doc_buckets
        self.terms = terms
        # rows of a kept-up index carry a version; only a document's newest
        # version counts, and it is looked up for matched documents alone
        self.version_col = version_col
        if n_docs is not None:
            self.n_docs = F.lit(n_docs)
        elif stats is not None:
            self.n_docs = stats.select(F.coalesce(F.sum("n"), F.lit(0))).scalar()
        elif version_col:
            self.n_docs = docs.select(*KEYS).distinct().select(F.count(F.lit(1))).scalar()
        else:
            self.n_docs = docs.select(F.count(F.lit(1))).scalar()

    @staticmethod
    def postings_of(docs: DataFrame, fields: tuple[str, ...] = ("text",)) -> DataFrame:
        """``(index, type, id, field, doc_len, term, tf)`` for every field of every document.

        When ``docs`` is partitioned by document key (the store's aggregation,
        or a cache of it) the per-document term count needs no shuffle.
        """
        per_field = []
        for fld in fields:
            toks = docs.select(*KEYS, analyze(F.col(fld)).alias("_toks"))
            # explode_outer + a filter on the generated column: a plain explode of a
            # projected array makes Spark infer size(_toks) > 0 and push it below the
            # projection, which would split every text again
            occ = (toks.select(*KEYS, F.lit(fld).alias("field"), F.size("_toks").alias("doc_len"),
                               F.explode_outer("_toks").alias("term"))
                       .where(F.col("term").isNotNull()))
            per_field.append(occ.groupBy(*KEYS, "field", "doc_len", "term").agg(F.count(F.lit(1)).alias("tf")))
        return reduce(DataFrame.unionByName, per_field)

    @classmethod
    def from_store(cls, store: DataFrame, fields: tuple[str, ...] = ("text",)) -> SearchIndex:
        """An unmaterialised index (every query re-tokenises; for small or one-off use)."""
        return cls(store, cls.postings_of(store, fields), fields)

    @classmethod
    def build(cls, store: DataFrame, path: str | None = None, fields: tuple[str, ...] = ("text",),
              doc_buckets: int | None = None, bucket_bytes: int = 128 * 1024 ** 2,
              range_bytes: int = 64 * 1024 ** 2, ranges: int | None = None, chunk: int | None = None) -> SearchIndex:
        """Write the store, its postings, dictionary and counts under ``path`` (default: a fresh folder in the checkpoint dir).

        ``doc_buckets`` should leave about ``bucket_bytes`` of text per bucket
        and ``ranges`` about ``range_bytes`` of postings per range; by default
        both are derived from the store's text size (one aggregate, which also
        materialises the cache), with a range for each core at least.  A written row holds up to ``chunk``
        postings of a term: by default as many as are a small part of a range, so
        that a term may be cut over ranges.
        """
        from trendlens.session import scratch_path

        spark = store.sparkSession
        path = path or scratch_path(spark, "search-index")
        # all outputs come from one computation of the store; the cache keeps
        # its partitioning by document key, so term counts need no shuffle
        cached = store.select(*KEYS, "text", "count", *[f for f in fields if f != "text"]).persist()
        try:
            # one row: the text bytes of the store, and whether a key comes twice (this also fills the cache)
            by_key = cached.groupBy(*KEYS).agg(F.sum(F.octet_length("text")).alias("bytes"), F.count(F.lit(1)).alias("n"))
            size = by_key.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.max("n")).first()
            text_bytes, unique = int(size[0]), (size[1] or 0) <= 1
            if doc_buckets is None:
                doc_buckets = max(1, -(-text_bytes // bucket_bytes))
            if ranges is None:
                # postings take about twice the text
                ranges = max(spark.sparkContext.defaultParallelism, -(-2 * text_bytes // range_bytes))
            if chunk is None:
                # a posting is about eight bytes of text
                chunk = min(CHUNK, max(1, text_bytes // (8 * 1024 * ranges)))
            # a range of buckets per writer: about one bucket each, and keys hash evenly over buckets
            (cached.withColumn(BUCKET, key_bucket(doc_buckets)).repartitionByRange(doc_buckets, BUCKET)
                .write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/docs"))
            cached.groupBy("index", "type").agg(F.count(F.lit(1)).alias("n")) \
                .withColumn("buckets", F.lit(doc_buckets)).write.mode("overwrite").parquet(f"{path}/stats")
            # dealt by ranges, which samples them first: counting them twice is cheaper than keeping them
            write_postings(count_terms(cached, KEYS, fields, unique, chunk), f"{path}/postings", ranges)
        finally:
            cached.unpersist()
        write_terms(read_rows(spark, f"{path}/postings"), path, ranges)
        return cls.open(spark, path, fields)

    @classmethod
    def open(cls, spark, path: str, fields: tuple[str, ...] = ("text",)) -> SearchIndex:
        """Read an index written by ``build`` (schemas are known, so nothing is inferred from files)."""
        extra = "".join(f", `{f}` string" for f in fields if f != "text")
        docs_schema = f"index string, type string, id string, text string, count bigint{extra}, {BUCKET} int"
        stats = spark.read.schema("index string, type string, n bigint, buckets int").parquet(f"{path}/stats")
        # one row
        kept = stats.agg(F.max("buckets"), F.coalesce(F.sum("n"), F.lit(0))).first()
        return cls(spark.read.schema(docs_schema).parquet(f"{path}/docs"), read_postings(spark, f"{path}/postings"), fields,
                   stats.select("index", "type", "n"), int(kept[0]) if kept[0] is not None else None,
                   terms=TermIndex(spark, path), n_docs=kept[1])

    def restrict(self, indices: list[str] | None = None, types: list[str] | None = None) -> SearchIndex:
        """Only documents of the given indices and types."""
        conds = [F.col(c).isin(list(values)) for c, values in (("index", indices), ("type", types)) if values]
        if not conds:
            return self
        cond = reduce(and_, conds)
        return SearchIndex(self.docs.where(cond), self.postings.where(cond), self.fields,
                           self.stats.where(cond) if self.stats is not None else None, self.doc_buckets,
                           self.version_col, self.terms.restricted(cond) if self.terms else None)

    # -- leaves to postings -----------------------------------------------------
    def _current(self, docs: DataFrame) -> DataFrame:
        """Only the newest version of each document in ``docs``."""
        if not self.version_col:
            return docs
        newest = Window.partitionBy(*KEYS).orderBy(F.col(self.version_col).desc())
        return docs.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") == 1).drop(
            "_rank", self.version_col)

    def _filtered(self, leaves: list[Leaf]) -> DataFrame:
        """Postings of the leaves' terms with df and mask, found by testing every posting (no dictionary)."""
        tests = [(F.col("field") == leaf.field) & leaf.test(F.col("term")) for leaf in leaves]
        m = self.postings.where(reduce(or_, tests))
        if self.version_col:
            v = self.version_col
            newest = self.docs.select(*KEYS, v).join(m.select(*KEYS).distinct(), KEYS, "left_semi") \
                .groupBy(*KEYS).agg(F.max(v).alias(v))
            m = m.join(newest, [*KEYS, v]).drop(v)
        mask = reduce(lambda a, b: a.bitwiseOR(b), [
            F.when(t, F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, t in enumerate(tests)])
        dfreq = m.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))
        return m.withColumn("mask", mask).join(dfreq, ["field", "term"])

    def _terms(self, leaves: list[Leaf]) -> DataFrame:
        """The dictionary's rows of the leaves' terms, each leaf's with its bit as ``mask``."""
        return reduce(DataFrame.unionByName, [leaf.terms(self.terms).select(
            "field", "term", "index", "type", "df", "first", "last", "blocks", F.lit(1 << i).cast("bigint").alias("mask"))
            for i, leaf in enumerate(leaves)])

    def _resolve(self, leaves: list[Leaf]) -> list[dict] | DataFrame:
        """The leaves' terms: field, term, df, mask and range blocks (``_r, n, weight``) of the documents searched.

        Up to ``MOST_VALUES`` rows of the dictionary are put together here;
        more are grouped as a table of ``RESOLVED``.
        """
        found = self._terms(leaves)
        rows = found.limit(MOST_VALUES + 1).collect()
        # as many rows as the query has terms (and the dictionary indices), or few enough
        if len(rows) > MOST_VALUES and not all(leaf.pick == "in" for leaf in leaves):
            return found
        if len(rows) > MOST_VALUES:
            rows = found.collect()
        terms: dict[tuple, dict] = {}
        for r in rows:
            t = terms.setdefault((r["field"], r["term"]), {"df": {}, "mask": 0, "blocks": {}})
            t["df"][r["index"], r["type"]] = r["df"]
            t["mask"] |= r["mask"]
            for b in r["blocks"]:
                # a term's row of one index and type comes once for each leaf that asks for it
                t["blocks"].setdefault(b[RANGE], {})[r["index"], r["type"]] = (b["n"], b["weight"])
        return [{"field": f, "term": w, "df": sum(t["df"].values()), "mask": t["mask"], RANGE: k,
                 "n": sum(n for n, _ in held.values()), "weight": max(x for _, x in held.values())}
                for (f, w), t in terms.items() for k, held in t["blocks"].items()]

    def _table(self, found: DataFrame) -> DataFrame:
        """Very many resolved terms as a written table of ``RESOLVED``, whose size Spark knows."""
        from trendlens.session import scratch_path

        own = found.groupBy("field", "term", "index", "type").agg(
            F.bit_or("mask").alias("mask"), F.first("df").alias("df"), F.first("first").alias("first"),
            F.first("last").alias("last"))
        wanted = own.groupBy("field", "term").agg(
            F.sum("df").alias("df"), F.bit_or("mask").alias("mask"), F.min("first").alias("first"),
            F.max("last").alias("last")).select("field", "term", "df", "mask",
                                                F.explode(F.sequence("first", "last")).alias(RANGE))
        path = scratch_path(self.docs.sparkSession, "resolved-terms")
        wanted.write.parquet(path)
        return self.docs.sparkSession.read.schema(RESOLVED).parquet(path)

    def _read(self, wanted: DataFrame | list[tuple]) -> DataFrame:
        """Postings of resolved (field, term, range) rows, with df and mask; only those ranges are read."""
        spark = self.docs.sparkSession
        if isinstance(wanted, DataFrame):
            return self.postings.join(wanted, ["field", "term", RANGE])
        ranges = sorted({row[-1] for row in wanted})
        terms = sorted({row[1] for row in wanted})
        m = self.postings.where(F.col(RANGE).isin(ranges))
        if 0 < len(terms) <= 64:
            m = m.where(F.col("term").isin(terms))
        # at most MOST_VALUES rows
        return m.join(F.broadcast(spark.createDataFrame(wanted, RESOLVED)), ["field", "term", RANGE])

    def _postings(self, leaves: list[Leaf]) -> DataFrame:
        """``KEYS, tf, doc_len, df, mask``: one read of the postings of all leaves' terms."""
        if self.terms is None:
            return self._filtered(leaves)
        found = self._resolve(leaves)
        return self._read(self._table(found) if isinstance(found, DataFrame) else [_wanted(b) for b in found])

    def _idf(self, n_docs: Column) -> Column:
        return F.lit(1.0) + F.log(n_docs / (F.col("df") + F.lit(1)))

    def _sums(self, leaves: list[Leaf], postings: DataFrame) -> DataFrame:
        """``KEYS + [_s0, _s1, ...]``: what each leaf gives each document that holds one of its terms."""
        idf = self._idf(self.n_docs)
        # a column of its own: aggregates take no subquery (N)
        postings = postings.withColumn("_gain", F.sqrt(F.col("tf")) * idf * idf / F.sqrt(F.col("doc_len")))
        gain = F.col("_gain")
        own = [F.col("mask").bitwiseAND(F.lit(1 << i)) != 0 for i in range(len(leaves))]
        values = [F.when(o, gain * F.lit(leaf.boost) if leaf.scored else F.lit(leaf.boost))
                  for o, leaf in zip(own, leaves, strict=True)]
        if len(leaves) == 1 and leaves[0].pick == "in" and len(leaves[0].values) == 1:
            # postings hold one row per (document, field, term): nothing to sum
            return postings.select(*KEYS, values[0].alias("_s0"))
        return postings.groupBy(*KEYS).agg(*[
            (F.sum(v) if leaf.scored else F.max(v)).alias(f"_s{i}")
            for i, (v, leaf) in enumerate(zip(values, leaves, strict=True))])

    def _hits(self, tree: Tree, postings: DataFrame | None = None) -> DataFrame:
        sums = self._sums(tree.leaves, self._postings(tree.leaves) if postings is None else postings)
        return sums.where(tree.hit(tree.root)).select(*KEYS, tree.score(tree.root).alias("score"))

    # -- queries -------------------------------------------------------------------
    def scored(self, q) -> DataFrame:
        """``KEYS + [score]`` for every document matching ``q``."""
        tree = Tree(self.docs.sparkSession, q)
        if not tree.hits_nothing_read():
            return self._hits(tree)
        docs = self.docs.select(*KEYS).distinct()
        return self._over(docs, tree).select(*KEYS, "score")

    def _over(self, docs: DataFrame, tree: Tree) -> DataFrame:
        """``docs`` that match, with ``score``, where documents without any of the query's terms may match."""
        if tree.leaves:
            docs = docs.join(self._sums(tree.leaves, self._postings(tree.leaves)), KEYS, "left")
        return docs.where(tree.hit(tree.root)).withColumn("score", tree.score(tree.root))

    def search(self, q, size: int | None = None) -> DataFrame:
        """Hits of ``q``: ``index, type, id, text, count, score, json`` -- all, unordered, or the best ``size`` in order."""
        tree = Tree(self.docs.sparkSession, q)
        if tree.hits_nothing_read():
            out = self._over(self._current(self.docs), tree)
            hits = hits_json(out.select(*KEYS, "text", "count", F.round("score", SCORE_DIGITS).alias("score")))
            return hits if size is None else ranked(hits, size)
        if size is not None:
            return ranked(self._texts(ranked(self._best(tree, size), size)))
        return self._texts(self._hits(tree))

    def _texts(self, hits: DataFrame) -> DataFrame:
        on = KEYS
        if self.doc_buckets:
            # the bucket in the join lets Spark prune the document partitions to the hit buckets
            hits = hits.withColumn(BUCKET, key_bucket(self.doc_buckets))
            on = KEYS + [BUCKET]
        out = self._current(self.docs.join(hits, on, "inner")).select(
            *KEYS, "text", "count", F.round(F.col("score"), SCORE_DIGITS).alias("score"))
        return hits_json(out)

    # -- the best hits ---------------------------------------------------------------
    def _best(self, tree: Tree, size: int) -> DataFrame:
        """``KEYS + [score]`` (rounded) of hits that include the best ``size``."""
        rounded = F.round("score", SCORE_DIGITS).alias("score")
        if self.terms is None or not tree.sum_of_terms():
            return self._hits(tree).select(*KEYS, rounded)
        blocks = self._kept_blocks(tree, size)
        if blocks is None:
            return self._hits(tree).select(*KEYS, rounded)
        return self._hits(tree, self._read([_wanted(b) for b in blocks if b["kept"]])).select(*KEYS, rounded)

    def top_blocks(self, q, size: int) -> list[dict] | None:
        """The postings blocks (term, range) of ``q``: their rows ``n``, largest gain ``most``, and whether a search for ``size`` hits reads them."""
        return self._kept_blocks(Tree(self.docs.sparkSession, q), size)

    def _kept_blocks(self, tree: Tree, size: int) -> list[dict] | None:
        """Block-max: blocks that cannot hold one of the best ``size`` documents are not read.

        Every term's best block is read first, and the blocks of the largest
        gains as far as ``size`` postings.  Their documents' scores so far are lower bounds
        (the score is a sum of terms), so the ``size``-th of them bounds what
        the best hits have.  A document in another block has at most that
        block's largest gain and the largest of every other term: below the
        bound, neither it nor its other postings matter.  None where the query
        has more than ``MOST_VALUES`` terms.
        """
        blocks = self._resolve(tree.leaves)
        if isinstance(blocks, DataFrame):           # too many terms to look at one by one
            return None
        n_docs = self.docs.sparkSession.range(1).select(self.n_docs.cast("bigint")).first()[0]
        most: dict[tuple, float] = {}
        for b in blocks:
            idf = 1.0 + math.log(n_docs / (b["df"] + 1)) if n_docs else 0.0
            boost = sum(leaf.boost for i, leaf in enumerate(tree.leaves) if b["mask"] >> i & 1)
            b["most"], b["kept"] = b["weight"] * idf * idf * boost, True
            key = b["field"], b["term"]
            most[key] = max(most.get(key, 0.0), b["most"])
        blocks.sort(key=lambda b: (-b["most"], b["field"], b["term"], b[RANGE]))
        first, held, seen = [], 0, set()
        for b in blocks:
            if held < size or (b["field"], b["term"]) not in seen:
                first.append(_wanted(b))
                held += b["n"]
            seen.add((b["field"], b["term"]))
        if len(first) == len(blocks):
            return blocks
        bounds = self._hits(tree, self._read(first)).select(F.round("score", SCORE_DIGITS).alias("score")).orderBy(
            F.col("score").desc()).limit(size).collect()
        if len(bounds) == size:
            bound, total = bounds[-1]["score"], sum(most.values())
            for b in blocks:
                # a unit of the last place more, since scores are rounded before they are compared
                b["kept"] = b["most"] + total - most[b["field"], b["term"]] >= bound - 10.0 ** -SCORE_DIGITS
        return blocks


def query_tokens(spark, text: str) -> list[str]:
    """The analysed tokens of a query string, by the same Spark expression as the documents.

    Catalyst folds the literal expression; the one-row result comes back from
    a trivial job.  Knowing the terms lets the postings scan push them down.
    """
    row = spark.range(1).select(analyze(F.lit(text)).alias("t")).first()
    return list(dict.fromkeys(row["t"]))


def search(index: SearchIndex | DataFrame, q, indices: list[str] | None = None,
           types: list[str] | None = None, size: int | None = None) -> DataFrame:
    """J3 + Q-*: evaluate ``q`` over an index (or a store, indexed lazily), restricted to ``indices``/``types``.

    ``size``: only the best ``size`` hits, in order.
    """
    if isinstance(index, DataFrame):
        index = SearchIndex.from_store(index)
    return index.restrict(indices, types).search(q, size)


def search_requests(index: SearchIndex | DataFrame, requests: DataFrame, fld: str = "text",
                    size: int | None = None) -> DataFrame:
    """J3 + A3: answers a table of requests in one plan.

    ``requests`` holds ``request_id, kind, value, index, type``; ``kind`` is
    ``term`` (the value is one analysed token) or ``match`` (the value is
    analysed; every token scores).  Equal requests are answered once, under
    their smallest id.  Requests' tokens meet the dictionary once, which gives
    df and the term's ranges, and are written as a numbered table; only these
    terms' postings are read.  Postings are then dealt by document and meet
    blocks of about ``REQUEST_BLOCK`` requests, so that a (request, document)
    pair is made once, as a hit, and not once for each token the two share.
    ``size`` keeps the best hits of each request.
    Result: ``request_id`` and the columns of ``search``.
    """
    if isinstance(index, DataFrame):
        index = SearchIndex.from_store(index)
    spark = index.docs.sparkSession
    asked = requests.groupBy("kind", "value", "index", "type").agg(F.min("request_id").alias("request_id"))
    terms = F.when(F.col("kind") == "term", F.array("value")).when(
        F.col("kind") == "match", F.array_distinct(analyze(F.col("value"))))
    tokens = _kept(asked.select("request_id", "index", "type", F.explode(terms).alias("term")), "request-tokens")
    stats = index.stats if index.stats is not None else index._current(index.docs).groupBy("index", "type").agg(
        F.count(F.lit(1)).alias("n"))
    known = tokens.select("index", "type", "term").distinct().join(
        stats.groupBy("index", "type").agg(F.sum("n").alias("_n")), ["index", "type"])
    if index.terms is not None:
        every, on = index.postings.where(F.col("field") == fld), ["index", "type", "term", RANGE]
        words = index.terms.terms.where(F.col("field") == fld).select("index", "type", "term", "df", "first", "last")
    else:
        # the dictionary of the asked terms, counted from the postings
        every, on = index._filtered([Leaf(fld, "prefix", ("",), 1.0, True)]).drop("df", "mask"), ["index", "type", "term"]
        words = every.groupBy("index", "type", "term").agg(F.count(F.lit(1)).alias("df")).withColumns(
            {"first": F.lit(0), "last": F.lit(0)})
    idf = F.lit(1.0) + F.log(F.col("_n") / (F.col("df") + F.lit(1)))
    # written, so that a rerun gives a term the same number
    numbered = _kept(known.join(words, ["index", "type", "term"]).select(
        "index", "type", "term", "first", "last", (idf * idf).alias("value"),
        F.monotonically_increasing_id().alias("term_no")), "request-terms")
    n_terms, n_requests = numbered.count(), asked.count()
    blocks = max(1, -(-n_requests // REQUEST_BLOCK))
    parts = max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // blocks))
    block = F.pmod(F.xxhash64("request_id"), F.lit(blocks)).cast("int")
    wanted = tokens.join(numbered, ["index", "type", "term"]).withColumn("block", block)
    per_block = wanted.select("block", "index", "type", "term", "first", "last", "term_no").distinct()
    if RANGE in on:
        ranges = [r[0] for r in numbered.select(F.explode(F.sequence("first", "last"))).distinct().limit(
            MOST_VALUES + 1).collect()]
        if len(ranges) <= MOST_VALUES:
            every = every.where(F.col(RANGE).isin(ranges))
        per_block = per_block.withColumn(RANGE, F.explode(F.sequence("first", "last")))
    if n_terms * min(blocks, n_requests) <= MOST_BROADCAST:
        per_block = F.broadcast(per_block)
    part = F.pmod(F.hash(*[F.col(k) for k in KEYS]), F.lit(parts))
    held = every.join(per_block, on).select(
        (F.col("block") * F.lit(parts) + part).alias("part"), F.xxhash64(*KEYS).alias("order"), *KEYS, "term_no",
        weight().alias("value"))
    sides = wanted.select(F.explode(F.sequence(F.col("block") * parts, F.col("block") * parts + (parts - 1))).alias("part"),
                          "term_no", "value", "request_id").unionByName(held, allowMissingColumns=True)
    id_type = requests.schema["request_id"].dataType
    order = [F.asc_nulls_first("order"), *KEYS]      # a block's requests come before its documents
    found = sides.select("part", "order", *KEYS, "term_no", "value", "request_id").repartitionById(
        blocks * parts, "part").sortWithinPartitions(*order).mapInArrow(
        _answers, T.StructType([*[T.StructField(k, T.StringType()) for k in KEYS], T.StructField(
            "_found", T.ArrayType(T.StructType([T.StructField("request_id", id_type),
                                                T.StructField("score", T.DoubleType())])))]))
    if size is not None:
        best = Window.partitionBy("request_id").orderBy(F.round("score", SCORE_DIGITS).desc(), F.col("id"))
        found = found.select(*KEYS, F.inline("_found")).withColumn("_rank", F.row_number().over(best)).where(
            F.col("_rank") <= size).select(*KEYS, F.array(F.struct("request_id", "score")).alias("_found"))
    on = KEYS
    if index.doc_buckets:
        found, on = found.withColumn(BUCKET, key_bucket(index.doc_buckets)), KEYS + [BUCKET]
    out = hits_json(index._current(index.docs).join(found, on).select(*KEYS, "text", "count", "_found"))
    return out.select(*KEYS, "text", "count", "json", F.inline("_found")).select(
        "request_id", *KEYS, "text", "count", F.round("score", SCORE_DIGITS).alias("score"), "json")


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read back, so that its rows are fixed and Spark knows its size."""
    from trendlens.session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every document's requests and scores: a block's (term, request, idf) rows first, then its documents' postings.

    Holds the block's requests and one slice of documents.
    """
    asked: list[pa.RecordBatch] = []
    block, rest, rows = None, [], 0
    for batch in batches:
        cut = batch.column("order").null_count
        if cut:
            asked.append(batch.slice(0, cut).select(["term_no", "value", "request_id"]))
        if cut == batch.num_rows:
            continue
        if block is None:
            if not asked:
                return
            block = _Block(pa.Table.from_batches(asked).combine_chunks())
        rest.append(batch.slice(cut))
        rows += batch.num_rows - cut
        if rows < ANSWERED_ROWS:
            continue
        held = pa.Table.from_batches(rest)
        starts = _document_starts(held)
        last = int(starts[-1])          # its document may go on in the next batch
        if last:
            yield block.answer(held.slice(0, last), starts[:-1])
        rest = held.slice(last).combine_chunks().to_batches()
        rows = held.num_rows - last
    if rows:
        held = pa.Table.from_batches(rest)
        yield block.answer(held, _document_starts(held))


def _document_starts(held: pa.Table) -> np.ndarray:
    """The rows at which a document's postings begin."""
    new = np.zeros(held.num_rows, bool)
    new[0] = True
    for key in ("order", *KEYS):
        column = held.column(key)
        differs = pc.not_equal(column.slice(1), column.slice(0, held.num_rows - 1))
        new[1:] |= pc.fill_null(differs, True).to_numpy().astype(bool)
    return np.flatnonzero(new)


class _Block:
    """The requests of a block: for each term, the requests that ask for it and its idf squared."""

    def __init__(self, asked: pa.Table):
        ids = pc.dictionary_encode(asked.column("request_id"), null_encoding="encode").combine_chunks()
        self.ids, request = ids.dictionary, ids.indices.to_numpy()
        term, idf = asked.column("term_no").to_numpy(), asked.column("value").to_numpy()
        order = np.argsort(term, kind="stable")
        self.terms, self.first, self.asks = np.unique(term[order], return_index=True, return_counts=True)
        self.request, self.idf = request[order].astype(np.int64), idf[order]

    def answer(self, held: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        docs, width = len(starts), len(self.ids)
        doc = np.repeat(np.arange(docs), np.diff(np.append(starts, held.num_rows)))
        at = np.searchsorted(self.terms, held.column("term_no").to_numpy())
        value = held.column("value").to_numpy()
        score, hit = np.zeros(docs * width), np.zeros(docs * width, bool)
        ends = np.cumsum(self.asks[at])
        row = 0
        while row < held.num_rows:      # as many rows as make about PRODUCTS products
            before = ends[row - 1] if row else 0
            stop = max(row + 1, int(np.searchsorted(ends, before + PRODUCTS, "right")))
            asks = self.asks[at[row:stop]]
            each = np.repeat(self.first[at[row:stop]] - np.cumsum(asks) + asks, asks) + np.arange(asks.sum())
            low = int(doc[row]) * width
            cell = np.repeat(doc[row:stop] * width, asks) + self.request[each] - low
            size = (int(doc[stop - 1]) + 1) * width - low
            score[low:low + size] += np.bincount(cell, np.repeat(value[row:stop], asks) * self.idf[each], size)
            hit[low + cell] = True
            row = stop
        cells = np.flatnonzero(hit)
        per_doc = np.bincount(cells // width, minlength=docs)
        found = pa.StructArray.from_arrays([self.ids.take(pa.array(cells % width)), pa.array(score[cells])],
                                           names=["request_id", "score"])
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_doc)]), pa.int32()), found)
        keys = held.select(KEYS).take(pa.array(starts)).combine_chunks().to_batches()[0]
        return pa.RecordBatch.from_arrays([*keys.columns, lists], names=[*KEYS, "_found"])


def ranked(hits: DataFrame, size: int | None = None) -> DataFrame:
    """Hits by score descending, then id; the first ``size`` only when given."""
    out = hits.orderBy(F.col("score").desc(), F.col("id").asc())
    return out.limit(size) if size is not None else out
