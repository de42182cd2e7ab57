"""The written term index: dictionary, term-ranged postings, gram and deletion indexes.

- ``postings``: ``index, type, id, field, doc_len, term, tf``, written in rows of up
  to ``CHUNK`` postings of a term, which one stretch of documents has, and dealt by
  ranges of (term, field, largest weight descending, id), one folder ``_r=<range>`` a
  range.  A term's postings lie in consecutive ranges and a term of a third of all
  documents in as many as its size asks for; its heaviest rows come first.
- ``terms``, the dictionary: ``index, type, field, term, df, first, last, blocks,
  head``.  ``df`` is counted once, here; ``first`` and ``last`` are the term's ranges
  and ``blocks`` has, for each, its postings and the largest weight (what a
  posting adds to a score, but for idf and boost).  ``head`` is the term's first
  ``HEAD`` letters.
- ``grams``: ``(gram, field, term)`` for every two letters of a term between a start
  and an end mark; a wildcard reads the terms that hold all its grams.
- ``deletes``: ``(variant, field, head)``, variants being what is left of a head after
  up to ``EDITS`` deletions.  Two terms within that many edits have heads that
  share a variant, so a fuzzy query joins its own head's deletions, and measures
  distances to the terms of the heads found.  Heads are far fewer than terms.

All are sorted Parquet, so a lookup reads few row groups; queries read postings
of resolved terms only.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import combinations, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.functions.text import analyze

RANGE = "_r"
#: Tokens counted at once, or those of one document, and postings a written row holds at most.
TOKENS = 1 << 20
CHUNK = 16
#: Marks before and after a term; no analysed term holds them.
START, END = "\x02", "\x03"
GRAM = 2
EDITS, HEAD = 2, 6

#: A row holds postings of one term: ``weight`` is the largest of theirs.
ROW_COLUMNS = ("index string, type string, field string, term string, weight double, ids array<string>, lens array<int>, "
               "tfs array<bigint>")
TERM_COLUMNS = ("index string, type string, field string, term string, df bigint, first int, last int, "
                f"blocks array<struct<{RANGE}:int,n:bigint,weight:double>>, head string")


def weight() -> Column:
    """What a posting adds to a score, but for idf and boost."""
    return F.sqrt(F.col("tf")) / F.sqrt(F.col("doc_len"))


def _prefix(words: pa.Array) -> np.ndarray:
    """The first eight bytes of each string as a number, in the strings' order."""
    words = words.cast(pa.large_string())
    starts = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.concatenate([np.frombuffer(words.buffers()[2] or b"", np.uint8), np.zeros(8, np.uint8)])
    out = np.zeros(len(words), np.uint64)
    for k in range(8):
        at = starts[:-1] + k
        out |= np.where(at < starts[1:], data[np.minimum(at, len(data) - 1)], 0).astype(np.uint64) << np.uint64(56 - 8 * k)
    return (out ^ np.uint64(1 << 63)).view(np.int64)


def count_terms(docs: DataFrame, keys: list[str], fields: tuple[str, ...], unique: bool, chunk: int = CHUNK) -> DataFrame:
    """Postings in rows of ``ROW_COLUMNS`` (and ``_p``, the term's first eight bytes as a number).

    Terms are counted where their documents lie.  What a stretch of documents
    has of a term leaves in rows of up to ``chunk`` postings, heaviest first.
    Documents of one key and length are counted together; ``unique`` says that
    no key comes twice.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            lengths = pc.fill_null(pc.list_value_length(whole.column("_toks")), 0).to_numpy().astype(np.int64)
            cuts = np.flatnonzero(np.diff(np.cumsum(lengths) // TOKENS)) + 1
            for a, b in pairwise([0, *cuts.tolist(), len(lengths)]):
                part, n = whole.slice(a, b - a), lengths[a:b]
                words = part.column("_toks").flatten().dictionary_encode()
                if len(words):
                    yield rows(part, n, words.dictionary, words.indices.to_numpy().astype(np.int64))

    def rows(part: pa.RecordBatch, n: np.ndarray, words: pa.Array, codes: np.ndarray) -> pa.RecordBatch:
        size = len(words)
        found, tf = np.unique(np.repeat(np.arange(len(n)), n) * size + codes, return_counts=True)
        doc, code = found // size, found % size
        # a row is of one index, type and field
        kind = np.zeros(len(n), np.int64)
        for column in ("index", "type", "field"):
            named = part.column(column).dictionary_encode(null_encoding="encode")
            kind = kind * len(named.dictionary) + named.indices.to_numpy()
        group = kind[doc] * size + code
        doc_len = pc.fill_null(part.column("doc_len"), 0).to_numpy()[doc]
        heavy = np.sqrt(tf) / np.sqrt(doc_len)
        order = np.lexsort((-heavy, group))
        doc, code, tf, doc_len, heavy, group = (x[order] for x in (doc, code, tf, doc_len, heavy, group))
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        place = np.arange(len(group)) - np.repeat(first, np.diff(np.append(first, len(group))))
        starts = np.flatnonzero(place % chunk == 0)
        ends = pa.array(np.append(starts, len(group)).astype(np.int32))
        at, code = pa.array(doc[starts]), code[starts]
        return pa.RecordBatch.from_arrays([
            part.column("index").take(at), part.column("type").take(at), part.column("field").take(at),
            words.take(pa.array(code)), pa.array(heavy[starts]),
            *(pa.ListArray.from_arrays(ends, x) for x in (part.column("id").take(pa.array(doc)), pa.array(doc_len), pa.array(tf))),
            pa.array(_prefix(words)[code])], names=names)

    names = [c.split()[0] for c in ROW_COLUMNS.split(", ")] + ["_p"]
    tokens = reduce(DataFrame.unionByName, [
        docs.select(*keys, F.lit(f).alias("field"), analyze(F.col(f)).alias("_toks")) for f in fields])
    tokens = tokens.withColumn("doc_len", F.size("_toks"))
    if not unique:
        tokens = tokens.groupBy(*keys, "field", "doc_len").agg(F.flatten(F.collect_list("_toks")).alias("_toks"))
    return tokens.mapInArrow(run, f"{ROW_COLUMNS}, _p bigint")


def write_postings(rows: DataFrame, path: str, ranges: int) -> None:
    """The rows of ``count_terms`` dealt by (term, field, weight, document) and written, a folder a range.

    A range's rows lie in order of their term's first bytes: one number, which
    sorts without comparing rows.
    """
    dealt = rows.repartitionByRange(ranges, F.col("term"), F.col("field"), F.col("weight").desc(), F.col("ids")[0]).withColumn(
        RANGE, F.spark_partition_id()).sortWithinPartitions("_p").drop("_p")
    conf, key = rows.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(key)
    # a task writes one range: the writer needs no sort by range
    conf.set(key, "2")
    try:
        dealt.write.mode("overwrite").partitionBy(RANGE).parquet(path)
    finally:
        conf.set(key, before)


def read_rows(spark, path: str) -> DataFrame:
    """The written rows, up to ``CHUNK`` postings each."""
    return spark.read.schema(f"{ROW_COLUMNS}, {RANGE} int").parquet(path)


def read_postings(spark, path: str) -> DataFrame:
    """The written postings, one row each."""
    rows = read_rows(spark, path)
    return rows.select("index", "type", "field", "term", RANGE, F.inline(F.arrays_zip("ids", "lens", "tfs")).alias(
        "id", "doc_len", "tf")).select("index", "type", "id", "field", "doc_len", "term", "tf", RANGE)


def term_table(rows: DataFrame) -> DataFrame:
    """The dictionary of written rows; a task's terms are combined before the shuffle."""
    blocks = rows.groupBy("term", "field", "index", "type", RANGE).agg(
        F.sum(F.size("ids").cast("bigint")).alias("n"), F.max("weight").alias("weight"))
    return blocks.groupBy("term", "field", "index", "type").agg(
        F.sum("n").alias("df"), F.min(RANGE).alias("first"), F.max(RANGE).alias("last"),
        F.array_sort(F.collect_list(F.struct(RANGE, "n", "weight"))).alias("blocks")).withColumn(   # at most one a range
        "head", F.substring("term", 1, HEAD))


def grams_of(terms: DataFrame) -> DataFrame:
    """``gram, field, term, _p``: the distinct grams of the marked terms; ``_p`` is the gram as a number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marked = pc.binary_join_element_wise(START, batch.column("term"), END, "")
            lengths = pc.utf8_length(marked).to_numpy()
            at = [np.flatnonzero(lengths >= i + GRAM) for i in range(int(lengths.max(initial=0)) - GRAM + 1)]
            if not at:
                continue
            grams = pa.concat_arrays([pc.utf8_slice_codeunits(marked.take(pa.array(rows)), i, i + GRAM)
                                      for i, rows in enumerate(at)]).dictionary_encode()
            size = len(grams.dictionary)
            found = np.unique(np.concatenate(at) * size + grams.indices.to_numpy())
            row, code = pa.array(found // size), found % size
            yield pa.RecordBatch.from_arrays(
                [grams.dictionary.take(pa.array(code)), batch.column("field").take(row), batch.column("term").take(row),
                 pa.array(_prefix(grams.dictionary)[code])], names=["gram", "field", "term", "_p"])

    return terms.select("field", "term").mapInArrow(run, "gram string, field string, term string, _p bigint")


def pattern_grams(pattern: str) -> list[str]:
    """The grams that every term matching a wildcard pattern holds: those of its runs of letters."""
    runs = [""]
    for ch in f"{START}{pattern}{END}":
        if ch in "*?":
            runs.append("")
        else:
            runs[-1] += ch
    return sorted({run[i:i + GRAM] for run in runs for i in range(len(run) - GRAM + 1)})


def deletions_of(head: Column) -> Column:
    """What up to ``EDITS`` deletions leave of a head."""
    def shorter(word: Column) -> Column:
        # every word with one letter less; of an empty word, itself
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(word), F.lit(1))),
                           lambda i: F.concat(F.substring(word, F.lit(1), i - 1),
                                              F.substring(word, i + 1, F.lit(HEAD))))

    layer, layers = F.array(head), [F.array(head)]
    for _ in range(EDITS):
        layer = F.array_distinct(F.flatten(F.transform(layer, shorter)))
        layers.append(layer)
    return F.array_distinct(F.concat(*layers))


def deletions(value: str) -> list[str]:
    """What up to ``EDITS`` deletions leave of a query's head."""
    head = value[:HEAD]
    return sorted({"".join(head[i] for i in kept) for gone in range(min(EDITS, len(head)) + 1)
                   for kept in combinations(range(len(head)), len(head) - gone)})


def write_terms(rows: DataFrame, path: str, files: int) -> None:
    """The dictionary of written rows, and the gram and deletion indexes over it (written side by side)."""
    spark = rows.sparkSession
    term_table(rows).repartitionByRange(files, "term", "field").sortWithinPartitions("term", "field").write.mode(
        "overwrite").parquet(f"{path}/terms")
    terms = spark.read.schema(TERM_COLUMNS).parquet(f"{path}/terms")

    def grams() -> None:
        # a gram of very many terms is dealt by its terms too
        grams_of(terms.select("field", "term").distinct()).repartition(files, "gram", "term").sortWithinPartitions("_p") \
            .drop("_p").write.mode("overwrite").parquet(f"{path}/grams")

    def deletes() -> None:
        terms.select("field", "head").distinct().select(F.explode(deletions_of(F.col("head"))).alias("variant"), "field", "head") \
            .repartition(files, "variant").sortWithinPartitions("variant").write.mode("overwrite").parquet(f"{path}/deletes")

    with ThreadPoolExecutor(2) as pool:
        for job in [pool.submit(grams), pool.submit(deletes)]:
            job.result()


class TermIndex:
    """The dictionary with its gram and deletion indexes, read from ``path``."""

    def __init__(self, spark, path: str):
        self.terms = spark.read.schema(TERM_COLUMNS).parquet(f"{path}/terms")
        self.grams = spark.read.schema("gram string, field string, term string").parquet(f"{path}/grams")
        self.deletes = spark.read.schema("variant string, field string, head string").parquet(f"{path}/deletes")

    def restricted(self, cond: Column) -> TermIndex:
        """Only the rows of some indices or types; grams and deletions name terms of all."""
        out = object.__new__(TermIndex)
        out.terms, out.grams, out.deletes = self.terms.where(cond), self.grams, self.deletes
        return out

    def exact(self, field: str, values: list[str]) -> DataFrame:
        return self._of(field).where(F.col("term").isin(values))

    def prefixed(self, field: str, prefix: str) -> DataFrame:
        return self._of(field).where(F.col("term").startswith(prefix))

    def like(self, field: str, pattern: str, like: str) -> DataFrame:
        """Terms that match a wildcard: those with all its grams, then the pattern itself."""
        grams, found = pattern_grams(pattern), self._of(field).where(F.col("term").like(like))
        if not grams:               # nothing but wildcards
            return found
        held = self.grams.where((F.col("field") == field) & F.col("gram").isin(grams)).groupBy("term").agg(
            F.count(F.lit(1)).alias("_n")).where(F.col("_n") == len(grams)).select("term")
        return found.join(held, "term", "left_semi")

    def near(self, field: str, value: str, edits: int, prefix: str = "") -> DataFrame:
        """Terms within ``edits`` of ``value``: distances are taken of terms whose heads share a deletion only.

        Beyond the indexed number of edits the dictionary is compared whole.
        """
        close = F.levenshtein(F.col("term"), F.lit(value), edits) >= 0
        near = self._of(field).where(close)
        if edits <= EDITS:
            heads = self.deletes.where(F.col("variant").isin(deletions(value)) & (F.col("field") == field)).select(
                "head").distinct()
            near = self._of(field).join(heads, "head", "left_semi").where(close)
        return near.where(F.col("term").startswith(prefix)) if prefix else near

    def _of(self, field: str) -> DataFrame:
        return self.terms.where(F.col("field") == field)
