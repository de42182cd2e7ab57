"""License scans: exact set-similarity join of text blocks with license templates, in DataFrame operations only.

A block is a line of a document that is no longer than a run, or a run of
words; its set and a template's set are their distinct words.  A block matches
a template when it holds at least ``THRESHOLD`` of the template's words.  A run
reaches as far to both sides of a template's rare word as the template is
long, and ``SLACK`` of that for words that wrapped lines add (comment marks such
as ``dnl``), so a notice is found wherever its lines are broken, and words that
lie scattered over a long line are none.  The join is exact:

- the templates' words are ordered by how many blocks of the corpus hold them,
  rarest first (ties by word);
- prefix filter: a match misses at most ``size - needed`` words of the
  template, so it holds one of the first ``size - needed + 1``; only those
  words are joined;
- length filter: the block has at least ``needed`` words of its own;
- positional filter: the first shared word, at place p of the template's
  order, leaves at most ``size - p`` shared words;
- surviving pairs are verified on the full sets.

Beside the join, phrases are found wherever their words stand consecutively.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.llm.common import written

#: label -> phrase; a place is where the phrase's words stand one after another.
PHRASES = {
    "apache": "apache license",
    "cc-by": "cc by",
    "gpl": "gnu general public license",
    "mit": "mit license",
}
#: (label, notice): one-line notices as projects usually print them.
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("gpl-2.0", "licensed under the gnu general public license version 2"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl-3.0", "licensed under the gnu affero general public license version 3"),
    ("mit", "released under the mit license"),
    ("bsd", "distributed under the bsd license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
#: (label, notice): license texts and source headers, which usually stand wrapped over several lines.
HEADERS = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("lgpl", "is free software you can redistribute it and or modify it under the terms of the gnu lesser general "
             "public license as published by the free software foundation"),
    ("agpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero "
             "general public license as published by the free software foundation"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the "
                   "license at http www apache org licenses license 2 0"),
    ("mpl-2.0", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("boost-1.0", "distributed under the boost software license version 1 0"),
]
#: Share of a template's distinct words that a block must hold.
THRESHOLD = 0.92
#: How much longer than its template a run of words reaches, as a share.
SLACK = 0.125

# words after lower-casing A-Z: runs of digits, letters and anything beyond ASCII
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased."""
    return F.filter(F.split(F.translate(text, _UPPER, _LOWER), _BREAK), lambda w: w != "")


def _template_rows(spark: SparkSession, templates: list[tuple[str, str]], threshold: float) -> DataFrame:
    rows = []
    for number, (label, notice) in enumerate(templates):
        distinct = sorted(set(notice.split()))
        rows.append((number, label, distinct, len(distinct), math.ceil(threshold * len(distinct) - 1e-9),
                     _reach(notice)))
    return spark.createDataFrame(
        rows, "template int, label string, t_words array<string>, t_size int, needed int, reach int")


def _reach(notice: str) -> int:
    return math.ceil(len(notice.split()) * (1 + SLACK))


def template_matches(docs: DataFrame, id_col: str, text_col: str, templates=(*TEMPLATES, *HEADERS),
                     threshold: float = THRESHOLD) -> DataFrame:
    """(id, text hash, label, containment) of every document and template that one of its blocks matches."""
    spark = docs.sparkSession
    template_rows = _template_rows(spark, templates, threshold)
    known = sorted({w for _, notice in templates for w in notice.split()})   # the templates' words: fixed, few
    blocks = docs.select(F.col(id_col).alias("d_id"), F.xxhash64(text_col).alias("d_hash"),
                         F.explode(F.split(text_col, "\n")).alias("block"))
    # a block without any template word of all but the commonest matters to no count that orders rare words,
    # yet counts cover all blocks: every word of every block is compared with the templates' words
    lowered = F.lower("block")
    counts = blocks.select(F.explode(F.array_distinct(F.filter(
        F.split(lowered, _BREAK), lambda w: w.isin(known)))).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    order = spark.createDataFrame([(w,) for w in known], "word string").join(counts, "word", "left").select(
        "word", F.coalesce("df", F.lit(0)).alias("df"))
    ranked = template_rows.select("template", "t_size", "needed", F.explode("t_words").alias("word")).join(
        order, "word").groupBy("template", "t_size", "needed").agg(
        F.sort_array(F.collect_list(F.struct("df", "word"))).alias("ordered"))
    prefix = written(ranked.select(
        "template", F.posexplode(F.slice("ordered", 1, F.col("t_size") - F.col("needed") + 1))).select(
        "template", F.col("pos").alias("place"), F.col("col.word").alias("word")), "license-prefix")
    # rows of the prefix: at most the words of all templates, so its size is fixed by the parameter
    heads = [r["word"] for r in prefix.select("word").distinct().collect()]
    held = (blocks.where(F.size(F.filter(F.split(lowered, _BREAK), lambda w: w.isin(heads))) > 0)
            .withColumn("all", words(F.col("block"))).withColumn("b_len", F.size("all"))
            .withColumn("b_words", F.array_distinct("all")).drop("block", "all"))
    pairs = held.select("d_id", "d_hash", "b_words", "b_len", F.explode("b_words").alias("word")).join(
        F.broadcast(prefix), "word").groupBy("d_id", "d_hash", "b_words", "b_len", "template").agg(
        F.min("place").alias("first"))
    lines = pairs.join(F.broadcast(template_rows), "template").where(F.col("b_len") <= F.col("reach"))
    # what lies within a short line is found there; runs are cut around each rare word from texts of several lines
    # and from long lines
    reaches = [_reach(notice) for _, notice in templates] or [1]
    most = max(reaches)
    every = docs.select(F.col(id_col).alias("d_id"), F.xxhash64(text_col).alias("d_hash"),
                        (F.instr(text_col, "\n") > 0).alias("broken"), words(F.col(text_col)).alias("all_words"))
    wrapped = every.where((F.size("all_words") > 0) & (F.col("broken") | (F.size("all_words") > min(reaches))))
    rare = F.filter(F.sequence(F.lit(0), F.size("all_words") - 1),
                    lambda i: F.get(F.col("all_words"), i).isin(heads))
    near = wrapped.select("d_id", "d_hash", "all_words", F.explode(rare).alias("at")).withColumn(
        "word", F.get("all_words", F.col("at"))).withColumn(
        "from", F.greatest(F.lit(0), F.col("at") - most + 1)).select(
        "d_id", "d_hash", "word", (F.col("at") - F.col("from")).alias("at"),
        F.slice("all_words", F.col("from") + 1, F.lit(2 * most - 1)).alias("near"))
    start = F.greatest(F.lit(0), F.col("at") - F.col("reach") + 1)
    runs = near.join(F.broadcast(prefix), "word").join(F.broadcast(template_rows), "template").withColumn(
        "b_words", F.array_distinct(F.slice("near", start + 1, F.col("at") - start + F.col("reach")))).withColumnRenamed(
        "place", "first")
    columns = ["d_id", "d_hash", "b_words", "first", "label", "t_words", "t_size", "needed"]
    surviving = lines.select(*columns).unionByName(runs.select(*columns)).where(
        (F.size("b_words") >= F.col("needed")) & (F.col("t_size") - F.col("first") >= F.col("needed")))
    shared = F.size(F.array_intersect("b_words", "t_words"))
    return surviving.withColumn("shared", shared).where("shared >= needed").groupBy("d_id", "d_hash", "label").agg(
        F.max(F.col("shared") / F.col("t_size")).alias("containment"))


def phrase_places(list_of_words: Column, phrase: str) -> Column:
    """Array of the places (from 0) where the phrase's words stand consecutively."""
    parts = phrase.split()
    last = F.size(list_of_words) - len(parts)

    def stands(i: Column) -> Column:
        cond = F.lit(True)
        for k, part in enumerate(parts):
            cond = cond & (F.get(list_of_words, i + k) == part)
        return cond

    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), last), stands)).otherwise(
        F.array().cast("array<int>"))


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=(*TEMPLATES, *HEADERS),
                   threshold: float = THRESHOLD) -> DataFrame:
    """Phrases and template matches of every whole text, one row per row of ``docs``.

    ``n_words``, ``n_base`` (places of all phrases), ``first_word`` and
    ``last_word`` (smallest and largest start, null without a place),
    ``base_labels``, ``labels`` (templates' labels too; both distinct, sorted,
    comma-joined, empty string for none) and ``score`` (1 with a phrase, else
    the best containment, else 0).  Null text counts as empty; null ids and
    repeated rows are kept; an empty table gives no row; other columns are
    not read.
    """
    whole = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # every phrase holds one of these, so the words of other texts need no list
    maybe = F.col("text").rlike(r"(?i)license|cc[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+by")
    listed = F.when(maybe, words(F.col("text"))).otherwise(F.array().cast("array<string>"))
    base = whole.select("id", F.xxhash64("text").alias("hash"),
                        F.regexp_count("text", F.lit(_WORD_ANY_CASE)).cast("long").alias("n_words"),
                        listed.alias("listed"))
    places = [phrase_places(F.col("listed"), p) for p in PHRASES.values()]
    base = base.withColumns({f"p{k}": p for k, p in enumerate(places)}).withColumn(
        "places", F.concat(*[f"p{k}" for k in range(len(places))]))
    found = F.filter(F.array(*[F.when(F.size(f"p{k}") > 0, F.lit(label)) for k, label in enumerate(PHRASES)]),
                     lambda x: x.isNotNull())
    base = base.select("id", "hash", "n_words", F.size("places").cast("long").alias("n_base"),
                       F.array_min("places").cast("long").alias("first_word"),
                       F.array_max("places").cast("long").alias("last_word"), found.alias("base"))
    matches = template_matches(whole, "id", "text", templates, threshold)
    more = matches.groupBy(F.col("d_id"), F.col("d_hash")).agg(
        F.collect_set("label").alias("more"), F.max("containment").alias("containment"))   # at most one per label
    joined = base.join(more, F.col("id").eqNullSafe(F.col("d_id")) & (F.col("hash") == F.col("d_hash")), "left")
    every = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    return joined.select(
        F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"))
