"""Quality classifier: document evidence combined with hierarchical empirical Bayes site posteriors.

1. A logistic classifier per label (good quality, toxic) gives each document's
   evidence.  It is fitted on at most ``SAMPLE`` labelled rows, chosen by a
   hash of their id: the words and word beginnings that tell the classes apart
   are selected by grouped counts, the weights by ridge regression.
2. Every document of the corpus votes for its sites: sums of its probabilities
   by host and by path (``levels``, ``source`` and ``lang`` of documents).
3. The spread of the hosts' rates around the corpus rate, and of the paths'
   rates around their hosts', gives the strength of the priors (method of
   moments).  A path's posterior shrinks towards its host's, a host's towards
   the corpus rate; sparse sites shrink most.
4. A document's posterior log odds are its evidence plus the log odds by which
   its path's posterior, without the document's own vote, differs from the
   corpus rate.

Sums are kept in millionths, as integers, so reruns agree to the last bit.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import fresh, same, written

#: Labelled rows the classifiers are fitted on, at most.
SAMPLE = 8192
#: Words and word beginnings chosen for each label, and the documents one must occur in.
CHOSEN = 192
RAREST = 5
#: Ridge penalty of the weights.
RIDGE = 1.0
#: A document goes when its chance of good quality is below, or of toxicity not below, this.
CUT = 0.5
#: Sites up to this many are broadcast (some 100 bytes each); more are joined by a shuffle.
BROADCAST_SITES = 50_000
MILLION = 1_000_000
PREFIX = 4

_LETTERS = re.compile(r"[^\W\d_]+")
_NOISE = re.compile(r"[^\w\s.,;:'\"?()-]")
N_SHAPES = 10


def shapes(text: str) -> list[float]:
    """Ten rates that do not depend on the words themselves, each about 0 to 1."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * N_SHAPES
    lines = text.split("\n")
    chars = len(text)
    noise = len(_NOISE.findall(text))
    return [
        sum(map(str.isupper, words)) / n,
        min(1.0, noise / n / 3),
        1 - len(set(words)) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        noise / chars,
        sum(map(str.isdigit, words)) / n,
        min(1.0, chars / n / 20),
        min(1.0, math.log1p(n) / 10),
        min(1.0, text.count("|") / n),
        1 - len(set(lines)) / len(lines),
    ]


def features(text: str) -> set[str]:
    """Distinct words and word beginnings (marked by a tilde), lower-cased."""
    words = set(_LETTERS.findall(text.lower()))
    return words | {f"{w[:PREFIX]}~" for w in words if len(w) > PREFIX}


@dataclass(frozen=True)
class Model:
    """Chosen features with their weights for (quality, toxic), shape weights and intercepts."""

    weights: dict[str, tuple[float, float]]
    shape_weights: tuple[tuple[float, ...], tuple[float, ...]]
    intercepts: tuple[float, float]

    def chances(self, text: str | None) -> tuple[float, float]:
        """Chances of good quality and of toxicity; null counts as empty."""
        text = text or ""
        found = self.weights.keys() & features(text)
        rates = shapes(text)
        out = []
        for head in (0, 1):
            odds = self.intercepts[head] + sum(r * w for r, w in zip(rates, self.shape_weights[head], strict=True))
            odds += math.fsum(self.weights[f][head] for f in found)
            out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
        return out[0], out[1]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Weights (intercept first) of a ridge logistic regression, by Newton steps."""
    design = np.hstack([np.ones((len(x), 1)), x])
    penalty = np.full(design.shape[1], ridge)
    penalty[0] = 1e-6
    w = np.zeros(design.shape[1])
    rate = min(max(y.mean(), 1e-3), 1 - 1e-3)
    w[0] = math.log(rate / (1 - rate))
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (p - y) + penalty * w
        curve = (design * (p * (1 - p))[:, None]).T @ design + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        quality_col: str = "quality", toxic_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """Fits both classifiers on at most ``sample`` labelled rows.

    Rows without id, label or document play no part; of several labels for
    one id the smallest counts, of several documents each.  Without any
    labelled document, or with one class only, a label's chance is its rate
    (0.5 without rows).
    """
    chosen = labels.select(F.col(id_col).alias("l_id"), F.col(quality_col).cast("int").alias("quality"),
                           F.col(toxic_col).cast("int").alias("toxic")).dropna().groupBy("l_id").agg(
        F.min(F.struct("quality", "toxic")).alias("label")).orderBy(F.xxhash64("l_id"), "l_id").limit(sample)

    @F.pandas_udf("struct<words:array<string>,rates:array<double>>")
    def featurize(column: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"words": [sorted(features(t or "")) for t in column],
                             "rates": [shapes(t or "") for t in column]})

    rows = written(
        docs.select(F.col(id_col).alias("d_id"), F.col(text_col).alias("text")).join(
            F.broadcast(chosen), F.col("d_id") == F.col("l_id")).select(     # at most ``sample`` rows of three numbers
            "d_id", "label.quality", "label.toxic", featurize("text").alias("f")), "quality-sample")
    totals = rows.agg(F.count("*").alias("n"), F.sum("quality").alias("good"), F.sum("toxic").alias("toxic")).first()
    n = totals["n"]
    counts = rows.select("quality", "toxic", F.explode("f.words").alias("word")).groupBy("word").agg(
        F.count("*").alias("df"), F.sum("quality").alias("good"), F.sum("toxic").alias("toxic")).where(
        F.col("df") >= RAREST)
    words: list[str] = []
    for label, total in (("good", totals["good"] or 0), ("toxic", totals["toxic"] or 0)):
        rate = total / n if n else 0.0
        if not 0 < rate < 1:
            continue
        score = F.abs(F.col(label) - F.col("df") * rate) / F.sqrt(F.col("df") * rate * (1 - rate))
        words += [r["word"] for r in counts.orderBy(score.desc(), "word").limit(CHOSEN).collect()]
    words = sorted(set(words))
    place = {w: i for i, w in enumerate(words)}
    held = rows.select("quality", "toxic", "f.rates", F.filter("f.words", lambda w: w.isin(words)).alias("words")
                       if words else F.array().cast("array<string>").alias("words"), "d_id").orderBy(
        "d_id", F.xxhash64("rates")).collect()        # bounded by ``sample`` rows and the chosen words
    x = np.zeros((len(held), len(words) + N_SHAPES))
    for i, row in enumerate(held):
        x[i, [place[w] for w in row["words"]]] = 1
        x[i, len(words):] = row["rates"]
    heads = []
    for label in ("quality", "toxic"):
        y = np.array([r[label] for r in held], float)
        if len(y) and 0 < y.mean() < 1:
            heads.append(_logistic(x, y))
        else:
            w = np.zeros(x.shape[1] + 1)
            rate = min(max(y.mean(), 1e-3), 1 - 1e-3) if len(y) else 0.5
            w[0] = math.log(rate / (1 - rate))
            heads.append(w)
    k = len(words)
    return Model({w: (float(heads[0][1 + i]), float(heads[1][1 + i])) for w, i in place.items()},
                 tuple(tuple(h[1 + k:].tolist()) for h in heads), tuple(float(h[0]) for h in heads))


# -- hierarchical empirical Bayes ----------------------------------------------------

def _strength(groups: DataFrame, mean: Column, n: str, total: str, within: float) -> float:
    """Prior strength in documents: variance of one document's chance over that of the groups' rates."""
    rate = F.col(total) / F.col(n) / MILLION
    row = groups.agg(
        F.sum(F.col(n)).alias("docs"), F.sum((F.col(n) * F.col(n)).cast("double")).alias("squares"),
        F.sum(F.col(n) * (rate - mean) * (rate - mean)).alias("spread"), F.count("*").alias("groups")).first()
    if not row["docs"]:
        return 1.0
    room = row["docs"] - row["squares"] / row["docs"]
    between = (row["spread"] - (row["groups"] - 1) * within) / room if room > 0 else 0.0
    return float(min(1e9, max(1.0, within / between))) if between > 0 else 1e9


def posteriors(scored: DataFrame, levels: tuple[str, str], names: tuple[str, str] = ("quality", "toxic")) -> DataFrame:
    """Per site (host, path): document count, summed chances and what a document's posterior needs.

    ``scored`` holds the chances ``names`` as integers in millionths.  Columns
    returned: the levels, and per name ``_prior`` (corpus rate), ``_host``
    (prior weight and sums of the host) and ``_path``.
    """
    host, path = levels
    square = [F.sum((F.col(c) * F.col(c)).cast("double")).alias(f"{c}_sq") for c in names]
    sites = written(scored.groupBy(host, path).agg(
        F.count("*").alias("n_path"), *[F.sum(c).alias(f"{c}_path") for c in names], *square), "quality-sites")
    h, *_ = fresh(sites.columns, "h_host")
    hosts = sites.groupBy(F.col(host).alias(h)).agg(
        F.sum("n_path").alias("n_host"), *[F.sum(f"{c}_path").alias(f"{c}_host") for c in names])
    both = written(sites.join(hosts, F.col(host).eqNullSafe(F.col(h))).drop(h), "quality-hosts")
    hosts = both.select(host, "n_host", *[f"{c}_host" for c in names]).distinct()
    corpus = sites.agg(F.sum("n_path").alias("n"), *[F.sum(f"{c}_path").alias(c) for c in names],
                       *[F.sum(f"{c}_sq").alias(f"{c}_sq") for c in names]).first()
    out = both
    for c in names:
        n = corpus["n"] or 1
        rate = (corpus[c] or 0) / n / MILLION
        within = max(1e-9, (corpus[f"{c}_sq"] or 0.0) / n / MILLION ** 2 - rate * rate)
        host_strength = _strength(hosts, F.lit(rate), "n_host", f"{c}_host", within)
        host_rate = F.col(f"{c}_host") / F.col("n_host") / MILLION
        path_strength = _strength(both, host_rate, "n_path", f"{c}_path", within)
        out = out.withColumn(f"{c}_prior", F.lit(rate)).withColumn(f"{c}_host_strength", F.lit(host_strength)) \
                 .withColumn(f"{c}_path_strength", F.lit(path_strength)).drop(f"{c}_sq")
    return out


def _logit(p: Column) -> Column:
    kept = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.log(kept / (1 - kept))


def combined(chance: Column, name: str) -> Column:
    """Posterior chance of a document from its evidence and its site's posterior without its own vote."""
    c = {k: F.col(f"{name}_{k}") for k in ("prior", "host", "path", "host_strength", "path_strength")}
    own = chance / MILLION
    host = (c["host_strength"] * c["prior"] + c["host"] / MILLION - own) / (c["host_strength"] + F.col("n_host") - 1)
    path = (c["path_strength"] * host + c["path"] / MILLION - own) / (c["path_strength"] + F.col("n_path") - 1)
    return 1 / (1 + F.exp(-(_logit(own) + _logit(path) - _logit(c["prior"]))))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             levels: tuple[str, str] = ("source", "lang"), keep_text: bool = True, sample: int = SAMPLE
             ) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with each document's chances, evidence and verdict; and the names of those columns.

    Added: ``quality`` and ``toxic`` (posterior chances), ``quality_evidence``
    and ``toxic_evidence`` (the classifier's own) and ``keep``; a name that
    ``docs`` already has gets an underscore in front (the returned mapping
    tells).  Null sites are sites of their own; null and empty texts are
    judged as empty texts; repeated rows are judged alike and all stay; an
    empty table stays empty.  With ``keep_text`` false the text is dropped.
    """
    model = fit(docs, labels, id_col, text_col, sample=sample)

    @F.pandas_udf("struct<quality:long,toxic:long>")
    def evidence(column: pd.Series) -> pd.DataFrame:
        chances = [model.chances(t) for t in column]
        return pd.DataFrame({"quality": [round(q * MILLION) for q, _ in chances],
                             "toxic": [round(t * MILLION) for _, t in chances]}, columns=["quality", "toxic"])

    names = ("quality", "toxic", "quality_evidence", "toxic_evidence", "keep")
    added = dict(zip(names, fresh(docs.columns, *names), strict=True))
    # whatever docs calls its columns, work on numbered names
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    scored = plain.withColumn("e", evidence(F.col(at[text_col]))).withColumn("quality", F.col("e.quality")).withColumn(
        "toxic", F.col("e.toxic")).drop("e")
    if not keep_text:
        scored = scored.drop(at[text_col])
    scored = written(scored, "quality-scored")
    host, path = (at[c] for c in levels)
    sites = posteriors(scored, (host, path))
    sites = written(sites.withColumnRenamed(host, "s_host").withColumnRenamed(path, "s_path"), "quality-posteriors")
    if sites.count() <= BROADCAST_SITES:
        sites = F.broadcast(sites)
    joined = scored.join(sites, same([F.col(host), F.col(path)], [F.col("s_host"), F.col("s_path")]))
    good, toxic = combined(F.col("quality"), "quality"), combined(F.col("toxic"), "toxic")
    kept = [c for c in docs.columns if keep_text or c != text_col]
    out = joined.withColumn("p_good", F.round(good, 6)).withColumn("p_toxic", F.round(toxic, 6)).select(
        *[F.col(at[c]).alias(c) for c in kept],
        F.col("p_good").alias(added["quality"]), F.col("p_toxic").alias(added["toxic"]),
        (F.col("quality") / MILLION).alias(added["quality_evidence"]),
        (F.col("toxic") / MILLION).alias(added["toxic_evidence"]),
        ((F.col("p_good") >= CUT) & (F.col("p_toxic") < CUT)).alias(added["keep"]))
    return out, added
