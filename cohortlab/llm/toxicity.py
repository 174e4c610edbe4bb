"""Toxicity: a logistic classifier over word features whose scores are tied
across counterfactuals.

Features are the presence of words and of word beginnings (inflected forms
share them).  The most telling ones are chosen from document counts by label.
A labelled sentence that names a group is paired with the same sentence for
every other group of its axis, and a sentence that names none with the same
sentence after a group is put in.  The loss adds the squared difference of the two scores
(logits), so what a group is called can't carry the label, and neutral mentions
are not held against a text.  Scores are sums over features, so of a pair only
the features count that one side has and the other lacks: pairs with the same
difference are one row with their number, and all of them take part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.common import hide, prepare, saved, show

#: Terms that may be swapped for one another, by axis; for other languages or
#: terms the caller passes axes of their own.
IDENTITY_TERMS = {
    "gender": ("women", "men", "woman", "man", "girls", "boys", "female", "male", "transgender"),
    "religion": ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    "origin": ("immigrants", "refugees", "foreigners", "natives", "africans", "asians", "europeans", "americans", "mexicans", "african", "asian", "european", "american", "mexican"),
    "colour": ("black", "white", "brown"),
    "orientation": ("gay", "lesbian", "straight", "bisexual", "homosexual", "heterosexual"),
    "ability": ("disabled", "blind", "deaf", "able-bodied"),
    "age": ("old", "young", "elderly"),
}
WORD = re.compile(r"\w+(?:-\w+)*")
SENTENCE = re.compile(r"[.!?\n]+")
STEMS = (3, 5, 7)  # letters of a word's beginnings
MIN_GAIN = 3.5  # standard errors by which a feature's share of positives must differ from the base rate
MAX_LABELLED = 20_000  # labelled rows that a fit uses at most
MAX_FEATURES = 1024
MIN_DOCS = 4
TIE = 5.0  # weight of the squared score change of pairs
THRESHOLD = 0.3


def text_features(text: str | None) -> set[str]:
    """Words (lower-case) and, marked with ``^``, the beginnings of longer words."""
    return word_features(WORD.findall(text.lower())) if text else set()


def word_features(words: Iterable[str]) -> set[str]:
    found = set(words)
    return found | {"^" + w[:n] for n in STEMS for w in found if len(w) > n}


@cache
def _term_features(term: str) -> frozenset[str]:
    return frozenset(text_features(term))


def counterfactuals(sentence: str, axes: dict[str, tuple[str, ...]]) -> list[tuple[frozenset[str], frozenset[str]]]:
    """(features lost, features won) when a group term of the sentence becomes
    another of its axis, for every term in it and every other term of the axis;
    of a sentence without a term, when a term is put in, for every term of the
    axis that a hash of the sentence names.  No words give no pairs."""
    found = set(WORD.findall(sentence.lower()))
    of = {term: terms for terms in axes.values() for term in terms if term in found}
    swaps = [(term, other) for term in sorted(of) for other in of[term] if other != term]
    if found and axes and not of:
        h = zlib.crc32(" ".join(sorted(found)).encode("utf-8", "replace"))
        swaps = [("", other) for other in [*axes.values()][h % len(axes)]]
    out = []
    rest = {term: word_features(found - {term}) for term, _ in swaps}
    for term, other in swaps:
        before, after = _term_features(term), _term_features(other)
        out.append((frozenset(before - after - rest[term]), frozenset(after - before - rest[term])))
    return out


@dataclass(frozen=True)
class ToxicityModel:
    """Feature weights; at most ``MAX_FEATURES`` and the group terms."""

    weights: dict[str, float]
    bias: float

    def logit(self, text: str | None) -> float:
        w = self.weights
        return self.bias + sum(w[f] for f in text_features(text) if f in w)

    def score(self, text: str | None) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.logit(text), -30, 30))))


def fit_weights(rows: list[list[int]], labels: np.ndarray, pairs: list[tuple[list[int], list[int]]], n: int, tie: float = TIE, ridge: float = 3e-5, steps: int = 500, positive: float = 1.0, times: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Gradient descent (Adam, fixed start, so reruns agree) on the mean
    logistic loss (positive rows count ``positive`` times) + ridge * |w|^2 +
    tie * mean squared score change of pairs, each counted ``times`` times."""
    flat = np.fromiter((f for r in rows for f in r), np.int64)
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    plus = np.fromiter((f for p, _ in pairs for f in p), np.int64)
    minus = np.fromiter((f for _, m in pairs for f in m), np.int64)
    at_plus = np.repeat(np.arange(len(pairs)), [len(p) for p, _ in pairs]) if pairs else plus
    at_minus = np.repeat(np.arange(len(pairs)), [len(m) for _, m in pairs]) if pairs else minus
    often = np.ones(len(pairs)) if times is None else np.asarray(times, float)
    share = np.where(labels > 0.5, positive, 1.0) / max(1.0, np.where(labels > 0.5, positive, 1.0).sum())
    w, bias = np.zeros(n), 0.0
    m1, m2 = np.zeros(n + 1), np.zeros(n + 1)
    for t in range(1, steps + 1):
        z = bias + np.bincount(at, w[flat], len(rows))
        err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) * share
        g = np.bincount(flat, err[at], n) + 2 * ridge * w
        if pairs:
            change = np.bincount(at_plus, w[plus], len(pairs)) - np.bincount(at_minus, w[minus], len(pairs))
            change *= often
            g += 2 * tie / often.sum() * (np.bincount(plus, change[at_plus], n) - np.bincount(minus, change[at_minus], n))
        g = np.append(g, err.sum())
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        step = 0.1 * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-8)
        w, bias = w - step[:-1], bias - step[-1]
    return w, float(bias)


def labelled_texts(docs: DataFrame, labels: DataFrame, label_col: str, usable: Column, max_rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, label) of at most ``max_rows`` labelled rows for which ``usable``
    (a condition on the id) holds, chosen by a hash of the id.  Only the
    chosen ids, whose number is bounded by ``max_rows``, are broadcast."""
    chosen = labels.filter(usable & F.col(label_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).cast("int").alias("label"))
    chosen = chosen.orderBy(F.xxhash64(id_col), id_col).limit(max_rows)
    return docs.select(id_col, F.col(text_col).alias("text")).join(F.broadcast(chosen), id_col).select("text", "label")


def fit(docs: DataFrame, labels: DataFrame, usable: Column, label_col: str = "toxic", max_labelled: int = MAX_LABELLED, max_features: int = MAX_FEATURES, id_col: str = "doc_id", text_col: str = "text", terms: dict[str, tuple[str, ...]] = IDENTITY_TERMS, tie: float = TIE) -> ToxicityModel:
    """Learns from the labelled rows for which ``usable`` holds, at most
    ``max_labelled`` of them.  Feature counts, feature rows and counterfactual
    pairs are made on the executors; the driver gets at most ``max_features``
    features, ``max_labelled`` sparse rows, and the distinct differences of all
    pairs, whose number goes with that of the ``terms`` (lower-case single
    words by axis) and of their features.  Without labelled rows the model
    scores every text alike (0.5); without terms it has no penalty, and with a
    ``tie`` of 0 one that does not act."""
    prepare(docs.sparkSession)
    train = saved(labelled_texts(docs, labels, label_col, usable, max_labelled, id_col, text_col))

    def count(batches):
        for b in batches:
            n, pos = Counter(), Counter()
            for text, label in zip(b["text"], b["label"]):
                found = text_features(text)
                n.update(found)
                if label:
                    pos.update(found)
            yield pd.DataFrame({"feature": list(n), "n": list(n.values()), "pos": [pos[f] for f in n]}, columns=["feature", "n", "pos"])

    total, positive = train.agg(F.count(F.lit(1)), F.sum("label")).first()
    positive = positive or 0
    counts = train.mapInPandas(count, "feature string, n long, pos long").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    # signed root of chi-square: how far a feature's share of positives is from the base rate
    base = positive / total if total else 0.0
    gain = F.abs(F.col("pos") - F.col("n") * base) / F.sqrt(F.col("n") * max(base * (1 - base), 1e-9))
    top = counts.filter((F.col("n") >= MIN_DOCS) & (gain >= MIN_GAIN)).orderBy(gain.desc(), "feature").limit(max_features).collect() if total else []
    vocabulary = {r["feature"]: i for i, r in enumerate(top)}
    for term in sorted({t for axis in terms.values() for t in axis}):
        for f in sorted(text_features(term)):
            vocabulary.setdefault(f, len(vocabulary))

    def ids(text):
        return sorted(vocabulary[f] for f in text_features(text) if f in vocabulary)

    def encode(batches):
        for b in batches:
            found = Counter(pair for t in b["text"] for sentence in SENTENCE.split(t or "") for pair in counterfactuals(sentence, terms))
            out = [(ids(t), int(y), [], [], 0) for t, y in zip(b["text"], b["label"])]
            out += [([], -1, sorted(vocabulary[f] for f in x), sorted(vocabulary[f] for f in y), k) for (x, y), k in found.items()]
            yield pd.DataFrame(out, columns=["x", "label", "plus", "minus", "n"])

    coded = saved(train.mapInPandas(encode, "x array<int>, label int, plus array<int>, minus array<int>, n long"))
    rows = coded.filter("label >= 0").orderBy("x", "label").limit(max_labelled).toPandas()
    pairs = coded.filter("label < 0").groupBy("plus", "minus").agg(F.sum("n").alias("n")).orderBy("plus", "minus").toPandas()
    weights, bias = fit_weights([list(x) for x in rows["x"]], rows["label"].to_numpy(float), list(zip(pairs["plus"], pairs["minus"])), len(vocabulary), tie=tie, times=pairs["n"].to_numpy(float))
    return ToxicityModel({f: float(weights[i]) for f, i in vocabulary.items() if abs(weights[i]) > 1e-6}, bias)


def score(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if score is at
    least ``threshold``); input columns of these names are replaced.  Whole
    texts are scored; null and empty texts get the score of no feature."""
    prepare(docs.sparkSession)

    @F.pandas_udf("double")
    def scorer(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    docs, names = hide(docs)
    scored = docs.withColumn("score", scorer(F.col(names[text_col])))
    return show(scored.withColumn("predicted", (F.col("score") >= threshold).cast("int")), names, "score", "predicted")
