"""Quality classifier: a sparse ensemble of rules over text statistics.

Boosted regression trees of small depth are grown on the statistics of
labelled texts; every path from a root is a rule (a conjunction of bounds).
A logistic model with an L1 penalty picks few of them and weighs them, and the
weighted rules become one Spark column expression: scoring is plain SQL.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.common import hide, prepare, saved, show, words
from cohortlab.llm.toxicity import labelled_texts

MAX_LABELLED = 20_000  # labelled rows that a fit uses at most
THRESHOLD = 0.3
TREES, DEPTH, BINS = 24, 3, 32
STATISTICS = ("words", "word_length", "distinct", "upper", "digits", "space", "marks", "symbols", "bars", "lines", "line_words", "stops", "long_words", "longest_run")


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a whole text as columns; a null text is an empty
    one, with one line and otherwise zeros (line_words: 1)."""
    t = F.coalesce(text, F.lit(""))
    chars = F.length(t)
    n = F.greatest(chars, F.lit(1)).cast("double")

    def share(pattern: str) -> Column:
        return (chars - F.length(F.regexp_replace(t, pattern, ""))) / n

    w = words(t)
    count = F.greatest(F.size(w), F.lit(1)).cast("double")
    lines = F.size(F.split(t, "\n")).cast("double")
    return {
        "words": F.size(w).cast("double"),
        "word_length": F.aggregate(w, F.lit(0.0), lambda a, x: a + F.length(x)) / count,
        "distinct": F.size(F.array_distinct(w)) / count,
        "upper": share("\\p{Lu}+"),
        "digits": share("\\p{Nd}+"),
        "space": share("\\s+"),
        "marks": share("[!?]+"),
        "symbols": share("[#*$%&|<>@~^=_{}\\[\\]\\\\]+"),
        "bars": share("\\|+"),
        "lines": lines,
        "line_words": count / lines,
        "stops": share("[.,;:]+"),
        "long_words": F.size(F.filter(w, lambda x: F.length(x) > 12)) / count,
        "longest_run": F.least(F.aggregate(w, F.lit(0.0), lambda a, x: F.greatest(a, F.length(x).cast("double"))), F.lit(200.0)),
    }


def with_statistics(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with a struct column ``_stats`` of the statistics."""
    return df.withColumn("_stats", F.struct(*[c.alias(k) for k, c in statistics(F.col(text_col)).items()]))


#: A rule: bounds (statistic, is_above, threshold); above means > threshold.
Rule = tuple[tuple[int, bool, float], ...]


def _tree_rules(x: np.ndarray, bins: list[np.ndarray], target: np.ndarray) -> tuple[list[Rule], np.ndarray]:
    """Rules of a regression tree of depth DEPTH and its predictions."""
    rules: list[Rule] = []
    fitted = np.zeros(len(target))

    def grow(rows: np.ndarray, path: Rule) -> None:
        if path:
            rules.append(path)
        y = target[rows]
        fitted[rows] = y.mean() if len(y) else 0.0
        if len(path) == DEPTH or len(rows) < 20:
            return
        best = (1e-9, None, None)
        for f, cuts in enumerate(bins):
            if not len(cuts):
                continue
            at = np.searchsorted(cuts, x[rows, f], side="left")  # x <= cuts[i] falls in bins 0..i
            n = np.cumsum(np.bincount(at, minlength=len(cuts) + 1))[:-1]
            s = np.cumsum(np.bincount(at, y, len(cuts) + 1))[:-1]
            ok = (n >= 10) & (len(rows) - n >= 10)
            gain = np.where(ok, s**2 / np.maximum(n, 1) + (y.sum() - s) ** 2 / np.maximum(len(rows) - n, 1) - y.sum() ** 2 / len(rows), 0)
            if gain.max() > best[0]:
                best = (gain.max(), f, float(cuts[gain.argmax()]))
        if best[1] is None:
            return
        above = x[rows, best[1]] > best[2]
        grow(rows[~above], (*path, (best[1], False, best[2])))
        grow(rows[above], (*path, (best[1], True, best[2])))

    grow(np.arange(len(target)), ())
    return rules, fitted


def rule_matrix(x: np.ndarray, rules: list[Rule]) -> np.ndarray:
    out = np.ones((len(x), len(rules)), np.float32)
    for j, rule in enumerate(rules):
        for f, above, cut in rule:
            out[:, j] *= x[:, f] > cut if above else x[:, f] <= cut
    return out


@dataclass(frozen=True)
class RuleModel:
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    bias: float

    def column(self, stats: str = "_stats") -> Column:
        """The model as one column expression over the statistics."""
        z = F.lit(self.bias)
        for rule, weight in zip(self.rules, self.weights):
            test = F.lit(True)
            for f, above, cut in rule:
                c = F.col(f"{stats}.{STATISTICS[f]}")
                test = test & (c > cut if above else c <= cut)
            z = z + F.when(test, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def fit_rules(x: np.ndarray, y: np.ndarray, penalty: float = 2e-3, steps: int = 400) -> RuleModel:
    """Boosted trees on the logistic residuals give the rules; accelerated
    proximal gradient steps give L1-penalised weights.  Deterministic."""
    if not len(y) or y.min() == y.max():
        p = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
        return RuleModel((), (), float(np.log(p / (1 - p))))
    bins = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    rules: dict[Rule, None] = {}
    z = np.zeros(len(y))
    for _ in range(TREES):
        found, fitted = _tree_rules(x, bins, y - 1 / (1 + np.exp(-z)))
        rules |= dict.fromkeys(found)
        z += 2.0 * fitted
    names = list(rules)
    m = rule_matrix(x, names)
    mean, spread = m.mean(0), np.maximum(m.std(0), 0.02)
    m = (m - mean) / spread
    rate = 4.0 / (np.linalg.norm(m, 2) ** 2 / len(y))
    w, v, bias = np.zeros(len(names), np.float32), np.zeros(len(names), np.float32), float(np.log(y.mean() / (1 - y.mean())))
    for t in range(steps):
        err = 1 / (1 + np.exp(-(m @ v + bias))) - y
        bias -= float(err.mean())
        step = v - rate * (m.T @ err) / len(y)
        new = np.sign(step) * np.maximum(np.abs(step) - rate * penalty, 0)
        v, w = new + t / (t + 3) * (new - w), new
    used = np.flatnonzero(np.abs(w) > 1e-6)
    scaled = w / spread
    return RuleModel(tuple(names[i] for i in used), tuple(float(scaled[i]) for i in used), float(bias - (scaled[used] * mean[used]).sum()))


def fit(docs: DataFrame, labels: DataFrame, usable: Column, label_col: str = "quality", max_labelled: int = MAX_LABELLED, id_col: str = "doc_id", text_col: str = "text") -> RuleModel:
    """Learns from at most ``max_labelled`` labelled rows for which ``usable``
    (a condition on the id) holds, chosen by a hash of the id.  Statistics are
    made on the executors; the driver gets one row of them per chosen row."""
    prepare(docs.sparkSession)
    train = labelled_texts(docs, labels, label_col, usable, max_labelled, id_col, text_col)
    rows = saved(with_statistics(train).select("label", "_stats.*")).orderBy("label", *STATISTICS).limit(max_labelled).toPandas()
    return fit_rules(rows[list(STATISTICS)].to_numpy(float), rows["label"].to_numpy(float))


def score(docs: DataFrame, model: RuleModel, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: better) and ``predicted`` (1
    from ``threshold`` on); input columns of these names are replaced.  Null
    and empty texts are scored by the statistics of an empty text."""
    prepare(docs.sparkSession)
    docs, names = hide(docs)
    scored = with_statistics(docs, names[text_col]).withColumn("score", model.column())
    return show(scored.withColumn("predicted", (F.col("score") >= threshold).cast("int")), names, "score", "predicted")
