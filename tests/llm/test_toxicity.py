import random

import numpy as np
from llm_fixtures import clashing, make  # noqa: F401
from pyspark.sql import functions as F

from cohortlab.llm.toxicity import IDENTITY_TERMS, ToxicityModel, counterfactuals, fit, fit_weights, score, text_features


def corpus(n=400, seed=1):
    rnd = random.Random(seed)
    words = [f"word{k}" for k in range(200)]
    docs, labels = [], []
    for i in range(n):
        text = rnd.choices(words, k=rnd.randint(5, 60))
        toxic = rnd.random() < 0.3
        if toxic:
            text.insert(rnd.randrange(len(text)), rnd.choice(["vilething", "Scumbags", "vilest"]))
        if rnd.random() < (0.5 if toxic else 0.05):  # a group is named more often in toxic texts
            text.insert(0, "muslims")
        docs.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_learns_and_scores_held_out_texts(spark, make):
    docs, labels = corpus()
    df, lab = make(docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = fit(df, lab, F.col("doc_id") % 4 != 2)
    truth = {i: t for i, _, t in labels}
    rows = score(df, model).collect()
    held = [(r.predicted, truth[r.doc_id], r.score) for r in rows if r.doc_id % 4 == 2]
    assert np.mean([p == t for p, t, _ in held]) >= 0.97 and all(0 <= s <= 1 for _, _, s in held)
    again = fit(df.repartition(5), lab, F.col("doc_id") % 4 != 2)
    assert again == model


def test_neutral_mentions_of_groups_score_alike(spark, make):
    docs, labels = corpus()
    model = fit(make(docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), F.lit(True))
    base = "word1 word2 {} word3"
    scores = [model.score(base.format(t)) for t in ("muslims", "christians", "jews")]
    assert max(scores) - min(scores) < 0.1 and max(scores) < 0.3


def test_the_penalty_ties_swapped_terms():
    rows, labels = [[0], [0], [1], [2], []] * 20, np.array([1.0, 1, 0, 0, 0] * 20)
    free, _ = fit_weights(rows, labels, [], 3)
    tied, _ = fit_weights(rows, labels, [([0], [1])] * 20, 3, tie=50.0)
    assert abs(tied[0] - tied[1]) < 0.1 * abs(free[0] - free[1])


def test_edge_cases(spark, make):
    model = ToxicityModel({"bad": 5.0}, -2.0)
    df = clashing(make([(1, None), (1, None), (2, ""), (None, "BAD"), (4, "good " * 50_000)]), "score", "predicted", "_stats")
    out = score(df, model)
    assert out.columns == [c for c in df.columns if c not in ("score", "predicted")] + ["score", "predicted"]
    assert sorted(r.predicted for r in out.collect()) == [0, 0, 0, 0, 1]
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert fit(df, empty, F.lit(True)).score("x") == 0.5
    nulls = spark.createDataFrame([(None, None, None), (1, None, None)], empty.schema)
    assert fit(df, nulls, F.lit(True)).weights == {}
    assert score(make([]), model).count() == 0


def test_features_and_swaps():
    assert text_features("Ab, longerword") == {"ab", "longerword", "^lon", "^longe", "^longerw"}


def test_pairs_are_differences_of_features():
    axes = {"colour": ("black", "white"), "age": ("old", "young", "elderly")}
    for sentence in ("Black cats", "the old black hats", "white and black", "blacken the black one", "young"):
        words = sentence.lower().split()
        want = []
        for term in sorted({w for w in words if any(w in a for a in axes.values())}):
            for other in next(a for a in axes.values() if term in a):
                if other != term:
                    was, now = text_features(sentence), text_features(" ".join(other if w == term else w for w in words))
                    want.append((was - now, now - was))
        assert counterfactuals(sentence, axes) == want
    for sentence in ("nobody here", "bla whitening", "younger ones"):
        put_in = [(set(), text_features(f"{sentence} {term}") - text_features(sentence)) for terms in axes.values() for term in terms]
        got = counterfactuals(sentence, axes)
        assert len(got) in (2, 3) and all(x in put_in for x in got)
    assert counterfactuals("nobody here", axes) == counterfactuals("HERE nobody", axes)
    assert counterfactuals(" ?", axes) == [] and counterfactuals("black", {}) == [] and counterfactuals("black", {"one": ("black",)}) == []


def test_gradient_of_the_loss_is_zero_at_the_fit():
    rnd = np.random.default_rng(4)
    rows, labels = [sorted(set(rnd.integers(0, 5, 3).tolist())) for _ in range(60)], rnd.integers(0, 2, 60).astype(float)
    pairs, times = [([0], [1]), ([2, 3], [4])], np.array([3.0, 1.0])
    w, b = fit_weights(rows, labels, pairs, 5, tie=2.0, ridge=0.01, times=times)

    def loss(v):
        z = np.array([v[5] + sum(v[f] for f in r) for r in rows])
        change = np.array([sum(v[f] for f in p) - sum(v[f] for f in m) for p, m in pairs])
        return np.mean(np.log1p(np.exp(z)) - labels * z) + 0.01 * (v[:5] ** 2).sum() + 2.0 * (times * change**2).sum() / times.sum()

    at = np.append(w, b)
    for i in range(6):
        step = np.eye(6)[i] * 1e-5
        assert abs(loss(at + step) - loss(at - step)) / 2e-5 < 1e-3


def test_the_penalty_clears_neutral_mentions(spark, make):
    # one word tells toxic texts only in part, so a group that they name often carries the label as well
    rnd = random.Random(6)
    rows, labels = [], []
    for i in range(800):
        toxic = i % 4 == 0
        text = rnd.choices([f"w{k}" for k in range(300)], k=20)
        if toxic and rnd.random() < 0.6:
            text.append("vilething")
        if rnd.random() < (0.8 if toxic else 0.04):
            text.insert(3, "muslims")
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    df, lab = make(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    neutral = [" ".join(["muslims", *rnd.choices([f"w{k}" for k in range(300)], k=20)]) for _ in range(200)]
    free, tied = fit(df, lab, F.lit(True), tie=0.0), fit(df, lab, F.lit(True))
    false = [np.mean([m.score(t) >= 0.3 for t in neutral]) for m in (free, tied)]
    assert false[0] > 0.5 and false[1] < 0.2
    gap = [abs(m.logit("muslims here") - m.logit("christians here")) for m in (free, tied)]
    assert gap[1] < 0.2 * gap[0]
    assert tied.score("vilething " + neutral[0]) >= 0.3


def test_texts_without_group_terms_give_pairs_too(spark, make):
    docs, labels = corpus(200)
    df = make([(i, t.replace("muslims", "word1")) for i, t in docs])
    model = fit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), F.lit(True), terms={"made": ("vilesome", "plainsome")})
    # the beginning "vile" of toxic words is one of a group's name too
    free = fit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), F.lit(True), terms={"made": ("vilesome", "plainsome")}, tie=0.0)
    assert abs(model.logit("vilesome") - model.logit("plainsome")) < 0.5 * abs(free.logit("vilesome") - free.logit("plainsome"))
    assert sum(len(t) for t in IDENTITY_TERMS.values()) < 200
