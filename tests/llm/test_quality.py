import random

import numpy as np
from llm_fixtures import clashing, make  # noqa: F401
from pyspark.sql import functions as F

from cohortlab.llm import quality_model, quality_rules


def corpus(n=300, seed=5):
    rnd = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rnd.choices("abcdefghij", k=rnd.randint(2, 9))) for _ in range(rnd.randint(30, 200))]
        bad = rnd.random() < 0.3
        if bad:
            kind = rnd.randrange(3)
            words = [w.upper() + "!!" for w in words] if kind == 0 else [w + "%%%" for w in words] if kind == 1 else words[:3] * 40
        docs.append((i, " ".join(words)))
        labels.append((i, int(not bad), 0))
    return docs, labels


def test_rule_model_on_held_out_texts(spark, make):
    docs, labels = corpus()
    df, lab = make(docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality_model.fit(df, lab, F.col("doc_id") % 5 != 0)
    assert model.rules and len(model.rules) < 150
    truth = {i: q for i, q, _ in labels}
    rows = quality_model.score(df, model).collect()
    held = [r.predicted == truth[r.doc_id] for r in rows if r.doc_id % 5 == 0]
    assert np.mean(held) >= 0.95 and all(0 <= r.score <= 1 for r in rows)
    assert quality_model.fit(df.repartition(3), lab, F.col("doc_id") % 5 != 0) == model


def test_rule_column_equals_rule_matrix(spark, make):
    docs, labels = corpus(80)
    df, lab = make(docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality_model.fit(df, lab, F.lit(True))
    rows = quality_model.with_statistics(df).select("_stats.*", model.column().alias("s")).toPandas()
    x = rows[list(quality_model.STATISTICS)].to_numpy(float)
    z = quality_model.rule_matrix(x, list(model.rules)).astype(float) @ np.array(model.weights) + model.bias
    assert np.allclose(1 / (1 + np.exp(-z)), rows["s"])


def test_an_empty_text_has_no_share_of_anything(spark, make):
    docs, labels = corpus()
    model = quality_model.fit(make(docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), F.lit(True))
    rows = quality_model.with_statistics(make([(1, None), (2, "")])).select("_stats.*").collect()
    assert all(v == 0 for r in rows for k, v in r.asDict().items() if k not in ("lines", "line_words"))
    x = np.array([list(rows[0])], float)
    z = quality_model.rule_matrix(x, list(model.rules)).astype(float) @ np.array(model.weights) + model.bias
    assert np.allclose([r.score for r in quality_model.score(make([(1, None), (2, "")]), model).collect()], 1 / (1 + np.exp(-z[0])))


def test_rule_model_edge_cases(spark, make):
    df = clashing(make([(1, None), (1, None), (2, ""), (None, "x"), (3, "word " * 60_000)]), "score", "predicted", "_stats", "words")
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality_model.fit(df, empty, F.lit(True))
    out = quality_model.score(df, model)
    assert out.columns == [c for c in df.columns if c not in ("score", "predicted")] + ["score", "predicted"]
    assert {r.score for r in out.collect()} == {0.5}
    one = quality_model.fit(df, spark.createDataFrame([(1, 1, 0), (2, None, None)], empty.schema), F.lit(True))
    assert quality_model.score(df, one).first().score > 0.9
    assert quality_model.score(make([]), model).count() == 0


def brute_counts(text):
    import re

    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0d]+", t)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    return len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_counts_against_brute_force(make):
    rnd = random.Random(8)
    texts = [None, "", " \t\n", "a", "a b", "a b c", "a b c a b c", "x x x x x", "é ü\x0bß\x1c#\n é ü\x0bß\x1c#\n", "|a|b|<>&%$*#\nA\nA\n \nA", "😀 😀 😀 😀"]
    texts += [" ".join(rnd.choices("abc", k=rnd.randint(1, 60))) + "\n" * rnd.randint(0, 2) for _ in range(30)]
    df = clashing(make([(i, t, rnd.choice(["en", None, "xx"])) for i, t in enumerate(texts)]), "n_words", "kept", "_words", "_lang")
    out = quality_rules.judge(df)
    assert out.columns[: len(df.columns) - 2] == [c for c in df.columns if c not in ("n_words", "kept")]
    for r in out.collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_counts(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)


def test_divergence_keeps_clean_and_drops_strange_texts(make):
    rnd = random.Random(9)
    common = ["the", "of", "and", "to", "in"]

    def text(k=200):
        return " ".join(rnd.choice(common) if rnd.random() < 0.5 else "".join(rnd.choices("abcdefghijklm", k=6)) for _ in range(k))

    rows = [(i, text()) for i in range(80)] + [(100, text().upper()), (101, " ".join(w + "%%" for w in text().split())), (102, " ".join("".join(rnd.choices("abcdefghijklm", k=6)) for _ in range(200))), (103, text(60).upper())]
    got = {r.doc_id: (r.kept, r.class_distance, r.word_distance) for r in quality_rules.judge(make(rows)).collect()}
    assert all(got[i][0] for i in range(80))
    assert not got[100][0] and not got[101][0] and not got[102][0]
    assert got[103][0] and got[103][1] > quality_rules.MAX_CLASS_DISTANCE  # too short to be judged by it
    assert all(0 <= d <= 1 for g in got.values() for d in g[1:])
    assert quality_rules.judge(make([])).count() == 0


def test_texts_of_another_language_or_without_common_words_go(make):
    rnd = random.Random(21)
    common = {lang: ["".join(rnd.choices("abcdefghijklm", k=3)) + lang for _ in range(20)] for lang in ("aa", "bb", "cc")}

    def text(lang, share=0.22, k=None):
        own = common.get(lang, [""])
        return " ".join(rnd.choice(own) if rnd.random() < share else "".join(rnd.choices("abcdefghijklm", k=6)) for _ in range(k or rnd.randint(100, 600)))

    langs = list(common)
    rows = [(i, text(langs[i % 3]), langs[i % 3]) for i in range(600)]
    rows += [(1_000 + i, text(langs[i % 3]), langs[(i + 1) % 3]) for i in range(45)]  # labelled as another language
    rows += [(2_000 + i, text(None, 0), langs[i % 3]) for i in range(45)]
    kept = {r.doc_id: r.kept for r in quality_rules.judge(make(rows)).collect()}
    assert np.mean([kept[i] for i in range(600)]) > 0.99
    assert np.mean([kept[i] for i in kept if 1_000 <= i < 2_000]) <= 0.05
    assert np.mean([kept[i] for i in kept if i >= 2_000]) <= 0.05


def test_distance_of_a_text_without_common_words(spark):
    for shares in ([0.1, 0.05], [0.5, 0.5], [0.02]):
        q = [F.lit(x) for x in (*shares, 1 - sum(shares))]
        p = [F.lit(0.0)] * len(shares) + [F.lit(1.0)]
        row = spark.range(1).select(quality_rules.foreign_distance(q[-1]).alias("a"), quality_rules.js_distance(p, q).alias("b")).first()
        assert abs(row.a - row.b) < 1e-12


def test_every_language_has_a_reference_of_its_own(make, monkeypatch):
    rnd = random.Random(12)

    def text(letters, k=200):
        return " ".join("".join(rnd.choices(letters, k=5)) for _ in range(k))

    rows = [(i, text("abcdefghijklm"), f"l{i % 69:02d}") for i in range(6 * 69)]
    rows += [(1_000 + i, text("ABCDEFGHIJKLM"), "small") for i in range(5)] + [(2_000, text("ABCDEFGHIJKLM"), "rare"), (2_001, text("ABCDEFGHIJKLM"), None)]
    for most in (20_000, 3):  # broadcast and not
        monkeypatch.setattr(quality_rules, "BROADCAST_REFERENCES", most)
        got = {r.doc_id: r.kept for r in quality_rules.judge(make(rows)).collect()}
        assert len(got) == len(rows) and all(got[i] for i in got if i < 2_000)
        assert not got[2_000] and not got[2_001]  # compared with all texts
