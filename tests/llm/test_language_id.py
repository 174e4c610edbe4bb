import random

import numpy as np
import pandas as pd
import pytest
from llm_fixtures import clashing, make  # noqa: F401
from pyspark.sql import functions as F

from cohortlab.llm.language_id import KneserNey, build, fit, gram_keys, identify, letters
from cohortlab.llm.language_id import StoredModel

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["schr", "ein", "ung", "eit"], "cc": ["ção", "é", "lh", "as"]}


def corpus(n=240, seed=3):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        lang = rnd.choice(list(SYLLABLES))
        words = ["".join(rnd.choices(SYLLABLES[lang], k=rnd.randint(1, 4))) for _ in range(rnd.randint(3, 40))]
        out.append((i, " ".join(words), lang, "s"))
    return out


def test_held_out_accuracy(make):
    rows = corpus()
    truth = {r[0]: r[2] for r in rows}
    df = make(rows)
    model = fit(df, F.col("doc_id") % 3 != 1)
    got = [(r.lang_pred == truth[r.doc_id], r.score, r.rejected) for r in identify(df, model).collect() if r.doc_id % 3 == 1]
    assert np.mean([g[0] for g in got]) >= 0.98 and all(0 <= g[1] <= 1 for g in got)
    assert np.mean([g[2] for g in got]) < 0.1
    strange = identify(make([(1, "жзийклмн опрст уфхцч " * 5)]), model).first()
    assert strange.rejected and strange.lang_pred in SYLLABLES


def test_probabilities_sum_to_one():
    text = "abracadabra alakazam"
    keys, n = np.unique(gram_keys(text), return_counts=True)
    alphabet = sorted({*text, " "})
    model = KneserNey(keys, n, len(alphabet))
    for context in ("abr", "  a", "xyz", "zam"):
        grams = np.concatenate([gram_keys(context + c)[3:4] for c in alphabet])
        assert model.probability(grams).sum() == pytest.approx(1.0, abs=1e-9)


def test_union_table_equals_back_off():
    counts = pd.DataFrame([(lang, k, c) for lang, t in (("x", "aba caba"), ("y", "dada bad")) for k, c in zip(*(a.tolist() for a in np.unique(gram_keys(t).view(np.int64), return_counts=True)))], columns=["lang", "gram", "n"])
    model = build(counts)
    text = letters("Bad aba, qqq!")
    slow = [-np.log(m.probability(gram_keys(text))).mean() for m in model.models]
    assert np.allclose(model.entropies([text])[0], slow, atol=1e-5)


def test_memory_of_a_batch_of_long_texts(monkeypatch):
    import tracemalloc

    counts = pd.DataFrame([(f"l{i:02d}", k, c) for i in range(40) for k, c in zip(*(a.tolist() for a in np.unique(gram_keys("aba caba dada").view(np.int64), return_counts=True)))], columns=["lang", "gram", "n"])
    model = build(counts)
    texts = [letters("bad aba caba qx " * k) for k in (7_500, 3, 1, 7_500)] * 64  # two in four of 120,000 characters
    tracemalloc.start()
    got = model.entropies(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20  # 2.4 GB if the whole batch were looked up at once
    monkeypatch.setattr("cohortlab.llm.language_id.SLICE", 1 << 24)
    assert np.allclose(got[:4], model.entropies(texts[:4]), rtol=1e-4)
    few = [letters("bad aba"), letters("x"), letters("caba dada ab")]
    whole = model.entropies(few), model.own_entropies(few, 1)
    for size in (1, 2, 5, 8):
        monkeypatch.setattr("cohortlab.llm.language_id.SLICE", size)
        monkeypatch.setattr("cohortlab.llm.language_id.LARGE_SLICE", size)
        assert np.allclose(whole[0], model.entropies(few), rtol=1e-5) and np.allclose(whole[1], model.own_entropies(few, 1))


def test_edge_cases(make):
    rows = corpus(60)
    model = fit(make(rows), F.lit(True))
    df = clashing(make([(1, None), (2, ""), (3, "12 %% !"), (3, "12 %% !"), (None, "kalo mitu"), (5, "ka " * 60_000, None)]), "lang_pred", "score", "_found", "h")
    out = identify(df, model)
    assert out.columns[-3:] == ["lang_pred", "score", "rejected"] and "h" in out.columns
    got = sorted((r.lang_pred, r.score == 0) for r in out.collect())
    assert got == [("aa", False)] * 2 + [("und", True)] * 4
    nothing = fit(make([(1, "abc", None)]), F.lit(True))
    assert nothing.languages == [] and identify(make([(1, "abc")]), nothing).first().lang_pred == "und"
    assert fit(make([]), F.lit(True)).languages == [] and identify(make([]), model).count() == 0


def test_every_gram_and_language_is_kept(make):
    rnd = random.Random(11)
    names = [f"l{i:02d}" for i in range(70)]  # each language of letters of its own
    rows = [(i, " ".join("".join(rnd.choices(list(map(chr, range(0x4E00 + 40 * k, 0x4E28 + 40 * k))), k=5)) for _ in range(6 if k else 400)), n) for i, (k, n) in enumerate([*enumerate(names), (0, names[0])])]
    model = fit(make(rows), F.lit(True))
    assert model.languages == names and np.isfinite(model.limits).all()
    assert [r.lang_pred for r in identify(make([r[:2] for r in rows[:70]]), model).orderBy("doc_id").collect()] == names


def test_model_in_tables_equals_the_held_one(make):
    rows = corpus(60)
    df = make([*rows, rows[0], (900, None), (901, "12 %"), (902, "Ka zzz, éin"), (903, "x")])
    learn = F.col("doc_id") < 60
    held = fit(df, learn)
    for size in (300,):  # workers hold a few grams
        stored = fit(df, learn, max_bytes=size)
        assert isinstance(stored, StoredModel) and stored.languages == held.languages
        assert np.allclose(stored.limits, held.limits, atol=1e-5)
        a, b = (sorted((r.doc_id, r.lang_pred, round(r.score, 4), r.rejected) for r in identify(df, m).collect()) for m in (held, stored))
        assert a == b


def test_limits_come_from_all_learned_texts(make):
    rows = [(i, "ka lo mi tu " * 3, "aa") for i in range(2_500)]
    rows += [(5_000 + i, "schrein einung eitein schr " + "ab"[i % 2] * 3, "bb") for i in range(3)]
    model = fit(make(rows), F.lit(True))
    texts = [letters(r[1]) for r in rows if r[2] == "bb"]
    assert model.limits[1] == pytest.approx(model.own_entropies(texts, 1).max())
