import random

import pytest
from llm_fixtures import clashing, make  # noqa: F401

from cohortlab.llm.mixing import mix, mixing_plan, water_fill, with_takes


def brute_targets(sizes, weights, share=1.5, cap=2):
    """Targets by raising the level until the budget is used up."""
    total, free, out = share * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while free:
        level = (total - sum(out[i] for i in range(len(sizes)) if i not in free)) / sum(weights[i] for i in free)
        over = [i for i in free if weights[i] * level > cap * sizes[i]]
        if not over:
            for i in free:
                out[i] = weights[i] * level
            break
        for i in over:
            out[i] = cap * sizes[i]
            free.discard(i)
    return out


@pytest.mark.parametrize("sizes,weights", [([100, 100, 100], [3, 1, 2]), ([1, 1000, 10, 0], [3, 1, 2, 3]), ([5], [3]), ([0, 0], [3, 1])])
def test_water_fill(spark, sizes, weights):
    df = spark.createDataFrame([(str(i), s, float(w)) for i, (s, w) in enumerate(zip(sizes, weights))], "source string, source_size long, weight double")
    got = {int(r.source): r.target for r in water_fill(df).collect()}
    assert [got[i] for i in range(len(sizes))] == pytest.approx(brute_targets(sizes, weights))


def corpus(n=400):
    rnd = random.Random(2)
    rows = [(i, " ".join(["w"] * int(rnd.expovariate(0.02))), "en", rnd.choice(["a", "b", "ä", None, "a", "a"])) for i in range(n)]
    return rows + [(n, None, "en", "a"), (None, "null id", "en", "b"), (n + 1, "", "en", "z"), (n + 2, "x " * 5000, "en", "b")]


def test_takes_come_near_their_targets(make):
    rows = corpus()
    docs = make(rows)
    taken = with_takes(docs, mixing_plan(docs)).collect()
    assert len(taken) == len(rows)
    by_source = {}
    for r in taken:
        size = len((r.text or "").split())
        assert r.times in (0, 1, 2)
        words, target, most, total = by_source.get(r.source, (0, r.target, 0, 0))
        by_source[r.source] = (words + size * r.times, target, max(most, size), total + size)
    sources = sorted((s for s in by_source if s is not None)) + [None]
    want = brute_targets([by_source[s][3] for s in sources], [(3, 1, 2)[i % 3] for i in range(len(sources))])
    for s, t in zip(sources, want):
        words, target, most, _ = by_source[s]
        assert target == pytest.approx(t) and abs(words - target) <= most / 2 + 1


def test_reruns_agree_and_copies_are_whole(make):
    docs = clashing(make(corpus()).repartition(7), "copy", "times", "target", "_sk", "whole")
    runs = [sorted((str(r.doc_id), r.copy) for r in mix(docs).collect()) for _ in range(2)]
    assert runs[0] == runs[1]
    assert mix(docs).columns == [c for c in docs.columns if c != "copy"] + ["copy"]
    times = {}
    for i, c in runs[0]:
        times.setdefault(i, []).append(c)
    assert all(sorted(c) == list(range(1, len(c) + 1)) for c in times.values())


def test_repeated_rows_and_empty_table(make):
    docs = make([(1, "a b c")] * 4 + [(2, "d e")])
    taken = with_takes(docs, mixing_plan(docs)).collect()
    assert len({r.times for r in taken if r.doc_id == 1}) == 1 and len(taken) == 5
    assert mix(make([])).count() == 0
