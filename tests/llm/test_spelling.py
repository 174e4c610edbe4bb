import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from llm_fixtures import clashing, make  # noqa: F401

from cohortlab.llm import spelling as S
from cohortlab.llm.common import saved


def one_edit(a, b):
    """By definition: exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_pairs(words):
    words = sorted(words)
    return {frozenset((a, b)) for i, a in enumerate(words) for b in words[i + 1 :] if one_edit(a, b)}


def brute_counts(rows, drop_every=199):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if drop_every and h % drop_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def brute_variants(counts):
    near = defaultdict(list)
    for a, b in map(tuple, brute_pairs(counts)):
        near[a].append(b)
        near[b].append(a)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        if best and counts[best] >= 5 * n:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items()}


def test_acceptor_pairs_against_the_definition():
    rnd = random.Random(1)
    for _ in range(150):
        words = {"".join(rnd.choice("abc") for _ in range(rnd.randrange(7))) for _ in range(rnd.randrange(1, 70))}
        found = list(S.Acceptor(sorted(words)).pairs())
        assert len(found) == len(set(map(frozenset, found))) and set(map(frozenset, found)) == brute_pairs(words)


def test_acceptor_is_minimal_and_takes_long_words():
    machine = S.Acceptor(sorted(["walked", "walker", "talked", "talker"]))
    assert len(machine.final) == 7  # start and one state after each symbol: both first letters lead to the same
    assert list(S.Acceptor(["a" * 5000, "a" * 5001]).pairs()) == [("a" * 5001, "a" * 5000)]


@pytest.mark.parametrize("part_words", [4000, 40, 3])
def test_pairs_are_whole_whatever_the_partitions(spark, part_words):
    rnd = random.Random(2)
    words = sorted({rnd.choice(["", "pre", "abc"]) + "".join(rnd.choice("abé") for _ in range(rnd.randrange(6, 9))) for _ in range(500)})
    rows = saved(spark.createDataFrame([(w, len(w)) for w in words], "word string, n long"))
    found = [frozenset((r.a, r.b)) for r in S.near_pairs(rows, 6, part_words).collect()]
    assert len(found) == len(set(found)) and set(found) == brute_pairs(words)


def corpus():
    rnd = random.Random(3)
    base = ["quality", "größer", "Naïveté", "committee", "reading", "leading", "ÉCOLES"]
    rows = []
    for i in range(400):
        words = [rnd.choice(base) for _ in range(12)]
        if i % 6 == 0:
            words += ["qualitty", "comittee", "reeding"]
        if i % 40 == 0:
            words.append("comitte")
        rows.append((i, " ".join(words) + ". "))
    return rows + [(None, "quality " * 7), (401, None), (402, ""), (403, "longword" * 9000), (7, "repeated id quality")]


def test_variants_against_brute_force(make):
    rows = corpus()
    docs = clashing(make(rows), "word", "n", "run", "id", "h")
    got = S.spelling_variants(S.word_counts(docs, drop_every=199)).collect()
    assert {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == brute_variants(brute_counts(rows))
    assert len(got) == len({r.word for r in got})


def test_forms_are_followed_to_the_last(spark):
    chain = [("aaaaaa", 5), ("aaaaab", 25), ("aaaabb", 125), ("aaabbb", 625), ("aabbbb", 3125), ("abbbbb", 15625), ("bbbbbb", 78125), ("bbbbbc", 78125), ("zzzzzz", 9)]
    got = {r.word: (r.root, r.form, r.n_near) for r in S.spelling_variants(spark.createDataFrame(chain, "word string, n long")).collect()}
    assert all(got[w][0] == "bbbbbb" for w, _ in chain[:6])
    assert got["bbbbbb"] == ("bbbbbb", None, 2) and got["zzzzzz"] == ("zzzzzz", None, 0)


def test_ties_and_empty(spark, make):
    rows = [("readinx", 5), ("reading", 50), ("readina", 50)]
    got = {r.word: r.form for r in S.spelling_variants(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert got == {"readinx": "readina", "reading": None, "readina": None}
    assert S.spelling_variants(S.word_counts(make([]))).count() == 0
