import random

from llm_fixtures import clashing, make  # noqa: F401

from cohortlab.llm.decontaminate import clean, contaminated, item_words, shingles


def corpus(seed=7):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(50)]
    items = [(i, " ".join(rnd.choices(words, k=rnd.randint(5, 60)))) for i in range(30)] + [(90, "two words"), (91, None), (92, ""), (93, items_text := "Ünïcode Words, With; Marks! here")]
    docs = []
    for i in range(60):
        text = rnd.choices(words, k=rnd.randint(0, 400))
        if i % 2:
            own = items[rnd.randrange(30)][1].split()
            for _ in range(rnd.randint(0, max(1, len(own) // 8))):
                own[rnd.randrange(len(own))] = "changed"
            at = rnd.randrange(len(text) + 1)
            text[at:at] = own
        docs.append((i, " ".join(text).upper() if i % 3 else " ".join(text)))
    return items, docs + [(100, None), (101, ""), (102, "two words"), (103, "two words more"), (None, items_text.upper()), (105, items[0][1] + " x" * 100_000)]


def test_against_exact_containment(spark, make):
    items, docs = corpus()
    table = spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for i, text in docs:
        own = shingles(item_words(text), 5)
        shares = {k: len(s & own) / len(s) for k, t in items if (s := shingles(item_words(t), 5))}
        held = sorted(k for k, v in shares.items() if v >= 0.8 - 1e-9)
        want[i] = (held, max((shares[k] for k in held), default=0.0))
    df = clashing(make(docs), "items", "containment", "_found")
    for max_bytes in (1 << 20, 500):  # also in several blocks
        got = contaminated(df, table, max_bytes=max_bytes)
        assert got.columns[-2:] == ["items", "containment"]
        assert {r.doc_id: (r["items"], r.containment) for r in got.collect()} == want
    assert sum(bool(v[0]) for v in want.values()) > 10
    kept = clean(df, table)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, v in want.items() if not v[0]}


def test_empty_tables_and_repeated_rows(spark, make):
    items = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    docs = make([(1, "x a b c d e f g y")] * 3 + [(2, "x")])
    assert sorted(r["items"] for r in contaminated(docs, items).collect()) == [[], [1], [1], [1]]
    assert clean(docs, items.limit(0)).count() == 4 and clean(make([]), items).count() == 0
