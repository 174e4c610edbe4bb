import random
import re

import numpy as np
import xxhash
from llm_fixtures import clashing, make  # noqa: F401

from cohortlab.llm.graph import component_labels
from cohortlab.llm.simhash import block_links, fingerprint, keep_one, links, near_duplicates


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, radius=3):
    label = dict.fromkeys(values)
    for v in values:
        if label[v] is None:
            label[v], todo = v, [v]
            while todo:
                x = todo.pop()
                for y in values:
                    if label[y] is None and bin(x ^ y).count("1") <= radius:
                        label[y] = v
                        todo.append(y)
    return label


def planted(rnd, groups=12, size=8):
    out = set()
    for _ in range(groups):
        x = rnd.getrandbits(64)
        for _ in range(size):
            out.add(x)
            for b in rnd.sample(range(64), rnd.randint(0, 4)):
                x ^= 1 << b
    return sorted(out)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprint():
    rnd = random.Random(1)
    texts = [None, "", " \t\n", "One", "One two", "One TWO three", "É À ü ß\x0bé\x1cx", "a b c a b c a b c", " ".join(rnd.choices("abcdef", k=5000))]
    for t in texts:
        assert fingerprint(t) & (1 << 64) - 1 == brute_fingerprint(t)


def test_block_links_find_all_components():
    rnd = random.Random(2)
    for radius in (0, 1, 2, 3, 5):
        values = planted(rnd)
        want = components(values, radius)
        found = {signed(v): signed(v) for v in values}
        for u, v in block_links(np.array([signed(x) for x in values], np.int64), radius):
            found[u] = v
        groups = {}
        for v in values:
            groups.setdefault(found[signed(v)], set()).add(want[v])
        assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want.values()))


def test_links_across_tiles(spark):
    values = planted(random.Random(3), groups=6, size=30)
    df = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    labels = {r.u: r.label for r in component_labels(links(df, tile=8)).collect()}
    want = components(values)
    groups = {}
    for v in values:
        groups.setdefault(labels.get(signed(v), signed(v)), set()).add(want[v])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want.values()))


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(900, 901), (7, 7)], "u long, v long")
    got = {r.u: r.label for r in component_labels(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, 901: 900}
    assert component_labels(edges.limit(0)).count() == 0


def corpus():
    rnd = random.Random(4)
    rows = []
    for g in range(12):
        words = [f"w{rnd.randrange(3000)}" for _ in range(120)]
        for _ in range(4):
            rows.append((len(rows) + 10, " ".join(words)))
            words[rnd.randrange(120)] = "new"
    return rows + [(5, None), (6, ""), (3, " \n"), (10, rows[0][1]), (None, rows[0][1]), (1, "x" * 200_000)]


def test_near_duplicates_against_brute_force(make):
    rows = corpus()
    prints = [brute_fingerprint(t) for _, t in rows]
    label = components(sorted(set(prints)))
    least = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[label[p]] = min(i, least.get(label[p], i))
    want = sorted((str(i), f"{p:016x}", least[label[p]]) for (i, _), p in zip(rows, prints))
    got = near_duplicates(clashing(make(rows), "fp", "fingerprint", "component_id", "u", "label")).collect()
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want
    kept = keep_one(clashing(make(rows), "fp", "_keep")).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(least.values()))
    assert near_duplicates(make([])).count() == 0 and keep_one(make([])).count() == 0


def test_groups_with_null_or_reused_ids_keep_their_document(make):
    rnd = random.Random(21)
    texts = [" ".join("".join(rnd.choices("abcdefghij", k=6)) for _ in range(60)) for _ in range(6)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (None, texts[4]), (9, texts[4]), (3, texts[5]), (4, texts[5])]
    got = [(r.doc_id, r.text) for r in keep_one(make(rows)).collect()]
    want = [(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (9, texts[4]), (3, texts[5])]
    assert sorted(got, key=str) == sorted(want, key=str)
