import random
import re
from collections import Counter

from llm_fixtures import clashing, make  # noqa: F401

from cohortlab.llm import line_dedup
from cohortlab.llm.line_dedup import remove_duplicate_lines

WORDS = re.compile(r"[^\x20\x09-\x0d]+")


def brute(rows, t=0.8):
    """(doc_id, n_lines, n_removed, text) of each row, by comparing all lines."""
    places = [((i is not None, i or 0), n, frozenset(WORDS.findall(line))) for i, text in rows for n, line in enumerate((text or "").split("\n"))]
    out = []
    for i, text in rows:
        keep, gone = [], 0
        for n, line in enumerate(text.split("\n") if text is not None else []):
            own = frozenset(WORDS.findall(line))
            at = ((i is not None, i or 0), n)
            if own and any((a, b) < at and s and len(own & s) >= t * len(own | s) - 1e-9 for a, b, s in places):
                gone += 1
            else:
                keep.append(line)
        out.append((i, len((text or "").split("\n")) if text is not None else 0, gone, "\n".join(keep) if text is not None else None))
    return Counter(out)


def spark_rows(df):
    return Counter((r.doc_id, r.n_lines, r.n_removed, r.text) for r in df.collect())


def corpus(seed, docs=60):
    rnd = random.Random(seed)
    vocabulary = ["w%d" % int(rnd.expovariate(0.05)) for _ in range(400)]
    base = [" ".join(rnd.choices(vocabulary, k=rnd.randint(1, 30))) for _ in range(40)]
    rows = []
    for i in range(docs):
        lines = []
        for _ in range(rnd.randint(1, 8)):
            words = rnd.choice(base).split(" ")
            for _ in range(rnd.randint(0, 4)):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            rnd.shuffle(words)
            lines.append(" ".join(words))
        rows.append((i, "\n".join(lines)))
    return rows


def test_against_brute_force(make):
    rows = corpus(5)
    assert spark_rows(remove_duplicate_lines(make(rows))) == brute(rows)


def test_against_brute_force_whatever_leaders_settle(make, monkeypatch):
    rows = corpus(6)
    for neighbours in (2, 50):
        monkeypatch.setattr(line_dedup, "_NEIGHBOURS", neighbours)
        assert spark_rows(remove_duplicate_lines(make(rows))) == brute(rows)


def test_pairs_of_a_group_of_near_copies_grow_with_its_size(make, monkeypatch):
    seen, whole = [], line_dedup._verified

    def counted(pairs, docs, t):
        seen.append(pairs.count())
        return whole(pairs, docs, t)

    monkeypatch.setattr(line_dedup, "_verified", counted)
    rnd = random.Random(8)
    base = [f"v{k}" for k in range(30)]
    rows = []
    for i in range(120):
        words = list(base)
        words[rnd.randrange(30)] = f"u{i}"
        rows.append((i, " ".join(words)))
    assert spark_rows(remove_duplicate_lines(make(rows))) == brute(rows)
    assert sum(seen) <= 4 * len(rows)


def test_near_copies_with_several_own_words_are_mostly_settled_by_leaders(make, monkeypatch):
    seen, whole = [], line_dedup._verified

    def counted(pairs, docs, t):
        seen.append(pairs.count())
        return whole(pairs, docs, t)

    monkeypatch.setattr(line_dedup, "_verified", counted)
    rnd = random.Random(12)
    rows = []
    for i in range(150):
        words = [f"v{k}" for k in range(60)]
        for k in rnd.sample(range(60), 3):
            words[k] = f"u{i}x{k}"
        short = [f"s{k}" for k in range(24)]
        short[rnd.randrange(24)] = f"u{i}"
        rows.append((i, " ".join(words) + "\n" + " ".join(short)))
    assert spark_rows(remove_duplicate_lines(make(rows))) == brute(rows)
    assert sum(seen) <= 10 * len(rows), seen


def test_words_are_split_at_every_ascii_white_space(make):
    rows = [(1, "a\tb\x0bc\x0cd\re f\u00a0g"), (2, "f\u00a0g e d  c b a "), (3, "a b c d e f g"), (None, "\t\r"), (4, None)]
    assert spark_rows(remove_duplicate_lines(make(rows))) == brute(rows)


def test_long_lines_of_other_words_are_no_candidates(make, monkeypatch):
    seen, whole = [], line_dedup._verified

    def counted(pairs, docs, t):
        seen.append(pairs.count())
        return whole(pairs, docs, t)

    monkeypatch.setattr(line_dedup, "_verified", counted)
    rnd = random.Random(9)
    vocabulary = [f"c{k}" for k in range(1500)]
    rows = [(i, " ".join(rnd.sample(vocabulary, 150 if i % 2 else 122))) for i in range(80)]
    rows += [(100, rows[3][1].replace("c", "d", 9)), (101, rows[4][1] + " more words")]
    assert spark_rows(remove_duplicate_lines(make(rows))) == brute(rows)
    assert sum(seen) <= 10


def test_codes_of_words_sort_by_rarity_from_a_table_that_is_made_once(make):
    from pyspark.sql import functions as F

    docs = make([(i, "often often seldom" if i % 9 == 0 else "often  ") for i in range(90)] + [(90, " once\toften often seldom ")])
    levels = line_dedup.rarity_levels(docs)
    codes = docs.filter("doc_id = 90").select(*[line_dedup._code(F.xxhash64(F.lit(w)), levels).alias(w) for w in ("once", "seldom", "often")], F.transform(line_dedup._hashes(F.col("text")), lambda h: line_dedup._code(h, levels)).alias("line"))
    once, seldom, often, of_line = codes.first()
    assert once < seldom < often and sorted(of_line) == [once, seldom, often]
    assert [c >> 56 for c in (once, seldom, often)] == line_dedup._level([1, 11, 102]).tolist()
    # the table is a constant of the plan, not made or cut into for each word
    plan = codes._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 and "substring" not in plan
    assert not codes.schema[3].dataType.containsNull


def test_edge_cases(make):
    long_line = " ".join(f"x{k}" for k in range(30_000))
    rows = [(2, "a b c\n\n \t\na b c"), (2, "a b c\n\n \t\na b c"), (1, "c b a"), (None, "once more"), (5, "once more\nx"), (3, None), (4, ""), (6, long_line + "\n" + long_line + " y"), (7, "\n\n"), (7, "other text of the id\nx")]
    assert spark_rows(remove_duplicate_lines(make(rows))) == brute(rows)


def test_columns_and_empty_table(make):
    df = clashing(make([(1, "a b\na b")]), "n_lines", "gone", "line", "h", "id", "_mark")
    out = remove_duplicate_lines(df)
    assert out.columns == [*[c for c in df.columns if c != "n_lines"], "n_lines", "n_removed"]
    row = out.first()
    assert (row.text, row.n_lines, row.n_removed, row.gone, row.id) == ("a b", 2, 1, "mine", "mine")
    assert remove_duplicate_lines(make([])).count() == 0
