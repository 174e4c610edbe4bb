import corpus_pipeline
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage on the smallest tables."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, SF)
        rows = [r.asDict() for r in kept.collect()]
        out.append((name, docs.columns, {r.doc_id: r.asDict() for r in docs.collect()}, kept.columns, rows))
        docs = spark.createDataFrame(rows, kept.schema)
    return out


def test_columns_and_order(stages):
    assert [s[0] for s in stages] == [n for n, _ in corpus_pipeline.STAGES]
    for _, before, _, after, _ in stages[:-1]:
        assert after == before
    assert set(stages[-1][1]) <= set(stages[-1][3])


def test_line_dedup_keeps_documents_and_first_lines(stages):
    _, _, before, _, rows = stages[1]
    assert {r["doc_id"] for r in rows} == set(before)
    seen = set()
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        assert r["n_chars"] == len(r["text"] or "")
        for line in (r["text"] or "").split("\n"):
            key = frozenset(line.split())
            assert not key or key not in seen
            seen.add(key)


def test_simhash_keeps_the_least_of_each_group(stages):
    from cohortlab.llm.simhash import fingerprint

    _, _, before, _, rows = stages[2]
    prints = {i: fingerprint(r["text"]) for i, r in before.items()}
    label = dict.fromkeys(before)
    for i in sorted(before):
        if label[i] is None:
            todo = [i]
            label[i] = i
            while todo:
                x = todo.pop()
                for y in before:
                    if label[y] is None and bin((prints[x] ^ prints[y]) & (1 << 64) - 1).count("1") <= 3:
                        label[y] = i
                        todo.append(y)
    assert sorted(r["doc_id"] for r in rows) == sorted(set(label.values()))


def test_no_benchmark_item_is_left(stages, spark):
    from cohortlab.llm.decontaminate import item_words, shingles

    items = [shingles(item_words(r.text), 5) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    _, _, before, _, rows = stages[3]

    def holds(text):
        own = shingles(item_words(text), 5)
        return any(s and len(s & own) >= 0.8 * len(s) - 1e-9 for s in items)

    assert {r["doc_id"] for r in rows} == {i for i, r in before.items() if not holds(r["text"])}


def test_mix_takes_every_source_near_its_target(stages):
    _, _, before, _, rows = stages[4]
    size = {i: len((r["text"] or "").split()) for i, r in before.items()}
    assert abs(sum(size[r["doc_id"]] for r in rows) - 1.5 * sum(size.values())) < 0.1 * sum(size.values())


def test_run_gives_the_rows_of_the_stages(stages, spark):
    got = corpus_pipeline.run(spark, SF).select("doc_id", "copy", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("m")).collect()
    import hashlib

    assert sorted((r.doc_id, r.copy, r.m) for r in got) == sorted((r["doc_id"], r["copy"], hashlib.md5((r["text"] or "").encode()).hexdigest()) for r in stages[-1][4])
