import random

from cohortlab.llm.url_filter import judge_urls

RULES = "host string, path string, verdict string"


def brute(url, rules):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
        host, tail = rest[:cut].translate({i: i + 32 for i in range(65, 91)}), rest[cut:]
        path = tail[: min([tail.index(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if h is not None and p is not None and v is not None and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def judged(spark, urls, rules, **extra):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    for name in extra:
        from pyspark.sql import functions as F

        pages = pages.withColumn(name, F.lit("mine"))
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, spark.createDataFrame(rules, RULES)).collect()}


def test_against_brute_force(spark):
    rnd = random.Random(3)
    hosts = ["net", "example.net", "a.example.net", "EXAMPLE.net", "org", "x.org", "b.a.example.net", "notexample.net", "example.nets", "", "net.", ".net", "com:80"]
    paths = ["", "/", "/en", "/en/", "/en/a/b", "/english", "/de/x", "//", "/a?b=/en/", "#/en/", "/é/ü"]
    urls = [f"{rnd.choice(['http', 'HTTPS', ''])}://{rnd.choice(hosts)}{rnd.choice(paths)}" for _ in range(300)]
    urls += [None, "", "no scheme/en/", "://", "a://b://c/d", "http://net", "http://net/" + "y" * 50_000]
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.net", "/e", "block"), ("a.example.net", "", "allow"), ("org", "", "block"), ("x.org", "/en/a", "allow"), ("", "", "block"), (None, "/", "block"), ("net", None, "block")]
    got = judged(spark, urls, rules, host=1, rule=1, verdict=1, key=1, _stack=1)
    assert got == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_deeply_nested_path_rules(spark):
    rules = [("net", "/a" * k, "block" if k % 2 else "allow") for k in range(1, 40)]
    urls = ["http://s.net" + "/a" * k + tail for k in range(45) for tail in ("", "/", "b")]
    assert judged(spark, urls, rules) == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_same_rule_with_both_verdicts_blocks(spark):
    got = judged(spark, ["http://net/x"], [("net", "/", "allow"), ("net", "/", "block"), ("NET", "/", "allow")])
    assert got[0] == ("net", "/x", "net/", "block")


def test_empty_tables_and_repeated_rows(spark):
    assert judged(spark, [], [("net", "/", "block")]) == {}
    assert judged(spark, ["http://net/x"], []) == {0: ("net", "/x", None, "allow")}
    pages = spark.createDataFrame([(1, "http://net/x")] * 3 + [(None, None)], "page_id long, url string")
    rows = judge_urls(pages, spark.createDataFrame([("net", "/", "block")], RULES)).collect()
    assert sorted((r.page_id or -1, r.verdict) for r in rows) == [(-1, "allow"), (1, "block"), (1, "block"), (1, "block")]
