import json

from llm_fixtures import clashing

from cohortlab.llm.html_extract import extract, extract_main_text, induce, parse, tree_match

PAGE = """<!DOCTYPE html><html><head><meta charset="utf-8"><title>T {i}</title><style>p{{margin:0}}</style>
<script>var t="</p><article>no</article>";</script></head><body class="has-sidebar">
<header class="site-header"><h2>My site</h2></header><nav><ul><li><a href="/">Home</a></li><li>{i}</li></ul></nav>
<div class="cookie-notice">We use cookies.</div><!-- ad {i} --><div class="ad">Buy {i}</div>
{body}
<aside class="sidebar"><p>About us</p></aside><form><input name="q"><label>Search</label></form>
<section id="comments"><h3>Comments</h3><article class="comment"><p>Nice {i}!</p></article></section>
<footer>&copy; site {i}</footer></body></html>"""
ARTICLE = """<main><article><header><h1>Title {i} &amp; more</h1></header><p>First <b>bold</b>text,&nbsp;line
 two.<br>After break</p><p>Unclosed <i>par<p>Next é &lt;x&gt; &#8364;<div class="share-buttons">Share</div><ul><li>one<li>two</ul>
 <table><tr><td>c1<td>c2</table></article></main>"""
WANT = "Title {i} & more First boldtext, line two. After break Unclosed par Next é <x> € one two c1 c2"


def page(i, body):
    return PAGE.format(i=i, body=body.format(i=i))


def test_semantic_article():
    for i in range(3):
        assert extract(page(i, ARTICLE), None) == WANT.format(i=i)


def test_induced_wrapper_finds_the_content_of_pages_without_article():
    words = ["alpha beta gamma delta", "one two three four five six", "red green blue yellow pink", "north south east west up"]
    body = '<div id="wrap"><div class="tagline">Always the same words here</div><div class="body-text"><h1>{t}</h1><p>{t} {t}</p><p>{t}.</p></div></div>'
    pages = [PAGE.format(i=i, body=body.format(t=t)) for i, t in enumerate(words)]
    wrapper = induce(pages[:3])
    assert wrapper["path"].endswith("div.body-text")
    assert extract(pages[3], wrapper) == f"{words[3]} {words[3]} {words[3]} {words[3]}."
    assert "Always the same words here" in wrapper["template"]
    assert "Always" not in extract(pages[3].replace("body-text", "other"), wrapper)


def test_tree_match_maps_equal_tags_in_order():
    a, b = parse("<div><p>1</p><ul><li>2</li></ul><p>3</p></div>"), parse("<div><p>1</p><p>3</p><h1>x</h1></div>")
    pairs = []
    assert tree_match(a, b, pairs) == 4 and [x.tag for x, _ in pairs].count("p") == 2


def test_odd_pages():
    assert extract(None, None) == extract("", None) == "" and extract("plain", None) == "plain"
    assert extract("<p>a<p>b</div></span>c", None) == "a bc"  # stray end tags end nothing
    assert extract("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000, None) == "deep"
    assert extract("<body><p>x &unknown; &amp y</p></body>", None) == "x &unknown; & y"
    assert len(extract("<article><p>" + "w " * 200_000 + "</p></article>", None).split()) == 200_000


def test_alignment_of_deep_and_wide_pages():
    deep = "<body>" + "<div>" * 2000 + "x{}" + "</div>" * 2000
    wide = "<body><div>" + "<p>line {}</p>" * 3000 + "</div></body>"
    for text in (deep, wide):
        pages = [text.replace("{}", str(i)) for i in range(3)]
        assert extract(pages[2], induce(pages)).split()[-1].endswith("2")


def test_alignment_calls_and_walks_grow_with_the_page(monkeypatch):
    from cohortlab.llm import html_extract

    calls = {"tree_match": 0, "is_noise": 0}

    def counted(name, whole):
        def call(*args):
            calls[name] += 1
            return whole(*args)

        monkeypatch.setattr(html_extract, name, call)

    for name in calls:
        counted(name, getattr(html_extract, name))
    flat = "<body><div>" + "<p>line {}</p><hr>" * 25 + "<nav>menu</nav></div></body>"
    pairs = []
    assert html_extract.tree_match(parse(flat.replace("{}", "1")), parse(flat.replace("{}", "2")), pairs) == len(pairs) == 54
    assert calls["tree_match"] <= 4
    deep = "<body>" + "<div>" * 100 + "<p>x {0}</p><p>said</p><aside><p>no {0}</p></aside>"
    one, noted = parse(deep.format(1)), {}
    html_extract.align(one, parse(deep.format(2)), noted)
    calls["is_noise"] = 0
    varying, same = html_extract.align(one, parse(deep.format(30)), noted)
    assert calls["is_noise"] <= 150
    assert set(varying.values()) == {len("x 1 said") + len("x 30 said"), len("x 1") + len("x 30")} and len(varying) == 102 and same == {"said"}


def test_table(spark):
    rows = [(i, f"http://a.example/{i}", page(i, ARTICLE)) for i in range(9)] + [(20, "http://b.example/", page(20, ARTICLE))] * 2
    rows += [(30, None, page(30, ARTICLE)), (31, "http://a.example/x", None), (None, "no url", "")]
    df = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"), "text", "_host", "_wrapper", "host")
    out = extract_main_text(df)
    assert out.columns == [c for c in df.columns if c != "text"] + ["text"]
    got = sorted((str(r.page_id), r.text) for r in out.collect())
    assert got == sorted((str(i), WANT.format(i=i) if h else "") for i, _, h in rows)
    assert extract_main_text(df.limit(0)).count() == 0


def test_the_wrapper_of_a_table_comes_from_all_pages_of_a_host(spark):
    # a line that all pages but one share is no template, wherever that one stands
    body = '<div id="wrap"><div class="x{n}"><p>Often said here</p></div><div class="y">{t}</div></div>'
    rows = []
    for host in range(8):
        for i in range(30):
            said = body.replace("Often said here", "Seldom") if i == 3 * host else body
            rows.append((100 * host + i, f"http://h{host}.example/{i}", PAGE.format(i=i, body=said.format(n="", t=f"w{i} " * (3 + i % 2)))))
    got = {r.page_id: r.text for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    from cohortlab.llm.html_extract import wrappers

    few = spark.createDataFrame([(u.split("/")[2], h) for _, u, h in rows], "_host string, _html string")
    made = {r._host: json.loads(r._wrapper) for r in wrappers(few).collect()}
    assert len(made) == 8 and all("Often said here" not in w["template"] for w in made.values())
    assert len(got) == len(rows) and all(got[p].endswith(("w%d " % (p % 100) * 3).strip()) for p in got)


WORDS = ["alpha beta gamma delta", "one two three four five six", "red green blue yellow pink", "north south east west up"]
FRAME = '<div class="tagline">Always the same words here</div><div class="body-text"><h1>{t}</h1><p>{t} {t}</p><p>{t}.</p></div>'
WIDE_BODY, DEEP_BODY = "<div>" + "<hr>" * 90 + FRAME + "</div>", "<div>" * 400 + FRAME + "</div>" * 400


def test_alignment_takes_all_children_and_levels():
    for body in (WIDE_BODY, DEEP_BODY):
        pages = [PAGE.format(i=i, body=body.format(t=t)) for i, t in enumerate(WORDS)]
        wrapper = induce(pages[:3])
        assert wrapper["path"].endswith("/div.body-text") and "Always the same words here" in wrapper["template"]
        assert extract(pages[3], wrapper) == f"{WORDS[3]} {WORDS[3]} {WORDS[3]} {WORDS[3]}."
    flat, deep, pairs = "<body>" + "<p>a</p>" * 3000, "<body>" + "<div>" * 3000, []
    assert tree_match(parse(flat + "<h1>x</h1><p>y <b>z</b></p>"), parse(flat + "<p>y <b>z</b></p>"), pairs) == len(pairs) == 3004
    assert [a.tag for a, _ in pairs].count("b") == 1
    assert tree_match(parse(deep + "<p>x"), parse(deep + "<hr><p>y")) == 3003


def test_tree_match_is_the_plain_table_over_all_children(monkeypatch):
    import random

    from cohortlab.llm import html_extract

    def plain(a, b):
        if a.label != b.label:
            return 0, []
        x, y = a.elements(), b.elements()
        found = [[plain(p, q) for q in y] for p in x]
        best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i in range(len(x)):
            for j in range(len(y)):
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + found[i][j][0])
        pairs, i, j = [(a, b)], len(x), len(y)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs += found[i][j][1]
        return 1 + best[-1][-1], pairs

    some, shapes = random.Random(4), html_extract.Shapes()

    def tree(depth, most):
        tags = [some.choice(["div", "b", "ul"]) for _ in range(some.randint(0, most))]
        return "".join(f"<{t}>{tree(depth - 1, most) if depth else ''}</{t}>" for t in tags)

    for k in range(300):
        # rows as arrays, tables in blocks and forgotten shapes give the same
        for name, sizes in (("WIDE", (1, 4, 48)), ("CELLS", (1, 20, 10_000)), ("SHAPES_KEPT", (3, 10_000))):
            monkeypatch.setattr(html_extract, name, some.choice(sizes))
        a, b = (parse(tree(*((1, 90) if k % 50 == 0 else (3, 4)))) for _ in "ab")
        pairs = []
        size, want = plain(a, b)
        assert tree_match(a, b, pairs, some.choice([None, shapes])) == tree_match(a, b) == size == len(want)
        assert [(id(p), id(q)) for p, q in pairs] == [(id(p), id(q)) for p, q in want]


def test_table_of_wide_and_deep_pages(spark):
    rows = [(10 * h + i, f"http://h{h}.example/{i}", PAGE.format(i=i, body=body.format(t=t))) for h, body in enumerate((WIDE_BODY, DEEP_BODY)) for i, t in enumerate(WORDS)]
    got = {r.page_id: r.text for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {10 * h + i: f"{t} {t} {t} {t}." for h in range(2) for i, t in enumerate(WORDS)}


def test_work_on_deep_pages_grows_with_the_page():
    import time

    from cohortlab.llm import html_extract

    def took(levels):
        page = "<body>" + "<div>" * levels + "<span>some text " * levels + "{}"
        begun = time.process_time()
        one, noted = parse(page.format(1)), {}
        varying, _ = html_extract.align(one, parse(page.format(22)), noted)
        assert len(varying) == 2 * levels + 1
        return time.process_time() - begun

    took(100)
    assert took(8000) < 40 * took(1000) + 1
