"""Main text of web pages by wrapper induction.

All distinct pages of a host are parsed to DOM trees and each is aligned with
one of them, the host's reference, by simple tree matching (the largest
order-preserving mapping of equal tags).  Matched
nodes with equal text are template, nodes whose text varies are slots.  The
slot subtree that holds most varying text, outside of what is by its tag or
class furniture of a page, is the host's content: its path is the wrapper, and
the texts that the aligned pages share word for word are its template texts.
Every page of the host is then read through the wrapper.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Generator, Iterator
from html.parser import HTMLParser
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.common import hide, prepare, release, saved, show
from cohortlab.llm.url_filter import url_host

#: Parsed reference pages that a task remembers, their characters, and entries
#: of its table of shapes: what is forgotten is made again when it is needed.
REFERENCES_KEPT, CHARACTERS_KEPT, SHAPES_KEPT = 64, 2_000_000, 300_000
WIDE = 48  # from so many children on, a row of the table of an alignment is an array
CELLS = 4_000_000  # a larger table is traced in blocks of rows, each made anew
DEEP = 0.7  # share of what varies that a slot on the way to the content holds
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that never hold main text.
HIDDEN = frozenset("head script style noscript template iframe object svg math canvas audio video map select option datalist button input textarea title".split())
FURNITURE = frozenset("nav footer aside form dialog menu".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
MAIN = ("article", "main")
#: Words of class, id and role that name page furniture.
NOISE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adsense|adv|advert\w*|sponsor\w*|promo\w*|banner\w*|cookie\w*|consent|gdpr|notices?|notification\w*|alert\w*|pop-?up|modal|overlay|newsletter|subscri\w*|nav\w*|menu\w*|breadcrumbs?|sidebar\w*|aside|complementary|widgets?|related|recommend\w*|share|sharing|social|comments?|commentlist|respond|reply|replies|disqus|footer|site-?header|page-?header|masthead|login|signup|search|pagination|pager|toc|skip|outbrain|taboola|contentinfo)(?=$|[\s_-])",
    re.I,
)
HEADER = re.compile(r"(?:^|\s)(?:header|banner)(?=$|\s)", re.I)
#: Tags that an opening tag of the same list ends.
CLOSED_BY = {"p": frozenset("p div ul ol li table section article aside footer header nav h1 h2 h3 h4 h5 h6 form pre blockquote main figure hr dl".split()), "li": frozenset(["li"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "tr": frozenset(["tr"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option"])}
SCOPES = frozenset("article section div main aside nav header footer ul ol table form body html blockquote td".split())


class Node:
    """An element; children are elements and strings in page order."""

    __slots__ = ("tag", "label", "attrs", "children", "parent", "shape", "numbered", "_elements")

    def __init__(self, tag: str, label: str, attrs: dict, parent: Node | None):
        self.tag, self.label, self.attrs, self.children, self.parent = tag, label, attrs, [], parent
        self.numbered: object = None
        self._elements: list[Node] | None = None

    def elements(self) -> list[Node]:
        """The children that are elements, of a page that is parsed whole."""
        if self._elements is None:
            self._elements = [c for c in self.children if c.__class__ is Node]
        return self._elements


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", "#root", {}, None)

    def handle_starttag(self, tag, attrs):
        while self.at.tag in CLOSED_BY and tag in CLOSED_BY[self.at.tag]:
            self.at = self.at.parent
        if tag in CLOSED_BY["p"]:  # a block also ends a paragraph that has open inline elements
            up = self.at
            while up.tag in INLINE and up.parent is not None:
                up = up.parent
            if up.tag == "p":
                self.at = up.parent
        named = {k: v or "" for k, v in attrs}
        node = Node(tag, tag + "." + ".".join(sorted(named.get("class", "").split())) if named.get("class") else tag, named, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.at.tag == tag and tag in HIDDEN:
            self.at = self.at.parent

    def handle_endtag(self, tag):
        up = self.at
        while up is not None and up.tag != tag:
            if up.tag in SCOPES and tag not in SCOPES:
                return  # a stray end tag of something outside
            up = up.parent
        if up is not None and up.parent is not None:
            self.at = up.parent

    def handle_data(self, data):
        self.at.children.append(data)

    def updatepos(self, i, j):
        return j  # nobody asks for line numbers


def parse(html: str | None) -> Node:
    """DOM tree of a page; unclosed and stray tags are tolerated."""
    builder = _Builder()
    if html:
        builder.feed(html)
        builder.close()
    return builder.root


def is_noise(node: Node, in_main: bool) -> bool:
    """Menus, headers, footers, sidebars, notices, adverts, forms, comments
    and invisible elements, by tag, role and class.  A header inside the main
    part that holds its heading belongs to it."""
    if node.tag in HIDDEN or node.tag in FURNITURE or "hidden" in node.attrs:
        return True
    if node.tag in ("html", "body", "main"):
        return False
    said = " ".join(filter(None, (node.attrs.get("class"), node.attrs.get("id"), node.attrs.get("role"))))
    if node.tag == "header" or HEADER.search(said):
        return not (in_main and any(n.tag in ("h1", "h2") for n in walk(node)))
    # a frame that is named after what is beside the article ("with-sidebar") is no furniture
    return bool(said and NOISE.search(said)) and not any(n.tag in MAIN for n in walk(node) if n is not node)


def walk(node: Node):
    stack = [node]
    while stack:
        n = stack.pop()
        yield n
        stack.extend(reversed(n.elements()))


def text_of(node: Node, drop: frozenset[str] = frozenset(), in_main: bool = True) -> str:
    """Text without noise; blocks joined by one space, white space collapsed.
    ``drop``: template texts of blocks that are left out."""
    out: list[str] = []
    stack: list = [node]
    while stack:
        n = stack.pop()
        if isinstance(n, str):
            out.append(n)
        elif n is node or not is_noise(n, in_main):
            if n is not node and drop and n.tag not in INLINE and own_text(n) in drop:
                continue
            if n.tag in INLINE:
                stack.extend(reversed(n.children))
            else:
                stack.extend([" ", *reversed(n.children), " "])
    return " ".join("".join(out).split())


def texts_of(root: Node, in_main: bool = False) -> dict[int, tuple[str, int, int]]:
    """By id of each node that is not within noise: one text that all share, and
    where in it stands what :func:`text_of` gives for the node, so that the
    texts of nested nodes need one walk and no copies."""
    out: list[str] = []
    length, gap = 0, False
    spans: list[tuple[int, int, int]] = []
    stack: list = [root]
    while stack:
        n = stack.pop()
        if isinstance(n, str):
            words = n.split()
            if not words:
                gap = gap or bool(n)
                continue
            if length and (gap or n[0].isspace()):
                out.append(" ")
                length += 1
            out.append(" ".join(words))
            length, gap = length + len(out[-1]), n[-1].isspace()
        elif isinstance(n, tuple):  # the end of a node
            node, start = n
            spans.append((id(node), start, length))
            gap = gap or node.tag not in INLINE
        elif n is root or not is_noise(n, in_main):
            gap = gap or n.tag not in INLINE
            stack.append((n, length))
            stack.extend(reversed(n.children))
    text = "".join(out)
    return {node: (text, start + (start < end and text[start] == " "), end) for node, start, end in spans}


def own_text(node: Node) -> str:
    """Collapsed text of a node without nested blocks; '' if it has some."""
    if any(c.tag not in INLINE and c.tag != "br" for c in node.elements()):
        return ""
    return text_of(node)


def path_of(node: Node) -> str:
    out = []
    while node is not None and node.tag != "#root":
        out.append(node.label)
        node = node.parent
    return "/".join(reversed(out))


class Shapes:
    """Trees without their texts: a number for each label with the shapes nested
    in it.  Equal trees share one, so parts that repeat in a page or a host are
    matched once, and a tree with its like without a table.  What a tree matches
    is made by generators that ask for the pairs below them, so a page may be as
    deep as it is."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.labels: list[str] = []
        self.kids: list[tuple[int, ...]] = []
        self.sizes: list[int] = []
        self.flat: list[bool] = []
        self.places: dict[int, dict[str, int]] = {}
        self.matched: dict[tuple[int, int], int] = {}
        self.traced: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.held, self.turn = 0, object()

    def number(self, root: Node) -> None:
        if root.numbered is self.turn:
            return
        for n in reversed([*walk(root)]):
            kids = tuple([c.shape for c in n.elements()])
            shape = self.numbers.get((n.label, kids))
            if shape is None:
                shape = self.numbers[n.label, kids] = len(self.kids)
                self.labels.append(n.label)
                self.kids.append(kids)
                self.sizes.append(1 + sum([self.sizes[k] for k in kids]))
                self.flat.append(self.sizes[-1] == 1 + len(kids))
                self.held += 1 + len(kids)
            n.shape = shape
        root.numbered = self.turn

    def steps(self, p: int, q: int) -> list[tuple[int, int]]:
        """The mapped children of two shapes with equal labels, by their places."""
        if (p, q) not in self.traced:
            jobs, answer = [self._steps(p, q)], None
            while jobs:
                try:
                    asked = jobs[-1].send(answer)
                except StopIteration as done:
                    jobs.pop()
                    answer = done.value
                else:
                    jobs.append(self._size(*asked))
                    answer = None
            self.traced[p, q] = answer
            self.held += 1 + len(answer)
        return self.traced[p, q]

    def _size(self, p: int, q: int) -> Generator:
        """Size of the mapping of two shapes with equal labels.  Equal children
        at both beginnings, or ends, lose nothing by being mapped."""
        x, y = self.kids[p], self.kids[q]
        i, most = 0, min(len(x), len(y))
        while i < most and x[i] == y[i]:
            i += 1
        j = 0
        while j < most - i and x[-1 - j] == y[-1 - j]:
            j += 1
        size = 1 + sum([self.sizes[k] for k in (*x[:i], *x[len(x) - j :])])
        x, y = x[i : len(x) - j], y[i : len(y) - j]
        if x and y:
            size += int((yield from self._rows(x, y, [0] * (len(y) + 1), 1))[-1][-1])
        return self._keep(p, q, size)

    def _keep(self, p: int, q: int, size: int) -> int:
        if len(self.matched) >= SHAPES_KEPT:
            self.matched.clear()
        self.matched[p, q] = size
        return size

    def _flat(self, p: int, q: int) -> int:
        """As :meth:`_size` if the children of one of the shapes have none: the
        longest common sequence of labels, a row of its table as the bits of a
        number.  Else 0."""
        if not (self.flat[p] or self.flat[q]):
            return 0
        labels, n = self.labels, len(self.kids[q])
        places = self.places.get(q)
        if places is None:
            places = self.places[q] = {}
            for j, k in enumerate(self.kids[q]):
                places[labels[k]] = places.get(labels[k], 0) | 1 << j
            self.held += 1 + len(places)
        row = full = (1 << n) - 1
        for k in self.kids[p]:
            hits = row & places.get(labels[k], 0)
            row = (row + hits | row - hits) & full
        return self._keep(p, q, 1 + n - row.bit_count())

    def _rows(self, x: tuple, y: tuple, above, kept: int) -> Generator:
        """Rows of the table of largest sizes: ``above`` and one after each of
        x, with one place more than y has; the last ``kept`` of them."""
        rows, last, gains = [above], None, []
        wide = len(y) >= WIDE
        if wide:
            place = {t: k for k, t in enumerate(dict.fromkeys(y))}
            places, y = np.array([place[t] for t in y]), tuple(place)
            rows = [np.asarray(above, dtype=np.int32)]
        for s in x:
            if s != last:
                last, label, kids, gains = s, self.labels[s], self.kids[s], []
                for t in y:
                    if s == t:
                        gain = self.sizes[s]
                    elif label != self.labels[t]:
                        gain = 0
                    elif not kids or not self.kids[t]:
                        gain = 1
                    else:
                        pair = (s, t) if s < t else (t, s)
                        gain = self.matched.get(pair) or self._flat(*pair) or (yield pair)
                    gains.append(gain)
                if wide:
                    gains = np.array(gains, dtype=np.int32)[places]
            above = rows[-1]
            if wide:
                row = np.zeros_like(above)
                np.add(above[:-1], gains, out=row[1:])
                np.maximum(row[1:], above[1:], out=row[1:])
                np.maximum.accumulate(row[1:], out=row[1:])
            else:
                row, most = [0], 0
                for left, over, gain in zip(above, above[1:], gains):
                    if left + gain > most:
                        most = left + gain
                    if over > most:
                        most = over
                    row.append(most)
            rows.append(row)
            if len(rows) > kept:
                del rows[0]
        return rows

    def _steps(self, p: int, q: int) -> Generator:
        """Of equal sizes, the mapping whose pairs are the first that they can
        be; to it belong equal children at both beginnings."""
        x, y = self.kids[p], self.kids[q]
        first = 0
        while first < min(len(x), len(y)) and x[first] == y[first]:
            first += 1
        x, y = x[first:], y[first:]
        steps: list[tuple[int, int]] = []
        if len(x) == len(y) == 1 and self.labels[x[0]] == self.labels[y[0]]:
            steps = [(first, first)]
        elif x and y:
            block = len(x) if len(x) * len(y) <= CELLS else isqrt(len(x)) + 1
            tops = [[0] * (len(y) + 1)]
            for k in range(0, len(x), block):
                rows = yield from self._rows(x[k : k + block], y, tops[-1], block + 1)
                tops.append(rows[-1])
            j = len(y)
            for k in reversed(range(0, len(x), block)):
                if rows is None:
                    rows = yield from self._rows(x[k : k + block], y, tops[k // block], block + 1)
                i = len(rows) - 1
                while i and j:
                    if rows[i][j] == rows[i - 1][j]:
                        i -= 1
                    elif rows[i][j] == rows[i][j - 1]:
                        j -= 1
                    else:
                        i, j = i - 1, j - 1
                        steps.append((first + k + i, first + j))
                rows = None
        return [*((i, i) for i in range(first)), *reversed(steps)]


def tree_match(a: Node, b: Node, pairs: list[tuple[Node, Node]] | None = None, shapes: Shapes | None = None) -> int:
    """Size of the largest order-preserving mapping of two trees with equal
    tags (simple tree matching), over all children and levels; the mapped nodes
    go to ``pairs``.  ``shapes`` is kept for the next page that ``a`` meets."""
    if a.label != b.label:
        return 0
    shapes = shapes or Shapes()
    if shapes.held + len(shapes.matched) > SHAPES_KEPT:
        shapes.clear()
    shapes.number(a)
    shapes.number(b)
    found: list[tuple[Node, Node]] = []
    stack = [(a, b)]
    while stack:
        p, q = stack.pop()
        found.append((p, q))
        x, y = p.elements(), q.elements()
        if x and y:
            stack.extend(zip(x, y) if p.shape == q.shape else [(x[i], y[j]) for i, j in shapes.steps(p.shape, q.shape)])
    if pairs is not None:
        pairs.extend(found)
    return len(found)


def paths_of(root: Node) -> tuple[dict[int, int], list[tuple[int, str]]]:
    """Paths of a page, numbered in page order: the number by id of each node,
    and by number that of the path above (-1: none) and the last label.  The
    texts of all paths would grow with the square of the depth."""
    number, paths, known = {id(root): -1}, [], {}
    for n in walk(root):
        if n is not root:
            step = (number[id(n.parent)], n.label)
            if step not in known:
                known[step] = len(paths)
                paths.append(step)
            number[id(n)] = known[step]
    return number, paths


def align(reference: Node, other: Node, noted: dict | None = None) -> tuple[Counter, set[str]]:
    """Of two aligned pages: characters of the texts that vary by the path of
    their node (as :func:`paths_of` numbers those of the reference), and the
    texts of blocks that are equal.  ``noted`` keeps what is known of the
    reference for its next page."""
    noted = {} if noted is None else noted
    if "texts" not in noted:
        noted |= {"texts": texts_of(reference), "own": texts_of(reference, True), "paths": paths_of(reference)[0], "noise": {id(reference): False}, "block": {}}
    texts, own, paths, noise, block = (noted[k] for k in ("texts", "own", "paths", "noise", "block"))
    pairs: list[tuple[Node, Node]] = []
    tree_match(reference, other, pairs, noted.setdefault("shapes", Shapes()))
    varying: Counter = Counter()
    same: set[str] = set()
    spans = texts_of(other)
    for a, b in pairs:
        at = id(a)
        if a is reference:
            continue
        if at not in noise:  # a node is paired after its parent
            noise[at] = noise[id(a.parent)] or is_noise(a, False)
        if noise[at]:
            continue
        if id(b) not in spans:  # noise itself, or it would stand in its parent's text
            spans |= texts_of(b)
        (mine, start, end), (theirs, low, high) = texts[at], spans[id(b)]
        if end - start != high - low or mine[start:end] != theirs[low:high]:
            varying[paths[at]] += end - start + high - low
        elif start < end:
            if at not in block:
                said, low, high = own[at]
                plain = all(c.tag in INLINE or c.tag == "br" for c in a.elements())
                block[at] = plain and said[low:high] == mine[start:end]
            if block[at]:
                same.add(mine[start:end])
    return varying, same


def choose(varying: dict[int, int], template: set[str], paths: list[tuple[int, str]]) -> dict:
    """Wrapper from the varying characters by path and the texts that all
    pages share: ``path`` of the content ('' if nothing varies) and ``template``."""
    if not varying:
        return {"path": "", "template": []}
    # descend from the body as long as one slot holds nearly all that varies
    most = max(varying.values())
    deep = {k: paths[k][1].rsplit("/", 1)[-1].split(".")[0] for k, n in varying.items() if n >= DEEP * most}
    lengths: list[int] = []
    for above, label in paths:
        lengths.append(len(label) + (lengths[above] + 1 if above >= 0 else 0))

    def text(k: int) -> str:
        labels = []
        while k >= 0:
            k, label = paths[k]
            labels.append(label)
        return "/".join(reversed(labels))

    semantic = [k for k, tag in deep.items() if tag in MAIN]
    slots = semantic or [k for k, tag in deep.items() if tag not in INLINE | {"p", "li", "h1", "h2", "h3"}]
    length = (min if semantic else max)((lengths[k] for k in slots), default=0)
    return {"path": min((text(k) for k in slots if lengths[k] == length), default=""), "template": sorted(template)}


def induce(pages: list[str]) -> dict:
    """Wrapper of a host from its pages, the first of which is the reference."""
    trees = [t for t in map(parse, pages) if t.elements()]
    noted: dict = {}
    found = [align(trees[0], other, noted) for other in trees[1:]]
    varying = sum((v for v, _ in found), Counter())
    template = set.intersection(*(same for _, same in found)) if len(found) > 1 else set()
    return choose(varying, template, paths_of(trees[0])[1] if varying else [])


def at_path(root: Node, path: str) -> list[Node]:
    """The nodes whose :func:`path_of` is ``path``, in page order."""
    found: list[Node] = []
    stack = [(n, 0) for n in reversed(root.elements())]
    while stack:
        n, start = stack.pop()
        if path.startswith(n.label, start):
            end = start + len(n.label)
            if end == len(path):
                found.append(n)
            elif path[end] == "/":
                stack.extend((c, end + 1) for c in reversed(n.elements()))
    return found


def extract(html: str | None, wrapper: dict | None) -> str:
    """Main text of a page, '' if none.  Content is what the host's wrapper
    names; on a page without it, the page's own article or main elements, else
    the whole body.  Template texts are left out only where the content is no
    article or main element, that is, may hold parts of the page's frame."""
    root = parse(html)
    path = (wrapper or {}).get("path", "")
    found: list[Node] = []
    stack = [root]
    mains: list[Node] = []
    while stack:
        n = stack.pop()
        if n is not root and is_noise(n, False) and n.tag not in ("html", "body"):
            continue
        if n.tag in MAIN or n.attrs.get("role") == "main":
            mains.append(n)
            if not path or path_of(n) == path or n.tag == "article":
                continue
        stack.extend(reversed(n.elements()))
    articles = [n for n in mains if n.tag == "article"] or mains
    if path and not articles:
        found = [n for n in at_path(root, path) if n.label == path.rsplit("/", 1)[-1]]
    template = frozenset((wrapper or {}).get("template", ()))
    if articles:
        on_path = [n for n in articles if path_of(n) == path]
        return " ".join(filter(None, (text_of(n) for n in on_path or articles)))
    return " ".join(filter(None, (text_of(n, template, in_main=False) for n in found or [root])))


def _alignments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (host, kind, text, n) of pages and their host's reference: numbers
    of paths and what varies there, equal texts, and one row that counts the page."""
    known: dict[str, tuple[Node, dict]] = {}
    shapes, characters = Shapes(), 0
    for batch in batches:
        out: list[tuple] = []
        for host, reference, html in zip(batch["_host"], batch["_reference"], batch["_html"]):
            if reference not in known:
                characters += len(reference)
                if len(known) >= REFERENCES_KEPT or characters > CHARACTERS_KEPT:
                    known.clear()
                    shapes.clear()
                    characters = len(reference)
                known[reference] = (parse(reference), {"shapes": shapes})
            tree = parse(html)
            if not tree.elements():
                continue
            varying, same = align(known[reference][0], tree, known[reference][1])
            out += [(host, "page", "", 1), *((host, "path", str(p), n) for p, n in varying.items()), *((host, "same", t, 1) for t in same)]
        yield pd.DataFrame(out, columns=["_host", "_kind", "_text", "_n"])


def wrappers(pages: DataFrame) -> DataFrame:
    """``pages`` (_host, _html) -> (_host, _wrapper as JSON), from all distinct
    pages of a host.  The reference is the page of the least hash that holds a
    tag; every other page is aligned with it where Spark has it, and Spark adds
    up what varies and counts the equal texts, so no host is gathered."""
    hashed = pages.select("_host", F.xxhash64("_html").alias("_h"), "_html").filter("_html is not null")
    tagged = hashed.filter(F.rlike(F.regexp_replace("_html", "(?s)<!--.*?-->", ""), F.lit("<[A-Za-z]")))
    # written, so that Spark knows its size and broadcasts it only if that is small
    least = saved(tagged.groupBy("_host").agg(F.min("_h").alias("_h")))
    reference = saved(hashed.join(least, ["_host", "_h"]).dropDuplicates(["_host"]).select("_host", F.col("_h").alias("_own"), F.col("_html").alias("_reference")))
    one = hashed.dropDuplicates(["_host", "_h"]).join(reference, "_host").filter("_h <> _own")
    found = one.select("_host", "_reference", "_html").mapInPandas(_alignments, "_host string, _kind string, _text string, _n long")
    found = saved(found.groupBy("_host", "_kind", "_text").agg(F.sum("_n").alias("_n")))
    per = found.groupBy("_host").agg(F.max(F.when(F.col("_kind") == "path", F.col("_n"))).alias("_most"), F.max(F.when(F.col("_kind") == "page", F.col("_n"))).alias("_pages"))
    path = (F.col("_kind") == "path") & (F.col("_n") >= DEEP * F.col("_most"))
    shared = (F.col("_kind") == "same") & (F.col("_n") == F.col("_pages")) & (F.col("_pages") > 1)
    few = found.join(per, "_host").filter(path | shared).groupBy("_host").agg(F.collect_list(F.struct("_kind", "_text", "_n")).alias("_few"))

    @F.udf("string")
    def chosen(rows, reference):
        varying = {int(r["_text"]): r["_n"] for r in rows if r["_kind"] == "path"}
        template = {r["_text"] for r in rows if r["_kind"] == "same"}
        return json.dumps(choose(varying, template, paths_of(parse(reference))[1] if varying else []))

    made = saved(few.join(reference, "_host").select("_host", chosen("_few", "_reference").alias("_wrapper")))
    release(least, reference, found)
    return made


def extract_main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` (main text of the whole html, '' if none; an
    input column of that name is replaced).

    A wrapper is induced for each host from all its distinct pages (see
    :func:`wrappers`).  Pages are joined to their host's wrapper, a small row
    per host; Spark splits a host with many pages.  Null html is an empty page,
    a null url an empty host; repeated rows get equal texts; an empty table
    gives no rows.
    """
    prepare(pages.sparkSession)
    pages, names = hide(pages)
    html_col = names[html_col]
    keyed = pages.withColumn("_host", url_host(F.col(names[url_col])))
    made = wrappers(keyed.select("_host", F.col(html_col).alias("_html")))

    @F.pandas_udf("string")
    def read(html: pd.Series, wrapper: pd.Series) -> pd.Series:
        known: dict = {}
        out = []
        for h, w in zip(html, wrapper):
            if w not in known:
                known[w] = json.loads(w) if w else None
            out.append(extract(h, known[w]))
        return pd.Series(out)

    joined = keyed.join(made, "_host", "left")
    return show(joined.withColumn("text", read(F.col(html_col), F.col("_wrapper"))), names, "text")
