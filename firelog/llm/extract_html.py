"""Main text of HTML pages by minimum-cut labelling (operator 6).

A page is cut into blocks, the runs of text between block-level tags. A
linear classifier gives each block a score for being content; its positive
part is the capacity from the source to the block, its negative part that
from the block to the sink. Smoothness edges join neighbouring blocks, and
blocks under one parent element, with capacities that fall with their
distance in the element tree. The minimum cut of this graph is the labelling
that costs least; blocks on the source's side are the main text.
"""

from __future__ import annotations

import html as html_lib
import math
import re
from collections import Counter, deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from firelog.llm.common import map_slices

# Element names and name parts of classes and ids, by their usual role on pages.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
# Elements whose text ends only at their end tag, and others whose text is left out but which hold elements.
RAW_TAGS = frozenset("script style iframe textarea head title".split())
DROPPED_TAGS = frozenset("noscript template object svg math select button".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form menu dialog header".split())
CONTENT_TAGS = frozenset("article main".split())
BOILERPLATE_NAMES = re.compile(
    r"(?:^|[^a-z])(?:ads?|advert\w*|banner|promo\w*|sponsor\w*|nav\w*|menu\w*|side-?bar|footer|header|masthead|comments?|disqus|repl(?:y|ies)|"
    r"respond|cookies?|notice|consent|gdpr|alert|popup|modal|overlay|share|sharing|social|related|recommend\w*|breadcrumbs?|"
    r"subscri\w*|newsletter|sign-?up|login|widget|toolbar|pagination|pager|copyright|disclaimer|skip)(?![a-z])")
CONTENT_NAMES = re.compile(r"(?:^|[^a-z])(?:article|content|main|post|entry|story|body|text)(?![a-z])")

# Weights of the classifier.
WEIGHTS = {"bias": -0.8, "content_tag": 3.0, "boilerplate_tag": -4.5, "header_in_article": 3.0, "content_name": 1.0,
           "boilerplate_name": -5.0, "words": 0.6, "links": -3.0, "sentence": 0.6, "heading": 0.6, "item": -0.5, "mark": -2.0}
# Capacity of an edge between neighbours of distance 0 in the tree, and of one between blocks under one parent.
NEAR, SIBLING = 1.0, 0.4
UNIT = 1000
# Finding the elements around the content: weight of text in an article, of one more boilerplate element around a text,
# and the shares of the page's text that an element holds, with and without names of boilerplate.
ARTICLE, MARK = 6.0, 8.0
MOST, MOST_MARKED = 0.5, 0.8

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?/][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)",
                  re.S)
_NAME = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


class _Node:
    __slots__ = ("tag", "names", "parent", "depth", "around")

    def __init__(self, tag: str, names: str, parent: _Node | None):
        self.tag, self.names, self.parent = tag, names, parent
        # whether it holds the page's content: its names, and a form's tag, then say nothing about its text
        self.around = tag in ("html", "body")
        self.depth = parent.depth + 1 if parent else 0


class _Block:
    __slots__ = ("text", "node", "link_chars")

    def __init__(self, text: str, node: _Node, link_chars: int):
        self.text, self.node, self.link_chars = text, node, link_chars


class _Dropped:
    """An open element of ``DROPPED_TAGS`` and what stood before it: the state to go back to at its end."""

    __slots__ = ("tag", "node", "out", "parts", "linked", "in_link", "inline", "head")

    def __init__(self, tag: str, node: _Node, out: list, parts: list, linked: list, in_link: int, inline: Counter):
        self.tag, self.node, self.out, self.parts, self.linked, self.in_link, self.inline = tag, node, out, parts, linked, in_link, inline
        self.head = True  # no block has begun inside


def blocks(page: str) -> list[_Block]:
    """Text blocks of a page in order, character references decoded, white space made single.

    The text of ``DROPPED_TAGS`` is left out up to their end tag. One without
    an end tag ends with its parent and loses only its text before the first
    block inside it, so that it does not take the rest of the page.
    """
    root = node = _Node("", "", None)
    dropped: list[_Dropped] = []
    inline: Counter = Counter()  # open elements that are no blocks, since the last open dropped element
    out: list[_Block] = []
    parts: list[str] = []
    linked: list[str] = []
    in_link = 0
    at = 0

    def innermost(test) -> int | None:
        return next((i for i in range(len(dropped) - 1, -1, -1) if test(dropped[i])), None)

    def leave(depth: int, ended: bool):
        """Closes the open dropped elements from number ``depth`` on, by the end tag of that one or without."""
        nonlocal node, out, parts, linked, in_link, inline
        while len(dropped) > depth:
            d = dropped.pop()
            if ended or d.head:
                out, parts, linked, in_link = d.out, d.parts, d.linked, d.in_link
                node = d.node if ended else node
                add(" ")
            else:
                inside, rest, rest_linked, at_node = out, parts, linked, node
                out, parts, linked, node = d.out, d.parts, d.linked, d.node
                flush()
                out.extend(inside)
                parts, linked, node = rest, rest_linked, at_node
            inline = d.inline

    def flush():
        nonlocal parts, linked
        if dropped and dropped[-1].head:
            dropped[-1].head = False
            parts, linked = [], []
            return
        text = " ".join(html_lib.unescape("".join(parts)).split())
        if text:
            out.append(_Block(text, node, len(" ".join(html_lib.unescape("".join(linked)).split()))))
        parts, linked = [], []

    def add(s: str):
        if s:
            parts.append(s)
            if in_link:
                linked.append(s)

    while True:
        m = _TAG.search(page, at)
        add(page[at:m.start()] if m else page[at:])
        if not m:
            break
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag, closing = tag.lower(), bool(m[1] or m[4])
        attrs = m[3] if m[2] else m[6]
        if tag in DROPPED_TAGS:
            if closing or tag in ("button", "select"):
                # a button or select ends where the next one begins
                i = innermost(lambda d: d.tag == tag)
                if i is not None:
                    leave(i, closing)
            if closing or (attrs.rstrip().endswith("/") and tag in ("svg", "math")):
                continue
            dropped.append(_Dropped(tag, node, out, parts, linked, in_link, inline))
            out, parts, linked, inline = [], [], [], Counter()
            continue
        if not closing and tag in RAW_TAGS:
            if tag == "head":
                end = re.compile(r"</head\s*>|(?=<body\b)", re.I).search(page, at)
                # a head that never ends: only its own elements are passed over
                at = end.end() if end else at
            else:
                if dropped and attrs.rstrip().endswith("/") and dropped[-1].tag in ("svg", "math"):
                    continue
                end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                stop = end.start() if end else len(page)
                # without an end tag it ends with the dropped element it is in
                out_of = re.compile(rf"</(?:{'|'.join({d.tag for d in dropped})})\b", re.I).search(page, at, stop) if dropped else None
                if out_of and (not end or re.compile(rf"<{tag}\b", re.I).search(page, out_of.start(), stop)):
                    at = out_of.start()
                else:
                    at = end.end() if end else len(page)
            add(" ")
            continue
        if tag == "br":
            add(" ")
            continue
        if tag == "a":
            in_link = 0 if closing else 1
        if tag not in BLOCK_TAGS:
            if tag in VOID_TAGS or tag in RAW_TAGS or (not closing and attrs.rstrip().endswith("/")):
                continue
            if not closing:
                inline[tag] += 1
            elif inline[tag]:
                inline[tag] -= 1
            elif dropped:
                # the end of an element around a dropped one
                i = innermost(lambda d: d.inline[tag])
                if i is not None:
                    leave(i, False)
                    inline[tag] -= 1
            continue
        if tag in ("option", "hr") and dropped and dropped[-1].tag == "select" and dropped[-1].head:
            continue
        if closing:
            up = node
            while up.parent and up.tag != tag:
                up = up.parent
            found = up.tag == tag and up.parent is not None
            if found:
                last = len(dropped)
                while last and up.depth <= dropped[last - 1].node.depth:
                    last -= 1
                leave(last, False)
            flush()
            if found:
                node = up.parent
            continue
        flush()
        if tag in VOID_TAGS:
            continue
        if not (dropped and node is dropped[-1].node) and (
                node.tag == "p" or (node.tag == tag and tag in ("li", "dt", "dd", "option", "tr", "td", "th"))):
            node = node.parent or root
        names = " ".join(a or b or c for a, b, c in _NAME.findall(attrs)).lower() if attrs else ""
        node = _Node(tag, names, node)
        in_link = 0
    leave(0, False)
    flush()
    return out


def _marks(node: _Node) -> bool:
    """Whether an element's tag or names are those of boilerplate."""
    return not node.around and (node.tag in BOILERPLATE_TAGS or bool(node.names and BOILERPLATE_NAMES.search(node.names)))


def find_around(page_blocks: list[_Block]) -> None:
    """Sets ``around`` on the elements that hold the page's content.

    They are the page's main and article element with all elements around
    it, or, on a page without, the elements around most of its text. Text in
    links does not count. An article stands against the text beside it, where
    each element of boilerplate around either makes it count ``MARK`` times less.
    """
    text: dict[_Node, int] = {}
    beside: dict[_Node, float] = {}
    marks: dict[_Node | None, int] = {None: 0}
    plain: dict[_Node, int] = {}  # text outside boilerplate elements other than forms
    inner: dict[_Node, dict[_Node, None]] = {}
    for b in page_blocks:
        up, path = b.node, []
        while up is not None:
            path.append(up)
            up = up.parent
        for n in reversed(path):
            if n not in marks:
                marks[n] = marks[n.parent] + _marks(n)
                if n.parent is not None:
                    inner.setdefault(n.parent, {})[n] = None
        size = len(b.text) - min(b.link_chars, len(b.text))
        good = size * all(n.tag == "form" or n.tag not in BOILERPLATE_TAGS for n in path)
        for n in path:
            text[n] = text.get(n, 0) + size
            beside[n] = beside.get(n, 0.0) + size * MARK ** -float(marks[b.node])
            plain[n] = plain.get(n, 0) + good
    if not page_blocks:
        return
    root = top = path[-1]
    articles = [n for n in text if n.tag in CONTENT_TAGS]
    while articles:
        value = {n: ARTICLE * text[n] * MARK ** -float(marks[n]) for n in articles}
        best = max(articles, key=value.__getitem__)
        if value[best] < beside[top] - beside[best]:
            break
        found = set(BOILERPLATE_NAMES.findall(best.names))
        for n in inner[best.parent]:  # articles of the same kind
            if n.tag == best.tag and found.issuperset(BOILERPLATE_NAMES.findall(n.names)):
                n.around = True
        top = up = best
        while up is not None:
            up.around = True
            up = up.parent
        if top.tag == "article":
            break
        articles = [n for n in articles if n is not top and _within(n, top)]
    while top.tag not in CONTENT_TAGS and top in inner:
        best = max(inner[top], key=plain.__getitem__)
        if best not in inner or plain[best] <= (MOST_MARKED if _marks(best) else MOST) * plain[root]:
            break
        best.around, top = True, best


def _within(node: _Node | None, top: _Node) -> bool:
    while node is not None and node.depth > top.depth:
        node = node.parent
    return node is top


def block_score(b: _Block) -> float:
    """Classifier's score of a block: above 0 for content."""
    w = WEIGHTS
    s = w["bias"]
    content = boiler = header = named = good = False
    up = b.node
    while up.parent is not None:
        if up.tag in CONTENT_TAGS:
            content = True
            header = header or (boiler and up.tag == "article")
        elif up.tag in BOILERPLATE_TAGS and not (up.tag == "form" and up.around):
            boiler = True
        if up.names:
            if BOILERPLATE_NAMES.search(up.names):
                named = named or not up.around
            elif CONTENT_NAMES.search(up.names):
                good = True
        up = up.parent
    inner_header = header and any_header(b.node)
    s += w["content_tag"] * content + w["boilerplate_tag"] * boiler + w["boilerplate_name"] * named + w["content_name"] * good
    s += w["header_in_article"] * inner_header
    n_words = len(b.text.split())
    s += w["words"] * (math.log(n_words + 1) - 1)
    s += w["links"] * min(1.0, b.link_chars / len(b.text))
    s += w["sentence"] * (b.text[-1] in ".!?…。:\"”»")
    tag = b.node.tag
    s += w["heading"] * (len(tag) == 2 and tag[0] == "h" and tag[1].isdigit())
    s += w["item"] * (tag in ("li", "td", "th", "dt", "dd") and n_words < 6)
    s += w["mark"] * ("©" in b.text)
    return s


def any_header(node: _Node) -> bool:
    """Whether the only boilerplate element between a block and its article is a header with the block as its heading."""
    heading = False
    while node.parent is not None and node.tag != "article":
        if node.tag in ("h1", "h2"):
            heading = True
        elif node.tag in BOILERPLATE_TAGS and node.tag != "header" and not (node.tag == "form" and node.around):
            return False
        node = node.parent
    return heading


def _distance(a: _Node, b: _Node) -> int:
    """Steps between two elements through their nearest common one."""
    n = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        n += 1
    return n


def edges(page_blocks: list[_Block]) -> list[tuple[int, int, int]]:
    """Smoothness edges ``(i, j, capacity)``."""
    out, last_under = [], {}
    for i, b in enumerate(page_blocks):
        if i:
            d = _distance(page_blocks[i - 1].node, b.node)
            out.append((i - 1, i, round(UNIT * NEAR / (1 + d))))
        parent = b.node.parent or b.node
        j = last_under.get(id(parent))
        if j is not None and j != i - 1:
            out.append((j, i, round(UNIT * SIBLING)))
        last_under[id(parent)] = i
    return out


def min_cut(scores: list[int], links: list[tuple[int, int, int]]) -> list[bool]:
    """Side of the source (True) of each node: terminal capacities from ``scores``, undirected ``links``.

    Shortest augmenting paths in level graphs (Dinic); a path starts at a node
    with source capacity left and ends at one with sink capacity left.
    """
    n = len(scores)
    supply, demand = [max(0, s) for s in scores], [max(0, -s) for s in scores]
    to, cap, out = [], [], [[] for _ in range(n)]
    for i, j, c in links:
        if c > 0:
            out[i].append(len(to))
            to.append(j)
            cap.append(c)
            out[j].append(len(to))
            to.append(i)
            cap.append(c)
    while True:
        level = [-1] * n
        queue = deque(i for i in range(n) if supply[i])
        for i in queue:
            level[i] = 0
        reached = False
        while queue:
            i = queue.popleft()
            reached = reached or demand[i] > 0
            for e in out[i]:
                j = to[e]
                if cap[e] and level[j] < 0:
                    level[j] = level[i] + 1
                    queue.append(j)
        if not reached:
            return [x >= 0 for x in level]
        turn = [0] * n
        for start in range(n):
            while supply[start]:
                path, i = [], start
                while not demand[i]:
                    moved = False
                    while turn[i] < len(out[i]):
                        e = out[i][turn[i]]
                        if cap[e] and level[to[e]] == level[i] + 1:
                            path.append(e)
                            i = to[e]
                            moved = True
                            break
                        turn[i] += 1
                    if not moved:
                        if not path:
                            break
                        e = path.pop()
                        i = to[e ^ 1]
                        turn[i] += 1
                if not demand[i]:
                    break
                flow = min([supply[start], demand[i], *(cap[e] for e in path)])
                supply[start] -= flow
                demand[i] -= flow
                for e in path:
                    cap[e] -= flow
                    cap[e ^ 1] += flow


def main_text(page: str) -> str:
    """Main text of one page: its content blocks joined by empty lines."""
    found = blocks(page)
    find_around(found)
    side = min_cut([round(UNIT * block_score(b)) for b in found], edges(found))
    return "\n\n".join(b.text for b, keep in zip(found, side, strict=True) if keep)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every row.

    A null page is taken as empty and gives the empty text; a page cut off
    inside a tag, script or comment is read as far as it goes; repeated rows
    and null ids stay; other columns are not read.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(p) if p else "" for p in batch.column(2).to_pylist()]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(sizes)],
                                          names=["page_id", "url", "text", "n_chars"])

    narrow = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].alias("url"), pages[html_col].alias("html"))
    return map_slices(narrow, "html", run, "page_id long, url string, text string, n_chars long")
