"""Main text of web pages by composite text density.

A page is parsed into a tree.  For every node the characters, tags, link
characters and link tags below it give its composite density: characters per
tag, adjusted by how much of them is in links.  Elements that only dress a
line (bold, line breaks, spans) are text, not tags.  The node whose children's
densities have the largest sum is the core of the article; of equal ones an
``article`` or ``main`` element.  The smallest density on the path from it up
to the body, with all that these nodes hold, is the threshold: going up that
path, siblings at least that dense belong to the text too, and headings.

Parts that are no article by their element, role or class (menus, page
headers, footers, sidebars, notices, adverts, forms, comments) are left out
of the sums and of the text.  A name alone decides nothing against the text: an
element with such a name that holds most of the body's characters outside
links stays.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of the HTML standard, and words that pages use
# in class and id names.
VOID = frozenset("area base br col embed hr img input link meta param source "
                 "track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes "
                "noscript".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog "
    "dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody tfoot thead tr ul".split())
NO_TEXT = frozenset(
    "script style noscript template head title nav footer aside form iframe "
    "object svg math canvas audio video map button select textarea input "
    "dialog menu noembed noframes datalist search".split())
NO_TEXT_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert "
    "alertdialog menu menubar toolbar status tooltip".split())
NO_TEXT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising "
    "adsense adslot sponsor sponsors sponsored promo promos promotion "
    "promoted banner banners cookie cookies consent gdpr notice notices "
    "notification notifications alert alerts popup modal overlay newsletter "
    "subscribe subscription signup login paywall disclaimer sidebar sidebars "
    "widget widgets related recommended recommendations trending share "
    "sharing social nav navbar navigation navi menu menus breadcrumb "
    "breadcrumbs pagination pager toolbar masthead footer topbar skip "
    "hidden search".split())
COMMENT_WORDS = frozenset(
    "comment comments commentlist commentary disqus respond replies reply "
    "discussion usercomments".split())
LANDMARK = ("article", "main")
# Dress of a line: neither tags nor candidates.
INLINE = frozenset(
    "abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd "
    "mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u "
    "var wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_MARKUP = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*))")
_STOP = re.compile("[>\"']")
_ATTRIBUTE = re.compile(
    r"([^\s=\"'/<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[a-z0-9]+")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}
# what an opening element ends (the outermost of it), and the elements that
# keep it from being ended
_SCOPE = frozenset("table td th caption button object html body".split())
_CELLS = frozenset(("td", "th"))
_PARTS = frozenset("tbody thead tfoot tr td th".split())
_ENDED = [(frozenset(("p",)), _SCOPE),
          (frozenset(("li",)), frozenset("ul ol menu dir".split())),
          (frozenset(("dt", "dd")), frozenset(("dl",))),
          (frozenset(("tr", "td", "th")), frozenset(("table",))),
          (_CELLS, frozenset(("tr", "table"))),
          (_PARTS, frozenset(("table",))),
          (frozenset(("option",)), frozenset(("select", "datalist"))),
          (frozenset(("head",)), frozenset())]
_ENDS = {"li": 1, "dt": 2, "dd": 2, "tr": 3, "td": 4, "th": 4, "tbody": 5,
         "tfoot": 5, "option": 6, "body": 7}
_ENDING = frozenset().union(*(tags | scope for tags, scope in _ENDED))


class Node:
    __slots__ = ("tag", "parent", "children", "skip", "words", "chars",
                 "tags", "link_chars", "link_tags", "density", "total",
                 "whole", "ended")

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent = tag, parent
        self.children: list[Node | str] = []
        self.skip = False
        self.words: frozenset | set = frozenset()
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = self.whole = 0.0
        # per kind of _ENDED the outermost open element that it would end
        up = parent.ended if parent else (None,) * len(_ENDED)
        self.ended = up if tag not in _ENDING else tuple(
            (x or self) if tag in tags else None if tag in scope else x
            for x, (tags, scope) in zip(up, _ENDED))


def _judge(node: Node, attributes: str, in_article: bool) -> None:
    """Mark ``node`` if its element, role, style or names say no article."""
    tag = node.tag
    if tag in NO_TEXT:
        node.skip = True
    elif tag == "header":
        node.skip = not in_article
    if not attributes or tag in ("html", "body"):
        return
    names: set[str] = set()
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), (a or b or c).lower()
        if key in ("class", "id"):
            names.update(_WORDS.findall(value))
        elif key == "role" and value in NO_TEXT_ROLES or key == "hidden" \
                or key == "aria-hidden" and value == "true" \
                or key == "style" and re.search(
                    r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            node.skip = True
    if tag == "main":
        return
    if names & COMMENT_WORDS:
        node.skip, node.words = True, names
    elif names & NO_TEXT_WORDS and tag != "article" \
            and not names & {"has", "with", "no"}:
        node.skip, node.words = True, names


def _tag_end(page: str, at: int) -> int:
    """Where the tag whose name ends at ``at`` is closed: the first ``>``
    outside quotes, or, with a quote that nothing closes, the first at all."""
    i = at
    while m := _STOP.search(page, i):
        if m[0] == ">":
            return m.start()
        i = page.find(m[0], m.end()) + 1
        if not i:
            break
    return page.find(">", at)


def parse(page: str) -> Node:
    """The page as a tree; unclosed, misnested and unknown elements are
    accepted the way browsers do in the common cases.  The time grows with
    the page's length, however deep or broken it is."""
    root = node = Node("#root", None)
    opened: Counter[str] = Counter()    # tags of the nodes above
    at, text_from, end = 0, 0, len(page)
    last = page.rfind(">")

    def leave(x: Node) -> None:
        """Close everything up to ``x``."""
        nonlocal node
        while node is not x:
            opened[node.tag] -= 1
            node = node.parent
        opened[x.tag] -= 1
        node = x.parent

    while m := _MARKUP.search(page, at):
        tag = m[2]
        if tag:
            # without a ">" behind it, it is text
            stop = _tag_end(page, m.end()) if m.end() <= last else -1
            at = stop + 1 if stop >= 0 else m.end()
            if stop < 0:
                continue
        else:
            close = "-->" if m[0] == "<!--" else ">"
            stop = page.find(close, m.end())
            at = stop + len(close) if stop >= 0 else end
        if m.start() > text_from:
            node.children.append(html.unescape(page[text_from:m.start()]))
        text_from = at
        if not tag:
            continue
        tag = tag.lower()
        if m[1]:
            if opened[tag]:
                x = node
                while x.tag != tag:
                    x = x.parent
                leave(x)
            continue
        if tag in BLOCK and (x := node.ended[0]):
            leave(x)
        if tag in _ENDS and (x := node.ended[_ENDS[tag]]):
            leave(x)
        child = Node(tag, node)
        attributes = page[m.end():stop]
        _judge(child, attributes, opened["article"] > 0)
        node.children.append(child)
        if tag in RAW:
            stop = _RAW_END[tag].search(page, at)
            stop = stop.start() if stop else end
            if tag == "textarea":
                child.children.append(html.unescape(page[at:stop]))
            at = text_from = stop
        elif tag in VOID or attributes.endswith("/") and tag not in (
                "p", "div", "article", "section", "main", "span"):
            continue
        node = child
        opened[tag] += 1
    if text_from < end:
        node.children.append(html.unescape(page[text_from:]))
    return root


def _in_order(root: Node) -> list[Node]:
    """All nodes, parents first."""
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        out.append(n)
        todo += [c for c in reversed(n.children) if type(c) is Node]
    return out


def _count(nodes: list[Node]) -> float:
    """Take the counts below all nodes (parents first); returns the share of
    the body's characters that is in links."""
    for n in reversed(nodes):
        n.chars = n.tags = n.link_chars = n.link_tags = 0
        for c in n.children:
            if type(c) is str:
                n.chars += len(" ".join(c.split()))
            else:
                n.chars += c.chars
                n.tags += c.tags + (c.tag not in INLINE)
                n.link_chars += c.chars if c.tag == "a" else c.link_chars
                n.link_tags += c.link_tags + (c.tag == "a")
    body = next((n for n in nodes if n.tag == "body"), nodes[0])
    return body.link_chars / max(1, body.chars)


def _density(n: Node, in_links: float) -> float:
    return density(n.chars, n.tags, n.link_chars, n.link_tags, in_links)


def _measure(root: Node) -> list[Node]:
    """Take the densities of all nodes, then drop what is no article and take
    those of the rest; returns the remaining nodes, parents first."""
    nodes = _in_order(root)
    in_links = _count(nodes)
    for n in nodes:
        n.whole = _density(n, in_links)
    # names are no reason to drop most of the text
    body = next((n for n in nodes if n.tag == "body"), root)
    most = (body.chars - body.link_chars) / 2
    for n in nodes:
        if n.skip and n.words and not n.words & COMMENT_WORDS \
                and n.chars - n.link_chars > most:
            n.skip = False
    # a wrapper named after what stands beside the article is no such part
    seen: set[int] = set()
    for n in nodes:
        if n.tag == "main" or n.tag == "article" and not n.skip:
            x, above = n.parent, []
            while x is not None and id(x) not in seen \
                    and not (x.skip and not x.words) \
                    and not x.words & COMMENT_WORDS:
                above.append(x)
                seen.add(id(x))
                x = x.parent
            if x is None or id(x) in seen and not x.skip:
                for x in above:
                    x.skip = False
    for n in nodes:
        if n.children:
            n.children = [c for c in n.children
                          if type(c) is str or not c.skip]
    nodes = _in_order(root)
    in_links = _count(nodes)
    for n in nodes:
        n.density = _density(n, in_links)
    for n in nodes:
        n.total = sum(c.density for c in n.children
                      if type(c) is Node and c.tag not in INLINE)
    return nodes


def density(chars: int, tags: int, link_chars: int, link_tags: int,
            in_links: float) -> float:
    """Composite text density: characters per tag times the logarithm of how
    little of them is links.  The base grows with the link characters of the
    node and of the page; 1 is added to it, as it would be 1 on pages without
    links.  Zero divisors count as 1."""
    if not chars:
        return 0.0
    tags = max(1, tags)
    base = 1 + math.log(chars / max(1, chars - link_chars) * link_chars
                        + in_links * chars + math.e)
    return chars / tags * max(0.0, math.log(
        chars / max(1, link_chars) * tags / max(1, link_tags), base))


def _select(root: Node, nodes: list[Node]) -> set[int]:
    """The chosen subtrees, as ids of their top nodes."""
    body = next((n for n in nodes if n.tag == "body"), root)
    inside = [n for n in _in_order(body) if n.tag not in INLINE]
    core = max(inside, key=lambda n: (n.total, n.tag in LANDMARK, n.density))
    if core.total == 0:  # no elements with text: the text itself
        core = max(inside, key=lambda n: (n.chars, -n.tags))
    path, x = [], core
    while x is not None and x.tag not in ("html", "#root"):
        path.append(x)
        x = x.parent
    if not path:
        return {id(root)}
    limit = min(n.whole for n in path)
    chosen = {id(core)}
    on_path = {id(n) for n in path}
    for n in path[1:]:
        for c in n.children:
            if type(c) is Node and id(c) not in on_path and c.chars \
                    and 2 * c.link_chars < c.chars and (
                        c.density >= limit or c.tag in HEADINGS):
                chosen.add(id(c))
    return chosen


def main_text(page: str | None) -> str:
    """The article's blocks joined by line ends: character references
    decoded, white space inside a block one space, trimmed, empty blocks left
    out.  Empty for null, empty and textless pages."""
    if not page:
        return ""
    root = parse(page)
    nodes = _measure(root)
    chosen = _select(root, nodes)
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        line.clear()
        if text:
            blocks.append(text)

    # (node, child position, taken) of the open nodes
    todo: list[list] = [[root, 0, id(root) in chosen]]
    while todo:
        top = todo[-1]
        node, i, taken = top
        if i == len(node.children):
            if node.tag in BLOCK:
                flush()
            elif node.tag in ("td", "th", "br"):
                line.append(" ")
            todo.pop()
            continue
        top[1] += 1
        child = node.children[i]
        if type(child) is str:
            if taken:
                line.append(child)
            continue
        if child.tag in BLOCK:
            flush()
        todo.append([child, 0, taken or id(child) in chosen])
    flush()
    return "\n".join(blocks)


def extract(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """``pages`` plus text and n_chars (code points), one row per row; a null
    or textless page gives the empty text.  Columns of these names are
    replaced, others kept; repeated rows give repeated rows, an empty table
    none.  One pass, no shuffle; a page of any length is handled whole, one at
    a time, in time that grows with its length."""
    keep = [c for c in pages.columns if c not in ("text", "n_chars",
                                                  html_column)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(p.as_py()) for p in b.column(html_column)]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in keep], pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                [*keep, "text", "n_chars"])

    kept = pages.select(*keep, F.col(html_column).cast("string"))
    schema = kept.drop(html_column).schema.add("text", "string").add(
        "n_chars", "long")
    return kept.mapInArrow(run, schema)


def op1_query(pages: DataFrame) -> DataFrame:
    return extract(pages.select("page_id", "url", "html"))
