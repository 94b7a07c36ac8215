"""Main text of web pages by scoring the tree.

Paragraphs pass points for their length and their commas to their ancestors: all to the parent, half to
the next, a ninth, a twelfth and so on further up. Parts that are boilerplate by tag, role or class pass
nothing. A container's points are discounted by the share of its text that is in links. The best
container is kept, with those of its siblings that score well or read like paragraphs, without the
boilerplate parts and link lists inside.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import batches_of, ship

#: Elements of HTML by kind.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript template iframe xmp noembed noframes svg math".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary "
    "table tbody td tfoot th thead tr ul".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
BOILERPLATE = set(
    "nav header footer aside form button select option menu dialog head label fieldset object canvas "
    "audio video".split()
)
ROLES = set("navigation banner contentinfo complementary search menu menubar dialog alert alertdialog".split())
#: An open element of the second kind ends where one of the first begins.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "tbody": {"tr", "td", "th", "thead"}, "option": {"option"},
}
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|adsense|sponsor(?:ed)?|promos?|promotions?|banners?|cookies?|consent|gdpr|"
    r"notices?|alerts?|comments?|disqus|replies|respond|sidebars?|side|rail|shar(?:e|ing)|social|related|recommend(?:ed|ations)?|"
    r"newsletters?|subscri(?:be|ption)|sign-?up|popups?|modals?|overlays?|menus?|nav|navbar|navigation|"
    r"breadcrumbs?|footers?|headers?|masthead|pagination|pager|widgets?|toolbars?|skip|hidden|copyright|"
    r"login|search|tags|outbrain|taboola|paywall|byline-social)(?:$|[\s_-]|\d)",
    re.I,
)
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"']+))?")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Node:
    tag: str
    parent: int
    boilerplate: bool
    children: list[int] = field(default_factory=list)
    own: int = 0  # characters of text directly inside or in inline elements
    text: int = 0  # characters below
    linked: int = 0  # of these in links
    commas: int = 0
    points: float = 0.0

    @property
    def link_share(self) -> float:
        return self.linked / self.text if self.text else 0.0


@dataclass
class Tree:
    nodes: list[Node]
    texts: list[tuple[int, bool, str]]  # block, in a link, text; an empty text is a break


def is_boilerplate(tag: str, attributes: str) -> bool:
    if tag in BOILERPLATE:
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    given = {k.lower(): (v or "").strip("\"'") for k, v in ATTRIBUTE.findall(attributes)}
    return (
        given.get("role", "").lower() in ROLES
        or given.get("aria-hidden", "").lower() == "true"
        or "hidden" in given
        or bool(HIDDEN.search(given.get("style", "")))
        or any(NAMES.search(given.get(key, "")) for key in ("class", "id"))
    )


def parse(page: str) -> Tree:
    """Blocks of a page in order; whatever is not well-formed is read as browsers do, roughly."""
    nodes, texts = [Node("html", -1, False)], []
    open_: list[tuple[str, int]] = [("html", 0)]  # name and block; inline elements share their block's
    opened: Counter[str] = Counter()  # how often each name is open, so that what is not is not looked for
    links = 0
    at = 0

    def close(depth: int) -> None:
        nonlocal links
        links -= sum(name == "a" for name, _ in open_[depth:])
        opened.subtract(name for name, _ in open_[depth:])
        del open_[depth:]

    def end(names: set[str], within: set[str]) -> None:
        if not any(opened[name] > 0 for name in names):
            return None
        for depth in range(len(open_) - 1, 0, -1):
            if open_[depth][0] in names:
                return close(depth)
            if open_[depth][0] in within:
                return None

    def say(raw: str) -> None:
        if raw:
            texts.append((open_[-1][1], links > 0, html.unescape(raw) if "&" in raw else raw))

    last = page.rfind(">") + 1  # no tag ends behind it
    while at < last and (found := TAG.search(page, at, last)):
        say(page[at : found.start()])
        at = found.end()
        if found[0].startswith("<!--") and not found[0].endswith("-->"):
            at = len(page)
        closing, tag, attributes = found.group(1, 2, 3) if found[2] else found.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            if tag in BLOCKS:
                end({tag}, set())
                texts.append((open_[-1][1], False, ""))
            else:
                end({tag}, BLOCKS)
            continue
        if tag in RAW:
            if not attributes.endswith("/"):
                stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
                at = stop.end() if stop else len(page)
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                texts.append((open_[-1][1], False, ""))
            continue
        if tag in BLOCKS:
            if tag != "html":
                end({"p"}, {"table", "td", "th", "body", "article", "section", "div"} - {"p"})
            if tag in ENDS:
                end(ENDS[tag], {"ul", "ol", "dl", "table", "select"})
        block = tag in BLOCKS or tag in BOILERPLATE
        odd = is_boilerplate(tag, attributes)
        if block or odd:
            nodes.append(Node(tag, open_[-1][1], odd))
            nodes[open_[-1][1]].children.append(len(nodes) - 1)
            open_.append((tag, len(nodes) - 1))
            texts.append((len(nodes) - 1, False, ""))
        else:
            open_.append((tag, open_[-1][1]))
            links += tag == "a"
        opened[tag] += 1
    say(page[at:].split("<!--", 1)[0])
    return Tree(nodes, texts)


def scored(tree: Tree) -> list[bool]:
    """Sum up texts and points; which nodes are boilerplate or inside."""
    nodes = tree.nodes
    out: list[bool] = []
    for node in nodes:
        out.append(node.boilerplate or (node.parent >= 0 and out[node.parent]))
    for block, link, text in tree.texts:
        if text and not out[block]:
            n = len(" ".join(text.split()))
            nodes[block].own += n
            nodes[block].text += n
            nodes[block].commas += text.count(",") + text.count("،") + text.count("，") + text.count("、")
            nodes[block].linked += n * link
    for i in range(len(nodes) - 1, 0, -1):
        parent = nodes[nodes[i].parent]
        parent.text += nodes[i].text
        parent.linked += nodes[i].linked
    for i, node in enumerate(nodes):
        if not node.own or out[i] or node.tag in HEADINGS:
            continue
        points = (min(node.own / 25, 1) + node.commas + min(node.own / 100, 3)) * (1 - node.link_share)
        at, level = node.parent, 1
        if node.tag in ("div", "section", "article", "main", "body", "html"):  # text without a paragraph
            node.points += points
            level = 2
        while at >= 0:
            nodes[at].points += points / (1, 1, 2, 9)[level] if level < 4 else points / (3 * level)
            at, level = nodes[at].parent, level + 1
    for node in nodes:
        node.points *= 1 - node.link_share
    return out


def main_text(page: str | None) -> str:
    """The main text of a page; empty for a null page or one without text."""
    tree = parse(page or "")
    nodes = tree.nodes
    out = scored(tree)
    best = max((i for i in range(len(nodes)) if not out[i]), key=lambda i: (nodes[i].points, -i))
    if nodes[best].points <= 0:
        best = 0
    keep = {best}
    least = max(10.0, nodes[best].points / 5)
    if nodes[best].tag not in ("body", "html"):
        for i in nodes[nodes[best].parent].children if nodes[best].parent >= 0 else []:
            node = nodes[i]
            reads = node.tag == "p" and node.text and (
                node.link_share < 0.25 if node.text > 80 else node.link_share == 0
            )
            title = node.tag in HEADINGS and i < best and not node.linked
            if not out[i] and (node.points >= least or reads or title):
                keep.add(i)
    kept = [False] * len(nodes)
    for i, node in enumerate(nodes):
        inside = i in keep or (node.parent >= 0 and kept[node.parent])
        links = node.tag in ("ul", "ol", "div", "table", "section") and node.link_share > 0.5
        kept[i] = inside and not out[i] and (i in keep or not links)
    pieces: list[str] = []
    last = -1
    for block, _, text in tree.texts:
        if not text or block != last:
            pieces.append(" ")
        if kept[block]:
            pieces.append(text)
        last = block
    return " ".join("".join(pieces).split())


def main_texts(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page, from the whole ``html``.

    A null or empty page has an empty text. Repeated rows each give a row; null ids and urls stay null;
    other columns are left out; an empty table gives no rows.
    """
    ship(pages.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, "html", 4 << 20):
            texts = [main_text(page) for page in batch.column(2).to_pylist()]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(text) for text in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    source = pages.select(*(F.col(x).cast(k) for x, k in (("page_id", "long"), ("url", "string"), ("html", "string"))))
    return source.mapInArrow(rows, "page_id long, url string, text string, n_chars long")
