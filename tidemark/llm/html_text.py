"""Main text of web pages by composite text density.

Each element gets a density: characters per tag, raised where few of its characters and tags are links. The
element whose children have the largest sum of densities holds the article; the least density on the path from
the body to it is the threshold for what else belongs to the content.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import col

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup.
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
#: Elements that begin and end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre section summary table tbody td tfoot "
    "th thead tr ul caption".split()
)
#: An open paragraph ends where one of these begins.
ENDS_P = BLOCKS - {"br", "body", "html"}
#: What an element of the key ends if it is open, up to the nearest of the second set.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Never part of an article.
DROPPED = frozenset(
    "script style noscript template head title nav footer aside form button select textarea input iframe object embed "
    "svg canvas audio video dialog menu xmp noembed noframes".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Words of class names and ids of what surrounds an article.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner banners sponsor sponsored promo promotion sidebar menu "
    "nav navbar navigation breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices popup modal "
    "overlay newsletter subscribe subscription social share sharing related recommended recommendations comment comments "
    "disqus replies widget toolbar pagination pager login signup search skip".split()
)
#: Words that say no more about an element than that it holds something.
GENERIC = frozenset(
    "the box block bar wrap wrapper container section list area panel link links button buttons form slot unit post posts page "
    "site article articles story stories item items content inner outer main left right top bottom head body group row col "
    "column icon icons holder zone region module js global primary secondary".split()
)
#: Names of NAMES that say it of a longer name too that begins or ends with them, outside an article.
STRONG = frozenset(
    "advert adverts advertisement advertising adsense sponsored sidebar menu nav navbar navigation breadcrumb breadcrumbs "
    "footer masthead cookie cookies consent gdpr popup modal newsletter pagination disqus comments".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup header".split())
#: Outside an article they are menus if nearly all of their text is in three links or more.
LISTS = frozenset("ul ol dl table div section p".split())
HEADERS = frozenset(("header", "topbar"))
HOLDERS = frozenset(("article", "main"))
KEPT = HOLDERS | {"html", "body", "#root"}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?")
_NAMED = re.compile(r"\b(?:class|id|role|hidden|aria-hidden)\b", re.I)


class Node:
    __slots__ = ("tag", "parent", "parts", "noise", "named", "inside", "holds", "chars", "tags", "link_chars", "link_tags", "density", "sums")

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent, self.parts = tag, parent, []
        self.noise = self.named = self.inside = self.holds = False
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sums = 0.0


def is_noise(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether the names an element bears say that it surrounds the article."""
    if tag == "header" and not in_article:
        return True
    if not attributes or not _NAMED.search(attributes):
        return False
    for found in _ATTRIBUTE.finditer(attributes):
        name, value = found[1].lower(), (found[2] or found[3] or found[4] or "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and value.strip() in ROLES:
            return True
        if name in ("class", "id"):
            for one in value.split():
                words = re.findall(r"[a-z]+", one)
                if not words or words[0] in ("has", "with", "no", "without"):
                    continue
                listed = any(w in NAMES for w in words) and all(w in NAMES or w in GENERIC or len(w) == 1 for w in words)
                outside = not in_article and (words[0] in STRONG or words[-1] in STRONG or not HEADERS.isdisjoint(words))
                if listed or outside:
                    return True
    return False


def parse(html: str) -> list[Node]:
    """The elements in page order, the root first. Unclosed and misnested tags are closed where they must end."""
    root = Node("#root", None)
    nodes, at, open_ = [root], 0, root
    while True:
        found = _TAG.search(html, at)
        text = html[at : found.start() if found else len(html)]
        if text:
            open_.parts.append(unescape(text))
        if not found:
            return nodes
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        if found[1] or found[4]:
            node = open_
            while node is not root and node.tag != tag:
                if tag not in BLOCKS and node.tag in BLOCKS or tag == "p" and node.tag in ENDS_P:
                    node = root  # an inline end tag does not reach out of its block
                    break
                node = node.parent
            if node is not root:
                open_ = node.parent
            continue
        if tag in ENDS_P:
            open_ = _close(open_, {"p"}, ENDS_P - {"p"})
        if tag in ENDS:
            open_ = _close(open_, *ENDS[tag])
        node = Node(tag, open_)
        holder = open_
        while holder is not None and holder.tag not in HOLDERS:
            holder = holder.parent
        node.inside = holder is not None
        node.named = tag not in ("html", "body") and is_noise(tag, found[3] or found[6], node.inside)
        # An article may bear any name, but not where it is a part of another one, like a comment.
        node.noise = tag in DROPPED or (node.named and (tag not in HOLDERS or (tag == "article" and in_article(open_))))
        open_.parts.append(node)
        nodes.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}[^>]*(?:>|\Z)", re.I).search(html, at)
            at = end.end() if end else len(html)
        elif tag not in VOID:
            open_ = node


def in_article(node: Node | None) -> bool:
    while node is not None and node.tag != "article":
        node = node.parent
    return node is not None


def _close(node: Node, tags: set[str], barrier) -> Node:
    """The element that stays open after the nearest of `tags` has ended."""
    last, seen = None, node
    while seen is not None and seen.tag not in barrier:
        if seen.tag in tags:
            last = seen
        seen = seen.parent
    return last.parent if last is not None else node


def measure(nodes: list[Node]) -> None:
    """Counts, densities and density sums. What surrounds an article counts for nothing."""
    for node in reversed(nodes):  # what holds the article is kept whatever its name
        if node.parent is not None and (node.holds or (node.tag in HOLDERS and not node.noise)):
            node.parent.holds = True
    for node in nodes:
        if node.holds and node.tag not in ("nav", "footer", "aside") and not (node.tag == "article" and node.noise):
            node.noise = False
        if node.parent is not None and node.parent.noise:
            node.noise = True
    for node in reversed(nodes):
        if node.noise:
            continue
        node.chars += sum(len("".join(p.split())) for p in node.parts if isinstance(p, str))
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1
        node.noise = node.tag in LISTS and not node.holds and not node.inside and node.link_tags > 2 and node.link_chars >= 0.9 * node.chars
        if node.noise:
            continue
        up = node.parent
        if up is not None:
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags
    body = next((n for n in nodes if n.tag == "body"), nodes[0])
    linked = body.link_chars / max(body.chars, 1)
    for node in nodes:
        if node.noise or not node.chars:
            continue
        chars, tags = node.chars, max(node.tags, 1)
        links, link_tags = max(node.link_chars, 1), max(node.link_tags, 1)
        base = log(chars / max(chars - node.link_chars, 1) * links + linked * chars + e)
        node.density = chars / tags * log(max(chars / links * tags / link_tags, 1)) / log(base)
    for node in nodes:
        if node.parent is not None:
            node.parent.sums += node.density


def goes_along(node: Node) -> bool:
    """Whether an element beside an article is a further part of it: another article, or a heading of what both are in."""
    return (node.tag == "article" and not node.named) or (node.tag in HEADINGS and node.inside)


def content(nodes: list[Node]) -> list[Node]:
    """The subtrees of the article, in page order."""
    inside = [n for n in nodes if not n.noise]
    best = max(inside, key=lambda n: n.sums, default=None)
    if best is None or not nodes[0].chars:
        return []
    if not best.sums:
        return [nodes[0]]
    path, holder = [], None
    node = best
    while node is not None and node.tag not in ("body", "#root"):
        path.append(node)
        if node.tag == "article" or (node.tag == "main" and (holder is None or holder.tag != "article")):
            holder = node
        node = node.parent
    if holder is not None:
        return [n for n in inside if n is holder or (n.parent is holder.parent and n.chars and goes_along(n))]
    if not path:
        return [best]
    threshold = min(n.density for n in path)
    top = path[-1]
    # Beside the container of the best, what is as dense as its path.
    near = [n for n in inside if n.parent is top.parent and n.chars and (n is top or n.density >= threshold)]
    return near or [top]


def blocks(top: Node) -> list[str]:
    """The text below an element, a string for each block."""
    out: list[str] = []
    line: list[str] = []

    def end() -> None:
        text = " ".join("".join(line).split())
        if text:
            out.append(text)
        line.clear()

    todo: list = [top]
    while todo:
        part = todo.pop()
        if part is None:
            end()
        elif isinstance(part, str):
            line.append(part)
        elif not part.noise:
            if part.tag in BLOCKS:
                end()
                todo.append(None)
            todo.extend(reversed(part.parts))
    end()
    return out


def main_text(html: str | None) -> str:
    """The article of a page: its blocks joined by line ends; empty if there is none."""
    if not html:
        return ""
    nodes = parse(html)
    measure(nodes)
    return "\n".join(b for node in content(nodes) for b in blocks(node))


def extract_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars (code points) for every page.

    The article is the element of largest density sum, widened to the `article` or `main` that it is in, with the other
    articles beside it and the headings of a `main` around them; without such, to its container below the body, with the containers that are at least as dense as the least dense
    element on the path from the body to it. Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
    comments are left out by element, role and name, lists of links outside an article too. A name counts if all its words
    are listed or generic; `share-price` and `related-work` are no such names. Character references are decoded, white space in a block becomes one space,
    blocks are joined by a line end.

    Null and empty pages, and those without text, have an empty text. Cut-off and broken markup is read as far
    as it goes. Repeated rows give equal rows, an empty table none. Null ids stay null; extra columns are ignored.
    """
    rows = pages.select(col(page_id).alias("page_id"), col(url).alias("url"), col(html).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(h.as_py()) for h in batch.column("html")], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], ["page_id", "url", "text"])

    kinds = [rows.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    found = rows.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string")
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
