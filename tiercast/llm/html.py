"""Main-text extraction with a site style tree.

All pages of a host are merged into one tree of styles: a node is the chain of element names and
class names from the body on. For each node the pages tell how its presentation (the styles of its
children) and its content (the text below it) are distributed, and the entropies of both,
relative to the number of pages, combine to the importance of the branch: what is the same on all
pages scores 0, what differs from page to page scores 1. Branches below ``LEAST_IMPORTANCE`` are
removed from each page. A branch is judged if it is on at least ``LEAST_PAGES`` pages, however many
pages its host has: each page looks up its own nodes, so its list of removed branches is bounded by
these, and a page is known by its host and a digest of its HTML.

Elements that say what they are need no statistics: scripts, styles, menus, forms and the like are
removed by name, role or class. Classes and ids count in any case and without a number at the end:
as a whole, and for the commonest names by their parts between hyphens and underscores, as in
``comment-list`` or ``site-footer``, unless the first part says that something has or lacks the rest
(``with-sidebar``). Names do not count for an article, a main element or what holds one, nor for
headings; ids of sections and headings are anchors; a part of a name does not count where most of the
page's text would go with it and no article would be left. Articles in an element of comments are
comments, so such an element counts as holding an article only if the page has none elsewhere. Where
a page has an article with at least as much text as all that is kept outside of articles, its main
text lies within articles; otherwise the articles may be teasers, and all that is kept is the main
text. A site may well repeat an article or its headings, so within an article a branch of low
importance is removed only if it is made of links, by half of its characters or more, and no heading;
what holds an article stays.

Pages are parsed three times, for the statistics, for the lookup and for the text, which costs less
than carrying the trees through a shuffle.

Results for odd input: a missing or empty page has no text; unclosed elements end with their parent,
and an unclosed tag at the end is dropped; a quote opens a value only after an equals sign and if it is
closed; elements deeper than ``DEEPEST`` open and close like others, and their styles and texts count
to their ancestor of that depth; a page without a host is judged among all such pages;
repeated rows get the same text each; an empty table gives an empty table; other columns do not
matter.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiercast.llm.common import in_arrow, slices, whole_text
from tiercast.llm.urls import host_of
from tiercast.operators.scratch import Scratch

LEAST_IMPORTANCE = 0.3
LEAST_PAGES = 4
# The weight of content grows with the number of styles below a node, as 1 - DAMPING ** n falls.
DAMPING = 0.9
# The style path of deeper elements is that of their ancestor of this depth.
DEEPEST = 64

# Elements and names of parts that are no main text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math".split())
NO_TEXT = RAW | frozenset(
    "head nav footer aside form button select option dialog menu object audio video canvas".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby"
    " s samp small span strike strong sub sup time tt u var wbr".split()
)
NOISE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert dialog menu menubar".split()
)
NOISE_NAMES = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments"
    " consent cookie cookies disqus footer gdpr masthead menu nav navbar navigation newsletter"
    " pagination popup promo promoted sidebar sitemap sponsor sponsored subscribe toolbar".split()
)
NOISE_PARTS = frozenset(
    "ad ads advert advertisement adverts breadcrumb breadcrumbs comment comments cookie cookies disqus"
    " footer gdpr nav navbar navigation newsletter sidebar sponsored".split()
)
# The first part of names that tell what something has, lacks or does with the rest.
QUALIFIERS = frozenset("with without has have no non not is hide show toggle js".split())
COMMENTS = frozenset("comment comments disqus".split())
MAIN = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
CLOSED_BY_BLOCK = frozenset(["p"])
SIBLINGS = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
SCOPES = frozenset("ul ol dl table article section div body main".split())
LISTS = frozenset("ul ol dl table select".split())

_TOKEN = re.compile(
    r"<!--(?:.*?)(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)"
    r"((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?+)*+)(>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]*+))?+"""
)
_NAME = re.compile(r"[a-z]+")
_NUMBER = "-_0123456789"
_PART = re.compile(r"[-_]+")


class Block(NamedTuple):
    """A run of text without a block element within, and the innermost open element around it."""

    element: Element
    text: str


class Element:
    __slots__ = (
        "name", "parent", "depth", "node", "scope", "list", "style", "path", "noise", "named",
        "parts", "in_comments", "holds", "plain", "children", "texts", "size", "linked",
    )

    def __init__(self, name: str, attributes: str, parent: Element | None) -> None:
        self.name = name
        self.parent = parent
        self.depth = 0 if parent is None else parent.depth + 1
        # The depth of the nearest element, itself included, that bounds what a block or item closes.
        self.scope = self.depth if parent is None or name in SCOPES else parent.scope
        self.list = self.depth if parent is None or name in LISTS else parent.list
        classes, role = "", ""
        whole: set[str] = set()
        if "=" in attributes:
            for key, value in _ATTRIBUTE.findall(attributes):
                key = key.lower()
                if not value:
                    continue
                if key in ("class", "id"):
                    value = value.strip("\"'").lower()
                    classes += " " + value
                    if key == "class" or name != "section":
                        whole.update(part.rstrip(_NUMBER) for part in value.split())
                elif key == "role":
                    role = value.strip("\"'").lower()
        self.plain = not classes
        # Numbers in names tell instances apart, not styles.
        names = _NAME.findall(classes) if classes else []
        self.style = name if not names else f"{name}.{'.'.join(sorted(set(names)))}"
        # The element whose style path, children and texts are meant.
        self.node = self if self.depth < DEEPEST else parent.node
        if self.node is not self:
            self.path = parent.path
        else:
            self.path = self.style if parent is None else f"{parent.path}/{self.style}"
        self.noise = name in NO_TEXT or role in NOISE_ROLES
        self.named = (
            name not in MAIN and name not in HEADINGS and not NOISE_NAMES.isdisjoint(whole)
        )
        parts: set[str] = set()
        if name not in MAIN and name not in HEADINGS:
            for one in whole:
                first, *rest = _PART.split(one.strip(_NUMBER))
                if rest and first not in QUALIFIERS:
                    parts.update((first, *rest))
        # Whether the part of a name says so.
        self.parts = not NOISE_PARTS.isdisjoint(parts)
        self.in_comments = (parent is not None and parent.in_comments) or (
            self.named and not COMMENTS.isdisjoint(whole)
        ) or not COMMENTS.isdisjoint(parts)
        # Whether it is an article or main element or one lies within, other than in comments there.
        self.holds = False
        self.children: list[str] = []
        self.texts: list[str] = []
        # Characters of text below, and those of them in links.
        self.size = self.linked = 0
        if parent is not None and self.node is self:
            parent.children.append(self.style)


def _decoded(text: str) -> str:
    return " ".join((html.unescape(text) if "&" in text else text).split())


def parse(page: str) -> tuple[list[Element], list[Block]]:
    """The elements of a page in order, and its blocks of text."""
    root = Element("html", "", None)
    elements, blocks, stack, pending = [], [], [root], []
    mains: list[Element] = []
    # The depths of the open elements by name.
    opened: dict[str, list[int]] = {}

    def add(text: str) -> None:
        pending.append(text)
        size = len(text) - text.count(" ")
        stack[-1].size += size
        if opened.get("a"):
            stack[-1].linked += size

    def flush() -> None:
        text = _decoded("".join(pending))
        pending.clear()
        if text:
            blocks.append(Block(stack[-1], text))

    def innermost(names: Iterable[str]) -> int:
        return max((opened[name][-1] for name in names if opened.get(name)), default=0)

    def close(index: int) -> None:
        if any(element.name not in INLINE for element in stack[index:]):
            flush()
        for element in stack[index:]:
            opened[element.name].pop()
        del stack[index:]

    at, end = 0, len(page)
    while at < end:
        match = _TOKEN.search(page, at)
        if match is None:
            add(page[at:])
            break
        if match.start() > at:
            add(page[at : match.start()])
        at = match.end()
        name = match[2]
        if name is None:
            continue
        name = name.lower()
        if not match[4]:
            # The page ends within a tag.
            break
        if match[1]:
            if opened.get(name):
                close(opened[name][-1])
            elif name in ("br", "p"):
                flush()
            continue
        if name in ("html", "body"):
            flush()
            continue
        if name == "br":
            pending.append(" ")
            continue
        if name in RAW:
            finish = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.IGNORECASE).search(page, at)
            at = finish.start() if finish else end
            if finish:
                closing = page.find(">", at)
                at = closing + 1 if closing >= 0 else end
            continue
        if name not in INLINE:
            paragraph = innermost(CLOSED_BY_BLOCK)
            if paragraph > stack[-1].scope:
                close(paragraph)
            if name in SIBLINGS:
                sibling = innermost(SIBLINGS[name])
                if sibling > stack[-1].list:
                    close(sibling)
            flush()
        if name in VOID:
            continue
        element = Element(name, match[3], stack[-1])
        elements.append(element)
        if name in MAIN:
            mains.append(element)
        if not match[3].endswith("/") or name not in ("path", "use"):
            opened.setdefault(name, []).append(len(stack))
            stack.append(element)
    flush()
    # Children come after their parents.
    for element in reversed(elements):
        element.parent.size += element.size
        element.parent.linked += element.linked
    own = [main for main in mains if main.name == "main" or not main.in_comments]
    for element in own or mains:
        while element is not None and not element.holds:
            element.holds = True
            element = element.parent
    return elements, blocks


def _hash(text: str) -> int:
    """64 bits, signed, as Spark's bigint."""
    digest = hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def styles(page: str) -> list[tuple[int, int, int, int]]:
    """One entry per style node of a page: node, number of child styles, presentation, content."""
    elements, blocks = parse(page)
    for block in blocks:
        element = block.element.node
        while element.parent is not None:
            element.texts.append(block.text)
            element = element.parent
    nodes: dict[str, tuple[list[str], list[str]]] = {}
    for element in elements:
        if element.node is not element:
            continue
        children, texts = nodes.setdefault(element.path, ([], []))
        children += element.children
        texts += element.texts
    return [
        (_hash(path), len(set(children)), _hash(" ".join(children)), _hash("\n".join(texts)))
        for path, (children, texts) in nodes.items()
    ]


def nodes(page: str) -> list[int]:
    """The style nodes of a page."""
    return [_hash(path) for path in {element.path for element in parse(page)[0]}]


class Kept(NamedTuple):
    """What is known of an element from those around it."""

    keep: bool
    inside: bool
    # Within a form that is kept only around an article.
    form: bool
    article: Element | None


def main_text(page: str, removed: frozenset[int] | set[int] = frozenset()) -> str:
    """The blocks of the main text, joined by spaces."""
    elements, blocks = parse(page)
    low: dict[str, bool] = {}

    def is_low(element: Element) -> bool:
        if element.path not in low:
            low[element.path] = _hash(element.path) in removed
        return low[element.path]

    total = sum(element.size for element in elements if element.depth == 1)
    articles = any(element.holds for element in elements)

    def judged(element: Element, around: Kept) -> Kept:
        keep, inside, form, article = around
        if article is None and element.name == "article":
            article = element
        if not keep:
            return Kept(False, inside, form, article)
        if element.name == "form" and not inside:
            # Some sites wrap their whole pages.
            return Kept(True, inside, True, article)
        by_part = element.parts and (articles or 2 * element.size <= total)
        named = (element.named or by_part) and not element.holds
        if element.noise or named or (element.name == "header" and not inside):
            keep = False
        elif element.name == "article" or (element.name == "main" and not inside):
            inside = True
        elif element.node is element and not element.holds and is_low(element):
            links = 2 * element.linked >= element.size > 0 and element.name not in HEADINGS
            keep = inside and not links
        return Kept(keep, inside, form, article)

    found: dict[Element | None, Kept] = {}
    for element in elements:
        around = found.get(element.parent, Kept(True, False, False, None))
        found[element] = judged(element, around)
    # The outermost article around a block, if any, and its text.
    kept: list[tuple[Element | None, str]] = []
    for block in blocks:
        state = found.get(block.element, Kept(True, False, False, None))
        if state.keep and (state.article is not None or not state.form):
            kept.append((state.article, block.text))
    sizes: dict[Element | None, int] = {}
    for article, text in kept:
        sizes[article] = sizes.get(article, 0) + len(text)
    outside = sizes.pop(None, 0)
    if sizes and max(sizes.values()) >= outside:
        kept = [entry for entry in kept if entry[0] is not None]
    return " ".join(text for _, text in kept)


def _importance(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """``(host, node)`` of the branches to remove."""

    def collect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "html"):
            hosts, rows = [], []
            for host, text in zip(part.column("host").to_pylist(), texts):
                found = styles(text)
                rows += found
                hosts += [host] * len(found)
            columns = [pa.array([row[i] for row in rows], pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), *columns],
                ["host", "node", "styles", "presentation", "content"],
            )

    entries = in_arrow(pages, 
        collect, "host string, node long, styles long, presentation long, content long"
    )

    kind = F.explode(
        F.array(
            F.struct(F.lit(1).alias("of"), F.col("presentation").alias("value")),
            F.struct(F.lit(2).alias("of"), F.col("content").alias("value")),
        )
    )
    counted = (
        entries.select("host", "node", "styles", kind.alias("kind"))
        .groupBy("host", "node", "kind")
        .agg(F.count("*").alias("n"), F.max("styles").alias("styles"))
    )
    # -sum(p log p) over the shares p = n / m is log m - sum(n log n) / m, here to the base m.
    spread = counted.groupBy("host", "node").agg(
        *[
            F.sum(F.when(F.col("kind.of") == of, F.col("n") * F.log("n"))).alias(name)
            for of, name in ((1, "presentations"), (2, "contents"))
        ],
        F.sum(F.when(F.col("kind.of") != 1, F.col("n"))).alias("m"),
        F.max("styles").alias("styles"),
    )
    spread = scratch.stage(spread, "styles")

    def entropy(name: str):
        return 1 - F.col(name) / F.col("m") / F.log("m")

    content = F.pow(F.lit(DAMPING), F.col("styles"))
    importance = (1 - content) * entropy("presentations") + content * entropy("contents")
    return (
        spread.where(F.col("m") >= LEAST_PAGES)
        .where(importance < LEAST_IMPORTANCE)
        .select(F.col("host").alias("of_host"), F.col("node").alias("of_node"))
    )


def _removed(pages: DataFrame, branches: DataFrame) -> DataFrame:
    """``(of_host, of_digest, removed)``: those of the branches that are on a page, by page."""

    def collect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "html"):
            found = pa.array([nodes(text) for text in texts], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [part.column("host"), part.column("digest"), found], ["host", "digest", "nodes"]
            )

    entries = in_arrow(pages, collect, "host string, digest binary, nodes array<long>").select(
        "host", "digest", F.explode("nodes").alias("node")
    )
    return (
        entries.join(
            branches, (F.col("host") == F.col("of_host")) & (F.col("node") == F.col("of_node"))
        )
        .groupBy(F.col("host").alias("of_host"), F.col("digest").alias("of_digest"))
        .agg(F.collect_set("node").alias("removed"))
    )


def extract_text(pages: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    scratch = scratch or Scratch(pages.sparkSession)
    host = host_of(F.col("url")).alias("host")
    # Not a short hash: two pages must not share a list.
    digest = F.unhex(F.md5(whole_text("html").cast("binary"))).alias("digest")
    narrow = pages.select("page_id", "url", "html", host, digest)
    branches = scratch.stage(_importance(narrow.select("host", "html"), scratch), "branches")
    removed = scratch.stage(_removed(narrow.select("host", "digest", "html"), branches), "removed")
    same = (F.col("host") == F.col("of_host")) & (F.col("digest") == F.col("of_digest"))
    joined = narrow.join(removed, same, "left").select("page_id", "url", "html", "removed")

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "html"):
            removed = part.column("removed").to_pylist()
            found = [main_text(text, set(nodes or ())) for text, nodes in zip(texts, removed)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("page_id"),
                    part.column("url"),
                    pa.array(found, pa.string()),
                    pa.array([len(text) for text in found], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in narrow.schema}
    return in_arrow(joined, 
        extract, f"page_id {kinds['page_id']}, url string, text string, n_chars long"
    )
