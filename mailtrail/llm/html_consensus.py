"""Main text of web pages by consensus of each host's pages.

Each page's containers are scored by the text that stands in them outside links and boilerplate; the
lowest with nearly all of it is the best. The best container's path (tags and classes, digits left out) is the page's vote; votes are summed
per host in Spark, and each page is read again with the winning paths of its host, the strongest
that gives a fair share of its own best container's text. A page with none of them, or without a host, keeps to its own best container.

Text is that of the container without menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and comments; character references are decoded, white space inside a block is
one space, blocks are lines. A null or empty html gives an empty text. Repeated rows are extracted
one by one; equal votes: the first path in alphabetical order.
"""

from __future__ import annotations

import html as references
import re
from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import kept

#: Paths of a host that its pages are tried with, and parts into which a hot host's pages are dealt.
PATHS, SALTS = 8, 16
#: An article's container holds this share of its page's text; a host's path is taken on a page where it
#: gives this share of the text of the page's own best container.
NEARLY_ALL, LEAST_SHARE = 0.9, 0.1

#: A longer path of tags and classes is written as a digest.
PATH_CHARS = 4000

# HTML's elements by how they break text, and words that name what is no article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math object".split())
CONTAINERS = frozenset("main article section div td center blockquote".split())
BLOCKS = CONTAINERS | frozenset(
    "address aside caption dd details dialog dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head"
    " header hgroup hr html legend li menu nav ol optgroup option p pre select summary table tbody tfoot th thead tr ul"
    .split()
)
BOILERPLATE_TAGS = frozenset("head nav footer aside form button select menu dialog".split())
BOILERPLATE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split()
)
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie"
    " cookies copyright disqus footer login masthead menu modal nav navbar navigation newsletter notice pager"
    " pagination popup promo promotion recommended related replies respond share sharing sidebar signup social"
    " sponsor sponsored subscribe subscription toolbar widget".split()
)
#: Words that do so outside an article or main element only.
HEADER_WORDS = frozenset(["header", "topbar", "sitehead"])
#: Elements that end an open one of the same kind (p also ends at any block).
CLOSES_ITSELF = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",),
}

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_QUOTE_OR_END = re.compile("[\"'>]")
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORDS = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")


class Block(NamedTuple):
    container: int
    text: str
    linked: int
    heading: bool


class Page(NamedTuple):
    #: By container: number of its parent container, tag, path.
    parents: list[int]
    tags: list[str]
    paths: list[str]
    blocks: list[Block]


class Markup(NamedTuple):
    start: int
    end: int
    closes: bool
    #: Lower-case name, empty for comments and declarations.
    tag: str
    attributes: str


class _Scanner:
    """Markup of a page in its order, in time that follows the page's length.

    A ``>`` in quotes ends no tag. From the first tag whose quotes never close on, quotes are
    characters like others; from the first ``<`` that no ``>`` follows on, all is text.
    """

    def __init__(self, html: str):
        self.html, self.quotes, self.last = html, True, html.rfind(">")

    def _end(self, at: int) -> int:
        """Place of the ``>`` of a tag whose attributes start here, or -1."""
        place = at
        while self.quotes and (found := _QUOTE_OR_END.search(self.html, place)):
            if found[0] == ">":
                return found.start()
            place = self.html.find(found[0], found.end()) + 1
            if not place:
                break
        self.quotes = False
        return self.html.find(">", at)

    def next(self, at: int) -> Markup | None:
        html = self.html
        while (start := html.find("<", at)) >= 0:
            if html.startswith("<!--", start):
                end = html.find("-->", start + 4)
                return Markup(start, end + 3 if end >= 0 else len(html), False, "", "")
            if start > self.last:
                return None
            if name := _NAME.match(html, start):
                end = self._end(name.end())
                return Markup(start, end + 1, bool(name[1]), name[2].lower(), html[name.end() : end])
            if html[start + 1 : start + 2] in ("!", "?", "/"):
                end = html.find(">", start + 2)
                if end >= 0:
                    return Markup(start, end + 1, False, "", "")
            at = start + 1
        return None


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): references.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)}


def _is_boilerplate(tag: str, told: dict[str, str], in_article: bool, by_words: bool) -> bool:
    if tag in BOILERPLATE_TAGS or tag == "header" and not in_article:
        return True
    if not told:
        return False
    if "hidden" in told or told.get("aria-hidden", "").lower() == "true":
        return True
    if "display:none" in told.get("style", "").replace(" ", "").lower():
        return True
    if told.get("role", "").lower() in BOILERPLATE_ROLES:
        return True
    if not by_words or tag == "main":
        return False
    words = set(_WORDS.findall(f"{told.get('class', '')} {told.get('id', '')}".lower()))
    return bool(words & BOILERPLATE_WORDS) or not in_article and bool(words & HEADER_WORDS)


def parse(html: str, by_words: bool = True) -> Page:
    """Containers and blocks of a page outside boilerplate; ``by_words``: class words tell it too."""
    page = Page([-1], ["body"], ["body"], [])
    #: Open elements: tag, container number, whether boilerplate, whether in an article.
    stack: list[tuple[str, int, bool, bool]] = [("body", 0, False, False)]
    text: list[str] = []
    linked = links = 0
    at = 0

    def flush(heading: bool = False) -> None:
        nonlocal linked
        if text:
            line = " ".join(references.unescape("".join(text)).split())
            if line:
                page.blocks.append(Block(stack[-1][1], line, linked, heading))
            text.clear()
        linked = 0

    def close(depth: int) -> None:
        nonlocal links
        while len(stack) > depth:
            tag = stack[-1][0]
            if tag in BLOCKS:
                flush(tag in ("h1", "h2"))
            if tag == "a":
                links = max(0, links - 1)
            stack.pop()

    def open_depth(names: tuple[str, ...]) -> int:
        """Place of the innermost open element of these names inside the innermost container."""
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] in names:
                return depth
            if stack[depth][0] in CONTAINERS or stack[depth][0] in ("table", "ul", "ol", "dl"):
                return 0
        return 0

    end = len(html)
    scanner = _Scanner(html)
    while at < end:
        found = scanner.next(at)
        stop = found.start if found else end
        if stop > at and not stack[-1][2]:
            part = html[at:stop]
            text.append(part)
            if links:
                linked += len(part.strip())
        if not found:
            break
        at, tag, attributes = found.end, found.tag, found.attributes
        if not tag:
            continue
        if found.closes:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    close(depth)
                    break
            continue
        if tag in RAW:
            closing = re.compile(rf"</{re.escape(tag)}[^>]*>|\Z", re.I).search(html, at)
            at = closing.end() if not attributes.endswith("/") else at
            text.append(" ")
            continue
        if tag in BLOCKS:
            if (depth := open_depth(("p",))) and not stack[-1][2]:
                close(depth)
            elif tag in CLOSES_ITSELF and (depth := open_depth(CLOSES_ITSELF[tag])):
                close(depth)
            flush()
        if tag in VOID:
            if tag == "br":  # the others stand inside words
                text.append(" ")
            continue
        if tag in ("html", "body"):  # the root, written or not
            continue
        _, container, skipped, in_article = stack[-1]
        told = _attributes(attributes) if attributes.strip() else {}
        skipped = skipped or _is_boilerplate(tag, told, in_article, by_words)
        in_article = in_article or tag in ("article", "main")
        if tag in CONTAINERS and not skipped:
            name = ".".join([tag, *sorted(set(_DIGITS.sub("", told.get("class", "")).lower().split()))])
            page.parents.append(container)
            page.tags.append(tag)
            path = f"{page.paths[container]}>{name}"
            # The path of a very deep container goes on from a digest: equal paths stay equal.
            page.paths.append(path if len(path) <= PATH_CHARS else "#" + sha256(path.encode()).hexdigest())
            container = len(page.paths) - 1
        if tag == "a":
            links += 1
        if not attributes.endswith("/") or tag in BLOCKS:
            stack.append((tag, container, skipped, in_article))
        elif tag == "a":
            links -= 1
    close(0)
    return page


def best_container(page: Page) -> int:
    """The lowest container with nearly all of the page's text outside links and boilerplate.

    Where the container with most text of its own, that of its parts counting half a level up, is
    inside an article or main element, that element is meant. A parent that adds no more than a
    heading is taken with a container.
    """
    own = [0.0] * len(page.paths)
    whole = [0] * len(page.paths)
    headed = [False] * len(page.paths)
    for block in page.blocks:
        own[block.container] += max(0, len(block.text) - 2 * block.linked)
        whole[block.container] += len(block.text)
        headed[block.container] |= block.heading
    full = list(own)
    for k in range(len(own) - 1, 0, -1):
        own[page.parents[k]] += own[k] / 2
        full[page.parents[k]] += full[k]
        whole[page.parents[k]] += whole[k]
    best = max(range(len(own)), key=lambda k: (own[k], -k))
    for name in ("article", "main"):
        at = best
        while at > 0:
            if page.tags[at] == name:
                return at
            at = page.parents[at]
    # Containers that hold more than half of the text lie in each other; the last one is the lowest.
    best = max((k for k in range(len(full)) if full[k] >= NEARLY_ALL * full[0]), default=0) if full[0] else best
    while best > 0 and headed[page.parents[best]] and whole[page.parents[best]] <= 1.2 * whole[best]:
        best = page.parents[best]
    return best


def text_of(page: Page, containers: set[int]) -> str:
    """Lines of the blocks below any of the containers, in page order."""
    inside = [False] * len(page.paths)
    for k in range(len(inside)):
        inside[k] = k in containers or k > 0 and inside[page.parents[k]]
    return "\n".join(b.text for b in page.blocks if inside[b.container])


def _read(html: str | None) -> Page:
    page = parse(html or "")
    # A page whose every word stands under such class words has none that tell.
    return page if page.blocks else parse(html or "", by_words=False)


def extract(html: str | None, paths: list[str]) -> str:
    """Main text by the first of ``paths`` that gives a fair share, else by the page's own best container."""
    page = _read(html)
    own = text_of(page, {best_container(page)})
    for path in paths:
        if chosen := {k for k, p in enumerate(page.paths) if p == path}:
            text = text_of(page, chosen)
            if text and len(text) >= LEAST_SHARE * len(own):
                return text
    return own


def host(url: Column) -> Column:
    """Lower-case host name of a URL, null where there is none."""
    name = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.when(name != "", name)


def _vote_rows(batches):
    for batch in batches:
        paths, sizes = [], []
        for value in batch.column("html"):
            page = _read(value.as_py())
            best = best_container(page)
            paths.append(page.paths[best])
            sizes.append(len(text_of(page, {best})))
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), pa.array(paths, pa.string()), pa.array(sizes, pa.int64())],
            names=["host", "path", "size"],
        )


def host_paths(pages: DataFrame) -> DataFrame:
    """host and its PATHS strongest paths, by the pages that vote for them."""
    votes = (
        pages.select(host(F.col("url")).alias("host"), "html").filter("host is not null")
        .mapInArrow(_vote_rows, "host string, path string, size bigint")
        .filter("size > 0").groupBy("host", "path").agg(F.count("*").alias("votes"))
    )
    order = Window.partitionBy("host").orderBy(F.desc("votes"), "path")
    return kept(
        votes.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= PATHS)
        .groupBy("host").agg(F.array_sort(F.collect_list(F.struct("place", "path")))["path"].alias("paths")),
        "html-paths",
    )


def _text_rows(batches):
    for batch in batches:
        paths = batch.column("paths").to_pylist()
        texts = [extract(v.as_py(), p or []) for v, p in zip(batch.column("html"), paths)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
            names=["page_id", "url", "text"],
        )


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url and main text of every page."""
    # A host's pages are dealt to SALTS parts, should the paths be too many to send to all.
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS))
    paths = host_paths(pages).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    told = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"), salt.alias("salt"))
    return told.join(paths, ["host", "salt"], "left").select("page_id", "url", "html", "paths").mapInArrow(
        _text_rows, "page_id bigint, url string, text string"
    )
