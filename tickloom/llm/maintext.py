"""The main text of web pages, from parser events and text-to-tag ratios.

Python's streaming HTML parser turns a page into lines, one per block, each with its text, the number of its tags
and the elements it stands in. A line's ratio is its characters per tag; the ratios are smoothed by a Gaussian,
and lines at or above one standard deviation of the smoothed ratios form the content clusters. The clusters
choose the region: the article whose lines they are, or else the smallest element that holds most of them. All
lines of the region count, short ones too, except those inside elements that by name, role or class are
menus, adverts, comments and the like.
"""

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickloom.llm.hashing import slices

# Elements of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody tfoot thead tr ul head title noscript template iframe".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Blocks of text rather than containers of blocks.
SINGLE = HEADINGS | {"p", "li", "dt", "dd", "tr", "pre", "blockquote", "hgroup", "figcaption", "caption", "legend"}
# Elements whose text is never part of an article.
UNWANTED = set(
    "nav footer aside form script style noscript template iframe button select textarea svg canvas object "
    "head title menu dialog datalist search".split()
)
UNWANTED_ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
# Words of class and id that mark other parts of a page, whole words only.
COMMENT_WORDS = {"comment", "comments", "commentlist", "disqus", "respond", "replies", "reply"}
UNWANTED_WORDS = COMMENT_WORDS | set(
    "ad ads advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs consent cookie cookies "
    "copyright footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices overlay pager "
    "pagination popup promo promotion related share sharing sidebar signup social sponsor sponsored subscribe toolbar".split()
)
ARTICLE_WORDS = {"article", "content", "entry", "post", "story"}
# An open element that ends where one of these starts.
ENDED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "option": {"option", "optgroup"},
    "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"},
}
ENDING = set().union(*ENDED_BY.values())
# Elements that keep implied ends inside them.
SCOPES = {"ul", "ol", "dl", "table", "select", "body", "html", "article", "main", "section", "div"}

RADIUS, SIGMA = 2, 1.0
# A region without <article> or <main> holds at least this share of the clustered text.
MOST = 0.8


def words_of(attributes: dict[str, str]) -> set[str]:
    """The words of an element's class and id."""
    if "class" not in attributes and "id" not in attributes:
        return set()
    text = f"{attributes.get('class') or ''} {attributes.get('id') or ''}"
    text = re.sub(r"([a-z0-9])([A-Z])", r"\1 \2", text)
    return set(re.split(r"[^a-z0-9]+", text.lower())) - {""}


class Node:
    """An open element: its parent's number, its tag, and why its text is left out, if it is."""

    __slots__ = ("number", "parent", "tag", "barred")

    def __init__(self, number: int, parent: int, tag: str, barred: str):
        self.number, self.parent, self.tag, self.barred = number, parent, tag, barred


class PageLines(HTMLParser):
    """Lines of a page: ``texts``, ``tags`` (number), ``at`` (element), ``barred``; and the tree of elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.texts, self.tags, self.at, self.barred, self.heading = [], [], [], [], []
        self.parents, self.names = [-1], [""]
        self.stack, self.open = [Node(0, -1, "", "")], Counter()
        self.parts, self.tag_count, self.headings = [], 0, 0

    def end_line(self) -> None:
        if not self.parts:
            return
        text = " ".join("".join(self.parts).split())
        self.parts = []
        if text:
            top = self.stack[-1]
            self.texts.append(text)
            self.tags.append(self.tag_count)
            self.at.append(top.number)
            self.barred.append(bool(top.barred))
            self.heading.append(self.headings > 0)
            self.tag_count = 0

    def why_barred(self, tag: str, attributes: dict[str, str]) -> str:
        above = self.stack[-1].barred
        words = words_of(attributes)
        if words & COMMENT_WORDS and tag not in ("html", "body", "main"):
            return "comment"
        if tag in ("article", "main") or attributes.get("role") == "main":
            # An article inside a menu or an advert shows that the latter was not closed.
            return above if above in ("comment", "aside", "footer") else ""
        if above:
            return above
        if tag in UNWANTED:
            return tag
        inside = self.open["article"] or self.open["main"]
        if tag == "header" and not inside:
            return tag
        if not attributes:
            return ""
        hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true"
        if hidden or re.search(r"display\s*:\s*none", attributes.get("style") or ""):
            return "hidden"
        if (attributes.get("role") or "").lower() in UNWANTED_ROLES:
            return "role"
        if tag in HEADINGS or tag in ("html", "body"):
            return ""
        if words & UNWANTED_WORDS or ("header" in words and not inside and not words & ARTICLE_WORDS):
            return "class"
        return ""

    def close_to(self, depth: int) -> None:
        """End the lines and elements from ``depth`` of the stack on."""
        for node in reversed(self.stack[depth:]):
            if node.tag in BLOCKS or node.tag in UNWANTED:
                self.end_line()
            self.stack.pop()
            self.open[node.tag] -= 1
            self.headings -= node.tag in HEADINGS

    def implied_ends(self, tag: str) -> None:
        if tag in BLOCKS and self.open["p"]:
            self.close_to(self.depth_of("p"))
        if tag not in ENDING:
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            name = self.stack[depth].tag
            if tag in ENDED_BY.get(name, ()):
                self.close_to(depth)
                return
            if name in SCOPES:
                return

    def depth_of(self, tag: str) -> int:
        depth = len(self.stack) - 1
        while self.stack[depth].tag != tag:
            depth -= 1
        return depth

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        attributes = {name: value or "" for name, value in reversed(attrs)}
        self.implied_ends(tag)
        barred = self.why_barred(tag, attributes)
        if tag in BLOCKS or (barred and not self.stack[-1].barred):
            self.end_line()
        elif tag in ("br", "td", "th"):
            self.parts.append(" ")
        self.tag_count += 1
        if tag not in VOID:
            self.parents.append(self.stack[-1].number)
            self.names.append(tag)
            self.stack.append(Node(len(self.names) - 1, self.stack[-1].number, tag, barred))
            self.open[tag] += 1
            self.headings += tag in HEADINGS

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # As browsers do, the slash counts for void elements only.
        self.handle_starttag(tag, attrs)
        if tag in ("script", "style"):
            self.set_cdata_mode(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tag_count += 1
        if tag == "br":
            self.parts.append(" ")
        elif self.open[tag]:
            depth = self.depth_of(tag)
            # Text after a left-out inline element starts a line of its own kind.
            if self.stack[depth].barred and not self.stack[depth - 1].barred:
                self.end_line()
            self.close_to(depth)
        elif tag in BLOCKS:
            self.end_line()

    def handle_data(self, data: str) -> None:
        if self.stack[-1].tag not in ("script", "style"):
            self.parts.append(data)

    def unknown_decl(self, data: str) -> None:
        pass


def parse(html: str) -> PageLines:
    lines = PageLines()
    try:
        lines.feed(html)
        if re.match(r"<(?:!--|[A-Za-z/!?][^>]*\Z)", lines.rawdata):
            # A tag or comment that the end of the page cuts off is markup, not text.
            lines.rawdata = ""
        lines.close()
    except AssertionError:
        # The parser gives up at a declaration it cannot read; what stands before it counts.
        pass
    lines.end_line()
    return lines


def smooth(ratios: np.ndarray) -> np.ndarray:
    """Gaussian smoothing, renormalised at both ends."""
    kernel = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / SIGMA) ** 2)
    around = np.convolve(ratios, kernel)[RADIUS : RADIUS + len(ratios)]
    weight = np.convolve(np.ones(len(ratios)), kernel)[RADIUS : RADIUS + len(ratios)]
    return around / weight


def chosen_lines(lines: PageLines) -> np.ndarray:
    """Which lines belong to the content region."""
    sizes = np.array([len(t) for t in lines.texts], np.float64)
    free = ~np.array(lines.barred, np.bool_)
    if not free.any():
        return free
    # Lines left out anyway would only blur the ratios beside them.
    ratios = smooth((sizes / np.maximum(lines.tags, 1))[free])
    content = free.copy()
    content[free] = ratios >= ratios.std()
    if not content.any():
        content = free
    # Clustered text inside every element; children have larger numbers than their parents.
    at = np.array(lines.at)
    inside = np.bincount(at, np.where(content, sizes, 0.0), len(lines.names))
    for number in range(len(inside) - 1, 0, -1):
        inside[lines.parents[number]] += inside[number]

    def within(root: int) -> np.ndarray:
        """The lines inside an element: its descendants are found in one pass, parents first."""
        mark = np.zeros(len(lines.names), np.bool_)
        mark[root] = True
        for number in range(root + 1, len(mark)):
            mark[number] = mark[lines.parents[number]]
        return mark[at]

    def best(name: str) -> int | None:
        found = [i for i, tag in enumerate(lines.names) if tag == name and inside[i] > 0]
        return max(found, key=lambda i: (inside[i], -i), default=None)

    article, main = best("article"), best("main")
    if article is not None and (main is None or inside[article] >= MOST * inside[main]):
        return free & within(article)
    if main is not None:
        return free & within(main)
    # The smallest element with most of the clustered text; later numbers lie deeper.
    region = max(i for i in range(len(inside)) if inside[i] >= MOST * inside[0])
    while region and (lines.names[region] not in BLOCKS or lines.names[region] in SINGLE):
        # A single block stands for the blocks beside it.
        region = lines.parents[region]
    taken = within(region)
    if lines.names[region] in ("", "html", "body"):
        places = np.flatnonzero(content & taken)
        first, last = places[0], places[-1]
        while first and free[first - 1] and lines.heading[first - 1]:
            first -= 1
        span = np.zeros(len(free), np.bool_)
        span[first : last + 1] = True
        taken &= span
    return free & taken


def main_text(html: str) -> str:
    """The blocks of a page's main text, joined by two line ends; empty if there is none."""
    lines = parse(html)
    if not lines.texts:
        return ""
    return "\n\n".join(t for t, chosen in zip(lines.texts, chosen_lines(lines), strict=True) if chosen)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """Per row: page_id, url, text (the main text, empty if none) and n_chars (its code points).

    Each row is handled on its own, the whole page at once, so there is no shuffle and a lost task is simply run
    again. A null page counts as empty. Repeated rows give repeated rows, an empty table an empty one; page_id
    and url are passed on as they are, nulls too, and other columns are not read. Pages cut off in the
    middle count as far as they go. Time grows linearly with the length of a page.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in slices(batch.column(2)):
                part = batch.slice(begin, end - begin)
                texts = [main_text(html) if html else "" for html in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                    ],
                    ["page_id", "url", "text", "n_chars"],
                )

    kinds = {name: pages.schema[name].dataType.simpleString() for name in ("page_id", "url")}
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    return pages.select("page_id", "url", "html").mapInArrow(run, schema)
