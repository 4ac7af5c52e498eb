"""Main text of web pages by composite text density.

A page becomes a tree of its elements. The density of a node is the number of its characters per
tag, adjusted by links: text in links counts against it, the more so the more of the page lies in links.
The density sum of a node adds up its children's densities, so it peaks where dense blocks are
side by side. From the node with the largest sum, the smallest density on the path up to the body is the
threshold: every child of the body that is at least as dense has main text, and of it the subtree
with the largest sum is the place of the main text. From there the way goes up as long as what stands beside it
belongs to the same text: in an article or main element all does, elsewhere headings, paragraphs and the like with few
links, and elements at least as dense as the threshold. Lists of links beside the way stay out.

Elements that never hold main text (menus, headers and footers of the page, sidebars, forms, scripts,
by element or role) do not count and are left out. Classes and ids made of nothing but such words (sidebar,
cookie-notice, but not no-sidebar) only mark an element: it is left out as long as the rest of the page has
text to compare with it, and counts where its density sum is far above all that is left.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, functions as F

# Elements of the HTML standard by their role here.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set(
    "script style noscript template iframe object canvas svg math head title textarea select button datalist audio video map".split()
)
ASIDE = set("nav aside footer form dialog menu".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
ASIDE_ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
ASIDE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice notices "
    "popup modal overlay newsletter subscribe subscription signup login nav navbar navigation menu breadcrumb breadcrumbs sidebar "
    "sidenav footer masthead comment comments disqus respond replies share sharing social related recommended trending widget "
    "pagination pager toolbar skip hidden".split()
)
READER_WORDS = set("comment comments disqus respond replies".split())
# A marked element counts if its density sum is more than so many times that of the rest; readers write more than authors.
ABOVE, READERS_ABOVE = 4, 32
# An open element ends before these, as the HTML standard has it.
CLOSED_BY = {
    "p": set(
        "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
        "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul li dt dd".split()
    ),
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "tfoot", "thead"},
    "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"},
    "option": {"option", "optgroup"},
}
SCOPES = {
    "p": {"table", "td", "th", "button", "object"},
    "li": {"ul", "ol", "menu"},
    "dt": {"dl"},
    "dd": {"dl"},
    "tr": {"table"},
    "td": {"table"},
    "th": {"table"},
}
# Elements of the HTML standard that are part of a text, not a section of a page.
TEXT_LEVEL = INLINE | set("p h1 h2 h3 h4 h5 h6 hgroup header blockquote pre ul ol dl table figure figcaption address hr details".split())
# A list of links: at least so many, with more than this share of its characters.
LIST_LINKS, LIST_SHARE = 2, 2 / 3


class Page(HTMLParser):
    """The tree of a page in document order; a child's number is larger than its parent's."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tags = ["#page"]
        self.parents = [-1]
        self.left_out = [False]
        self.marks: list[str | None] = [None]
        self.links = [False]
        self.articles = [False]
        self.texts: list[tuple[int, str]] = []
        self.open = [0]
        self.open_names: Counter[str] = Counter()
        self.feed(html)
        self.close()

    def _add(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        parent = self.open[-1]
        named = dict(attrs)
        names = f"{named.get('class') or ''} {named.get('id') or ''}".lower().split()
        aside = (
            tag in SILENT
            or tag in ASIDE
            or (tag == "header" and not self.articles[parent])
            or (named.get("role") or "").lower() in ASIDE_ROLES
            or "hidden" in named
            or (named.get("aria-hidden") or "").lower() == "true"
        )
        marks = [] if tag in ("html", "body", "main", "article") else [mark for name in names if (mark := _mark(name))]
        self.tags.append(tag)
        self.parents.append(parent)
        self.left_out.append(self.left_out[parent] or aside)
        self.marks.append(next((mark for mark in marks if mark in READER_WORDS), marks[0] if marks else None))
        self.links.append(self.links[parent] or tag == "a")
        self.articles.append(self.articles[parent] or tag in ("article", "main"))

    def handle_starttag(self, tag, attrs):
        for kind, closers in CLOSED_BY.items():
            if tag in closers:
                self._end(kind, SCOPES[kind] if kind in SCOPES else {"select"})
        if tag not in INLINE:
            self._break()
        elif tag == "br":
            self.texts.append((self.open[-1], " "))
        self._add(tag, attrs)
        if tag not in VOID:
            self.open.append(len(self.tags) - 1)
            self.open_names[tag] += 1

    def handle_endtag(self, tag):
        if tag not in VOID:
            self._end(tag, set())

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_data(self, data):
        self.texts.append((self.open[-1], data))

    def _break(self) -> None:
        self.texts.append((self.open[-1], ""))

    def _end(self, tag: str, scope: set[str]) -> None:
        """Close the innermost open element of that name, and all in it, unless a scope lies between."""
        if not self.open_names[tag]:
            return
        for at in range(len(self.open) - 1, 0, -1):
            name = self.tags[self.open[at]]
            if name == tag:
                if any(self.tags[i] not in INLINE for i in self.open[at:]):
                    self._break()
                self.open_names.subtract([self.tags[i] for i in self.open[at:]])
                del self.open[at:]
                return
            if name in scope:
                return


def _mark(name: str) -> str | None:
    """The first word of a class or id of which every word is one of ``ASIDE_WORDS``, a word of readers before others."""
    words = re.findall(r"[^\W\d_]+", name)
    if not words or not ASIDE_WORDS.issuperset(words):
        return None
    return next((word for word in words if word in READER_WORDS), words[0])


def _size(text: str) -> int:
    return len("".join(text.split()))


def sizes(page: Page) -> tuple[list[int], list[int], list[int], list[int]]:
    """Characters, characters in links, tags and links of every subtree, without what is left out."""
    n = len(page.tags)
    chars, link_chars, tags, link_tags = ([0] * n for _ in range(4))
    for node, text in page.texts:
        if not page.left_out[node]:
            size = _size(text)
            chars[node] += size
            if page.links[node]:
                link_chars[node] += size
    for node in range(n - 1, 0, -1):
        if not page.left_out[node]:
            parent = page.parents[node]
            chars[parent] += chars[node]
            link_chars[parent] += link_chars[node]
            tags[parent] += tags[node] + (page.tags[node] == "a" or page.tags[node] not in INLINE)
            link_tags[parent] += link_tags[node] + (page.tags[node] == "a")
    return chars, link_chars, tags, link_tags


def densities(page: Page) -> tuple[list[float], list[float]]:
    """Composite density and density sum of every node; 0 for those left out, and for inline ones, which are their parent's text."""
    n = len(page.tags)
    chars, link_chars, tags, link_tags = sizes(page)
    body = next((i for i, tag in enumerate(page.tags) if tag == "body"), 0)
    share = link_chars[body] / chars[body] if chars[body] else 0.0
    density, total = [0.0] * n, [0.0] * n
    for node in range(n - 1, -1, -1):
        c, lc, t, lt = chars[node], link_chars[node], max(1, tags[node]), max(1, link_tags[node])
        if c and not page.left_out[node] and page.tags[node] not in INLINE:
            base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
            density[node] = c / t * (math.log(c / max(1, lc) * t / lt + 1) / math.log(base + 1))
        if node:
            total[page.parents[node]] += density[node]
    return density, total


def leave_marked_out(page: Page) -> None:
    """Add the marked subtrees to ``left_out``, but for those whose text is far denser than what the page has without them.

    Subtrees of one word side by side are weighed together. One that counts does so with the way to its node of the
    largest density sum; marked elements beside that way stay out unless they are as far above the rest. Where the rest
    has an article or main element with text, only marked elements inside such elements are weighed.
    """
    silent, marks = page.left_out, list(page.marks)

    def without(considered) -> list[bool]:
        out = list(silent)
        for node in range(1, len(out)):
            out[node] = out[node] or out[page.parents[node]] or considered(marks[node])
        return out

    for weighed, above in ((ASIDE_WORDS - READER_WORDS, ABOVE), (ASIDE_WORDS, READERS_ABOVE)):
        if weighed.isdisjoint(marks):
            continue
        page.left_out = without(lambda mark: mark is not None and mark not in weighed)
        density, total = densities(page)
        while True:
            page.left_out = without(lambda mark: mark is not None)
            rest_density, rest_total = densities(page)
            stated = any(page.articles[node] and not page.left_out[node] and text.strip() for node, text in page.texts)
            # topmost marked element of each node, and its node of the largest sum, the last of equal ones
            tops, best = [0] * len(marks), {}
            groups: dict[tuple, list[int]] = {}
            for node in range(1, len(marks)):
                parent = page.parents[node]
                if tops[parent]:
                    tops[node] = tops[parent]
                elif marks[node] in weighed and (page.articles[parent] or not stated):
                    tops[node] = best[node] = node
                    groups.setdefault((parent, marks[node]), []).append(node)
                if tops[node] and total[node] >= total[best[tops[node]]]:
                    best[tops[node]] = node
            weights = {key: max(sum(density[n] for n in group), *(total[best[n]] for n in group)) for key, group in groups.items()}
            heaviest = max(weights, key=weights.get, default=None)
            if heaviest is None or weights[heaviest] <= above * max(rest_density[0], *rest_total):
                break
            for node in groups[heaviest]:
                marks[node] = None
            at = best[max(groups[heaviest], key=lambda n: total[best[n]])]
            while at != heaviest[0]:
                marks[at] = None
                at = page.parents[at]


def main_nodes(page: Page) -> set[int]:
    """The roots of the subtrees that hold the main text."""
    leave_marked_out(page)
    density, total = densities(page)
    children: list[list[int]] = [[] for _ in page.tags]
    for node in range(1, len(page.tags)):
        children[page.parents[node]].append(node)
    best = list(range(len(page.tags)))  # the node of the largest sum in each subtree, the first of equal ones
    for node in range(len(page.tags) - 1, 0, -1):
        parent = page.parents[node]
        if total[best[node]] >= total[best[parent]] and total[best[node]] > 0 and not (
            best[parent] == parent and total[best[node]] == total[parent]
        ):
            best[parent] = best[node]
    body = next((i for i, tag in enumerate(page.tags) if tag == "body"), 0)
    if total[best[body]] <= 0:
        return {body}
    threshold, at = math.inf, best[body]
    while at not in (body, 0, -1):
        threshold = min(threshold, density[at])
        at = page.parents[at]
    if threshold == math.inf:
        return {body}
    found, waiting = set(), list(children[body])
    while waiting:
        node = waiting.pop()
        if page.left_out[node]:
            continue
        if density[node] >= threshold:
            found.add(node if total[node] >= total[best[node]] or not children[node] else best[node])
        else:
            waiting += children[node]
    beside = _Beside(page, children, density, threshold)
    return {beside.top(node) for node in found}


class _Beside:
    """What stands beside the main text, element by element."""

    def __init__(self, page: Page, children: list[list[int]], density: list[float], threshold: float):
        self.page, self.children, self.density, self.threshold = page, children, density, threshold
        self.chars, self.link_chars, _, self.link_tags = sizes(page)
        self.known: dict[int, tuple[list[int], list[int]]] = {}

    def parts(self, parent: int) -> tuple[list[int], list[int]]:
        """Of an element's children with text, the lists of links and those of another text."""
        if parent not in self.known:
            lists, others = [], []
            for child in self.children[parent]:
                if self.page.left_out[child] or not self.chars[child]:
                    continue
                linked = self.link_chars[child] / self.chars[child]
                tag = self.page.tags[child]
                if tag != "p" and self.link_tags[child] >= LIST_LINKS and linked > LIST_SHARE:
                    lists.append(child)
                elif not self.page.articles[parent] and self.density[child] < self.threshold and (tag not in TEXT_LEVEL or linked > 0.5):
                    others.append(child)
            self.known[parent] = lists, others
        return self.known[parent]

    def top(self, node: int) -> int:
        """The topmost node on the way up whose other children are all of the same text; lists of links among them are left out."""
        page = self.page
        while page.parents[node] > 0 and page.tags[page.parents[node]] not in ("html", "body"):
            lists, others = self.parts(page.parents[node])
            if any(child != node for child in others[:2]):
                break
            for child in lists:
                page.left_out[child] = page.left_out[child] or child != node
            node = page.parents[node]
        return node


def main_text(html: str | None) -> str:
    """The blocks of the main text in page order, white space in them as one space, joined by two line breaks."""
    page = Page(html or "")
    roots = main_nodes(page)
    inside = [False] * len(page.tags)
    for node, parent in enumerate(page.parents):
        inside[node] = (node in roots or (parent >= 0 and inside[parent])) and not page.left_out[node]
    blocks, block = [], []
    for node, text in page.texts:
        if not text:
            blocks.append("".join(block))
            block = []
        elif inside[node]:
            block.append(text)
    blocks.append("".join(block))
    return "\n\n".join([tidy for tidy in (" ".join(b.split()) for b in blocks) if tidy])


def extract_text(df: DataFrame, html: str) -> DataFrame:
    """``df`` packed as ``row``, with the main ``text`` of its whole page and its ``n_chars``.

    Null, empty and textless pages have an empty text. Every row is taken by itself, so repeated rows are as any others, and an empty
    table gives no rows. Broken markup is read as browsers do in the usual
    cases (unclosed paragraphs, list items and cells); the rest of a page after an open script is silent.
    """

    @F.pandas_udf("string")
    def convert(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in pages:
            yield pd.Series([main_text(p if isinstance(p, str) else None) for p in batch], dtype=object)

    done = df.select(F.struct("*").alias("row"), convert(F.col(f"`{html}`")).alias("text"))
    return done.withColumn("n_chars", F.length("text").cast("long"))
