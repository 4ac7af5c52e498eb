"""Main text of pages."""

import html
import math
import random
import re
import time
from xml.etree import ElementTree

import pytest

from casewise.llm.html_text import Page, densities, extract_text, main_text

LONG = "A long enough sentence of main text stands here, and it goes on for a while without any link at all."


def naive(page):
    article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", article)
    return "\n\n".join(b for b in (" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in blocks) if b)


def test_all_pages_give_their_article(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").withColumnRenamed("url", "text")
    for row in extract_text(pages, "html").collect():
        assert row.text == naive(row.row.html) and row.n_chars == len(row.text)


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<p>", ""),
        ("no markup at &lt;all&#62;", "no markup at <all>"),
        ("<script>var x = '</p>'; text", ""),
        ("<ul><li>one<li>two  \n three</ul>", "one\n\ntwo three"),
        ("<div>" * 4000 + "deep", "deep"),
        (f"<body><header><h1>Site</h1></header><nav><a href=x>menu</a></nav><div><p>{LONG}<p>{LONG} <b>bo</b>ld</div><aside>side</aside>", f"{LONG}\n\n{LONG} bold"),
        (f"<body><div id=main><p>{LONG}</p><p>{LONG}</p><div class='comments'><p>{LONG}</p></div></div><footer>f</footer>", f"{LONG}\n\n{LONG}"),
        (f"<div class='cookie-notice'>{LONG}</div><article><h1>T</h1><p>{LONG}</p><form>f</form></article>", f"T\n\n{LONG}"),
        (f"<body><ul>{'<li><a href=x>a link in a list</a>' * 20}</ul><div><p>{LONG}</p><p>{LONG}</p></div>", f"{LONG}\n\n{LONG}"),
        (f"<table><tr><td>{LONG}<td>{LONG}</table>", f"{LONG}\n\n{LONG}"),
        ("a<br>b<!-- c --> &amp;amp; d", "a b &amp; d"),
    ],
)
def test_pages(page, text):
    assert main_text(page) == text


ARTICLE = f"<p>{LONG}</p>" * 3
TEXT = "\n\n".join([LONG] * 3)


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<article><div class='elementor-widget elementor-widget-text-editor'>{ARTICLE}</div></article>", TEXT),
        (f"<body><div id='page' class='site no-sidebar'>{ARTICLE}</div>", TEXT),
        (f"<body><div class='col hidden-xs'>{ARTICLE}</div>", TEXT),
        (f"<body><div class='post-content has-comments'>{ARTICLE}</div>", TEXT),
        (f"<body><h1>Title</h1><div class='widget'>{ARTICLE}</div><div class='sidebar'><p>{LONG}</p></div>", TEXT),
        (f"<body><div>{f'<div class=widget><p>{LONG}</p></div>' * 3}</div><div class='cookie-notice'>{LONG}</div>", TEXT),
        (f"<body><div class='hidden'><div class='related'>{ARTICLE}<div class='ad'>buy</div></div></div>", TEXT),
        (f"<div id=comments>{f'<div class=comment><p>{LONG}</p></div>' * 3}</div>", TEXT),
        (f"<div class='comments'><div class='widget'>{ARTICLE}</div></div>", TEXT),
        ("<div class='widget'>" * 2000 + "deep", "deep"),
        # what must stay out, also where it is longer than the article
        (f"<body><div class='ad'>{LONG}</div><article><h1>T</h1></article>", "T"),
        (f"<body><div class='post'>{ARTICLE}</div><div id=comments>{f'<div class=comment><p>{LONG}</p></div>' * 40}</div>", TEXT),
        (f"<body><div class='post'>{ARTICLE}</div><div class='cookie-notice'>{ARTICLE * 2}</div><div class='ad ad-300x250'>{LONG}</div>", TEXT),
    ],
)
def test_marked_elements_lose_no_article(page, text):
    assert main_text(page) == text


NAV = "<nav><a href=x>menu</a></nav>"
LINKS = "<ul><li><a>one link here</a><li><a>two links here</a></ul>"


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<body>{NAV}<article><h1>T</h1><div>{ARTICLE}</div></article><footer>f</footer>", f"T\n\n{TEXT}"),
        (f"<body>{NAV}<article><h1>T</h1><p>lead</p><div>{ARTICLE}</div><p>last</p></article>", f"T\n\nlead\n\n{TEXT}\n\nlast"),
        (f"<article><section>{ARTICLE}</section><section>{ARTICLE}</section></article>", f"{TEXT}\n\n{TEXT}"),
        (f"<body><main><h1>T</h1><section>{ARTICLE}</section><section>{ARTICLE}</section></main>{NAV}", f"T\n\n{TEXT}\n\n{TEXT}"),
        (f"<body><div><h1>T</h1><div>{ARTICLE}</div></div><div>Copyright</div>", f"T\n\n{TEXT}"),
        (f"<article><h1>T</h1><div>{ARTICLE}</div>{LINKS}</article>", f"T\n\n{TEXT}"),
        (f"<article><div><div>{ARTICLE}</div><figure><figcaption>cap</figcaption></figure><div>{ARTICLE}</div></div></article>", f"{TEXT}\n\ncap\n\n{TEXT}"),
        (f"<body><div>{LINKS}<div>{ARTICLE}</div><div>Copyright</div></div>", TEXT),
    ],
)
def test_the_article_is_whole(page, text):
    assert main_text(page) == text


def plain_densities(root, link_share):
    """(density, sum) of every element in document order, from the tree itself."""

    def size(text):
        return len("".join((text or "").split()))

    def counts(e, linked):
        linked = linked or e.tag == "a"
        chars = size(e.text) + sum(size(c.tail) for c in e)
        found = [chars, chars if linked else 0, 0, 0]
        for c in e:
            below = counts(c, linked)
            found = [x + y for x, y in zip(found, below)]
            found[2] += c.tag not in ("b",)
            found[3] += c.tag == "a"
        return found

    def density(e, linked=False):
        c, lc, t, lt = counts(e, linked)
        if not c or e.tag in ("a", "b"):
            return 0.0
        inner = math.log(c / max(1, c - lc) * lc + link_share(root, counts) * c + math.e)
        return c / max(1, t) * math.log(c / max(1, lc) * max(1, t) / max(1, lt) + 1) / math.log(inner + 1)

    out = []

    def visit(e, linked):
        out.append((density(e, linked), sum(density(c, linked or e.tag == "a") for c in e)))
        for c in e:
            visit(c, linked or e.tag == "a")

    visit(root, False)
    return out


def test_densities_against_the_definition():
    rng = random.Random(6)

    def element(depth):
        tag = rng.choice(["div", "section", "div", "a", "b"]) if depth else "body"
        inner = "".join(rng.choice(["word and word ", "", "x"]) + (element(depth + 1) if depth < 5 and rng.random() < 0.6 else "") for _ in range(3))
        return f"<{tag}>{inner}</{tag}>"

    def share(root, counts):
        c, lc, *_ = counts(root, False)
        return lc / c if c else 0.0

    for _ in range(60):
        page = element(0)
        want = plain_densities(ElementTree.fromstring(page), share)
        density, total = densities(Page(page))
        assert [(round(d, 9), round(s, 9)) for d, s in zip(density[1:], total[1:])] == [(round(d, 9), round(s, 9)) for d, s in want]


@pytest.mark.parametrize("page", ["<div>" * 100 + "</span>" * 50_000 + "x", "<b><i>" * 25_000 + "</u>" * 50_000 + "x", "<p><a>" * 30_000 + "x"])
def test_broken_pages_take_no_square_of_time(page):
    begun = time.perf_counter()
    assert main_text(page) == "x"
    assert time.perf_counter() - begun < 20


def test_repeated_rows(spark):
    rows = [(1, f"<p>{LONG}"), (1, f"<p>{LONG}"), (None, None)]
    found = extract_text(spark.createDataFrame(rows, "row int, html string"), "html").collect()
    assert sorted(r.text for r in found) == ["", LONG, LONG]


def test_links_lower_the_density():
    plain, _ = densities(Page(f"<body><div>{LONG}</div><div>x</div>"))
    linked, _ = densities(Page(f"<body><div><a>{LONG}</a></div><div>x</div>"))
    assert plain[2] > linked[2] > 0


def test_very_long_page_and_empty_table(spark):
    page = "<article>" + f"<p>{LONG}</p>" * 20_000 + "</article>"
    assert main_text(page) == "\n\n".join([LONG] * 20_000)
    empty = spark.createDataFrame([], "html string, n_chars string")
    assert extract_text(empty, "html").collect() == []
