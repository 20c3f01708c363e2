import itertools
import os
import random
import time
from html.parser import HTMLParser

import pyarrow.parquet as pq
import pytest
from bitloom.llm.html_extract import BIG, Flow, blocks_of, edges_of, html_extract, label, main_text

SMALL = "/root/testdata/sf0.01/pages.parquet"

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header class="site-header"><a href="/">Home</a></header><nav><ul><li><a href="/a">A</a></li></ul></nav><!-- ad <p>no</p> -->
<div class="ad">Buy this thing now.</div><div id="cookie-notice">We use cookies.</div>
<article><h1>A  title &amp; more</h1><p><b>First para.<br><p>Second&nbsp;para
with <a href="x">a link</a> in it &lt;b&gt;.</p><ul><li>one<li>two</ul><form><input><button>Go</button>Mail</form>
<div class="share-buttons">Share me</div><section class="comments"><p>I liked this long comment a lot, really.</p></section></article>
<aside>See also</aside><footer>&copy; site</footer></body></html>"""


def test_article_only():
    assert main_text(PAGE) == "A title & more\nFirst para.\nSecond para with a link in it <b>.\none\ntwo"


def test_pages_without_article():
    prose = " ".join(["Words that make a sentence of some length, as articles have."] * 4)
    html = f"<body><div class=menu><a href=1>One</a> <a href=2>Two</a></div><div><p>{prose}</p><p>Short.</p><p>{prose}</p></div><div><a href=3>next page</a></div></body>"
    assert main_text(html) == f"{prose}\nShort.\n{prose}"


def test_broken_and_odd_input():
    assert [main_text(x) for x in (None, "", "<!-- open", "<script>x", "<style>a", "<p>", "</p></div>")] == [""] * 7
    assert main_text("<article><p>A sentence that stands alone &amp;c.") == "A sentence that stands alone &c."
    assert main_text("<article>" + "<p>x y z.</p>" * 3000 + "</article>").count("\n") == 2999
    assert len(main_text("<article>" + "<div>" * 2000 + "deep words here." + "</article>")) > 0
    assert main_text('<article><p title="a>b">Quoted sign in a tag.</p></article>') == "Quoted sign in a tag."


def test_cut_is_the_cheapest_labelling():
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randrange(2, 8)
        cost = [rng.randrange(-9, 10) for _ in range(n)]
        pairs = {(a, b): rng.randrange(6) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5}
        flow = Flow(n + 2)
        for k, c in enumerate(cost):
            flow.edge(*((n, k) if c > 0 else (k, n + 1)), abs(c))
        for (a, b), w in pairs.items():
            flow.edge(a, b, w, w)
        price = lambda side: sum(abs(c) for c, s in zip(cost, side) if (c > 0) != s and c) + sum(w for (a, b), w in pairs.items() if side[a] != side[b])  # noqa: E731, B023
        assert price(flow.cut(n, n + 1)[:n]) == min(price(s) for s in itertools.product([False, True], repeat=n))


def test_neighbours_sway_a_doubtful_block():
    blocks, nodes = blocks_of("<div><p>" + "A long enough sentence to be content for sure. " * 3 + "</p><div>ok</div><p>" + "Another long enough sentence to be content for sure. " * 3 + "</p></div>")
    kept = label(blocks, nodes)
    assert kept == [True, True, True] and blocks[1].score < 0 < blocks[0].score < BIG


def test_labels_of_small_pages_are_the_cheapest():
    rng = random.Random(8)
    open_ = ["<p>", "<div>", '<div class="sidebar">', "<article>", "<ul><li>", '<a href="x">', "<h2>", "<aside>", '<section class="comments">', "<form>", "</div>", "</article>", "</ul>", "</a>", "</section>"]
    checked = flipped = 0
    while checked < 250:
        page = "".join(rng.choice(open_) + " ".join(["word"] * rng.choice([0, 1, 2, 4, 6, 9, 30])) + rng.choice(["", "."]) for _ in range(rng.randrange(2, 12)))
        blocks, nodes = blocks_of(page)
        if not 2 <= len(blocks) <= 9:
            continue
        kept = label(blocks, nodes)
        cost, edges = [round(b.score * 1000) if abs(b.score) < BIG else -BIG for b in blocks], edges_of(blocks, 0.8)
        price = lambda side: sum(abs(c) for c, x in zip(cost, side) if c and (c > 0) != x) + sum(w for a, b, w in edges if side[a] != side[b])  # noqa: E731, B023
        assert price(kept) == min(price(x) for x in itertools.product([False, True], repeat=len(blocks))), page
        checked += 1
        flipped += any((c > 0) != x for c, x in zip(cost, kept))
    assert flipped > 15


def test_attributes_are_read_by_name():
    prose = "Words that make a sentence of some length, as articles have. " * 4
    for page in (
        '<article><p title="the hidden gem">{}</p></article>', '<div class="layout has-sidebar"><article><p>{}</p></article></div>', '<div class="content no-sidebar"><p>{}</p></div>',
        '<article><p data-id="comment-12">{}</p></article>', '<article><p id="search-history">{}</p></article>', '<article><p data-hidden="x" aria-label="aria-hidden=true">{}</p></article>',
    ):
        assert main_text(page.format(prose)) == prose.strip()
    for page in ("<article><p hidden>{}</p></article>", "<article><div class=x style='color:red; DISPLAY : none'>{}</div></article>", "<article><p aria-hidden=true>{}</p></article>", '<article><div id="comments">{}</div></article>'):
        assert main_text("<article><p>One sentence that stays.</p></article>" + page.format(prose)) == "One sentence that stays."


@pytest.mark.parametrize("page", ["<div>x" * 50_000, "<ul>" + "<li>a" * 20_000, "</b>" * 1000 + "<div>" * 30_000 + "</x>" * 30_000 + "z", "<p>x y z.</p>" * 20_000])
def test_time_is_linear(page):
    began = time.process_time()
    main_text(page)
    assert time.process_time() - began < 6


class Article(HTMLParser):
    """The blocks of the given pages' articles, by their known layout: boxes inside are forms, or have a class."""

    def __init__(self):
        super().__init__()
        self.depth, self.skip, self.out, self.parts = 0, 0, [], []

    def flush(self):
        text = " ".join("".join(self.parts).split())
        self.out += [text] if text else []
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag in ("b", "a", "i", "em", "strong", "span", "code", "sub", "sup"):
            return
        self.flush()
        if tag == "article":
            self.depth += 1
        elif self.depth and (self.skip or tag in ("form", "script", "style", "aside", "nav", "footer") or "class" in dict(attrs)) and tag not in ("br", "img", "hr", "input"):
            self.skip += 1

    def handle_endtag(self, tag):
        if tag in ("b", "a", "i", "em", "strong", "span", "code", "sub", "sup"):
            return
        self.flush()
        if tag == "article":
            self.depth, self.skip = 0, 0
        elif self.skip:
            self.skip -= 1

    def handle_data(self, data):
        if self.depth and not self.skip:
            self.parts.append(data)


@pytest.mark.skipif(not os.path.exists(SMALL), reason="the given tables are not here")
def test_all_given_pages():
    for html in pq.read_table(SMALL, columns=["html"])["html"].to_pylist():
        reader = Article()
        reader.feed(html or "")
        reader.flush()
        assert main_text(html) == "\n".join(reader.out)


def test_rows(spark):
    rows = [(1, PAGE, "clash"), (2, None, "x"), (None, "", None), (1, PAGE, "clash")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = html_extract(df).collect()
    assert sorted((str(r.page_id), len(r.text)) for r in got) == sorted([("1", len(main_text(PAGE)))] * 2 + [("2", 0), ("None", 0)])
    assert html_extract(df.limit(0)).count() == 0


def test_names_on_wrappers_do_not_veto():
    prose = ["Words that make a sentence of some length, as articles have. " * n for n in (1, 3, 2)]
    prose = [p.strip() for p in prose]
    body = "<h1>A short title</h1>" + "".join(f"<p>{p}</p>" for p in prose)
    boxes = '<div class="sidebar"><p>A box about other things that has a sentence.</p></div><div class="comments"><article><p>I liked this long comment a lot, really, I did.</p></article></div>'
    wanted = "\n".join(["A short title", *prose])
    for name in ("page has-sidebar", "site no-sidebar", "social", "promo", "banner", "search", "legal"):
        assert main_text(f'<body><div class="{name}"><article>{body}</article>{boxes}</div><footer>foot</footer></body>') == wanted
        assert main_text(f'<body><main><div id="{name}"><article class="post {name}">{body}</article>{boxes}</div></main></body>') == wanted
        less = f'<body><div class="{name}"><ul class="menu"><li><a href="/">Home</a></ul><div>{body}</div><div class="sidebar"><p>A box about other things.</p></div></div></body>'
        assert main_text(less) == wanted
