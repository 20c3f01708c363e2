from bitloom.llm.components import connected_components
from bitloom.llm.url_filter import host_of, link_edges, path_of, unescape, url_filter
from pyspark.sql import functions as F

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "bad.com/"), ("allow", "fine.bad.com/ok")]


def page(link):
    return f'<html><head><link href="{link}" rel="canonical"></head></html>'


def test_components_against_union_find(spark):
    import random

    rng = random.Random(1)
    for n, m in ((30, 20), (60, 55), (200, 190)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(k, k + 1) for k in range(n, n + 40)] + [(n + 100, n + 100 + k) for k in range(1, 30)]
        root = list(range(n + 200))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in edges:
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
        df = spark.createDataFrame([*edges, (None, 1), (5, None)], "a long, b long")
        got = {r.node: r.component for r in connected_components(df, "a", "b").collect()}
        assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}


def test_host_and_path(spark):
    urls = ["HTTP://Ex.COM/A?b#c", "http://x.org", "x://y?q=://z/", "nothing", None, "://", "a://h#f/", "http://u@h:80/p\nq"]
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select(host_of(F.col("u")), path_of(F.col("u"))).collect()
    assert [tuple(r) for r in rows] == [("ex.com", "/A"), ("x.org", ""), ("y", ""), ("", ""), ("", ""), ("", ""), ("h", ""), ("u@h:80", "/p\nq")]


def test_verdicts(spark):
    rows = [
        (1, "http://bad.com/x", None, "n"), (2, "http://alias.net/a#top", page("https://bad.com/x"), "n"), (3, "http://further.net/", page("http://alias.net/a"), "n"),
        (4, "http://kept.org/", page("http://bad.com/x"), "n"), (5, "http://fine.bad.com/ok/1", page("http://bad.com/x"), "n"), (6, "http://example.org/es/1", "", "n"),
        (7, None, None, "n"), (8, "no url", page("http://bad.com/x"), "n"), (9, "http://other.net/1", page("/2"), "n"),
        (10, "http://r.net/1/2", '<meta http-equiv="Refresh" content="0; URL=go">', "n"), (11, "http://r.net/1/go", page("//bad.com/x"), "n"), (1, "http://bad.com/x", None, "n"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = sorted((r.page_id, r.rule, r.verdict) for r in url_filter(pages, RULES).collect())
    want = [
        (1, "bad.com/", "block"), (1, "bad.com/", "block"), (2, None, "block"), (3, None, "block"), (4, "org/", "allow"), (5, "fine.bad.com/ok", "allow"),
        (6, "example.org/es/", "block"), (7, None, "allow"), (8, None, "allow"), (9, None, "allow"), (10, None, "block"), (11, None, "block"),
    ]
    assert got == want
    joined = url_filter(pages, spark.createDataFrame(RULES, "verdict string, rule string"))
    assert sorted((r.page_id, r.rule, r.verdict) for r in joined.collect()) == want
    assert url_filter(pages.limit(0), RULES).count() == 0
    given = spark.createDataFrame([("http://other.net/1", "http://bad.com/x")], "a string, b string")
    assert {r.page_id: r.verdict for r in url_filter(pages, RULES, given, html_col=None).collect()}[9] == "block"


def test_long_tags_references_and_rel_words(spark):
    long = "x" * 5_000
    rows = [
        (1, "http://bad.com/x?a=1&b=2", None),
        (2, "http://long.net/", f'<link data-x="{long}" href="http://bad.com/x?a=1&amp;b=2" rel="canonical">'),
        (3, "http://meta.net/", f'<meta name="{long}" http-equiv="refresh" data-x="{long}" content="0; url=http://bad.com/x?a=1&#38;b=2">'),
        (4, "http://words.net/", '<link rel="alternate\ncanonical" href="http://bad.com/x?a=1&amp;b=2">'),
        (5, "http://words.org.net/", "<link rel=' Canonical nofollow' href='//bad.com/x?a=1&#x26;b=2'>"),
        (6, "http://other.net/", '<link rel="canonical-not" href="http://bad.com/x?a=1&amp;b=2">'),
        (7, "http://open.net/", '<link rel="canonical" href="http://bad.com/x?a=1&amp;b=2" ' + "<link " * 200_000),
        (8, "http://twice.net/", '<link rel="canonical" href="http://bad.com/x?a=1&amp;amp;b=2">'),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id for r in url_filter(pages, RULES).collect() if r.verdict == "block"} == {1, 2, 3, 4, 5}
    assert len(link_edges(pages).collect()) == 5
    given = ["&amp;lt;", "&#38;lt;", "a&eacute;&Eacute;&#233;", "&copy=1&nosuch;&", "", "a&b", "&#xD800;"]
    rows = spark.createDataFrame([(t,) for t in given], "t string").select(unescape(F.col("t"))).collect()
    assert [r[0] for r in rows] == ["&lt;", "&lt;", "aéÉé", "&copy=1&nosuch;&", "", "a&b", "&#xD800;"]
