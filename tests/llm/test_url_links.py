"""Every form of link, against Python's own html and url readers, and against the query's SQL."""

import random
from html.parser import HTMLParser
from urllib.parse import urljoin

import duckdb
from bitloom.llm.queries import QUERIES, SQL
from bitloom.llm.url_filter import link_edges

FORMS = [
    '<link rel="canonical" href="{0}">', "<link href='{0}' rel='canonical'/>", "<LINK REL=canonical HREF={0} >", '<link rel="nofollow canonical" href="{0}">', '<link data-x="a>b" rel="canonical" href=" {0}\n">',
    '<meta http-equiv="refresh" content="0; url={0}">', "<META content='5;URL=\"{0}\"' http-equiv=Refresh>", '<meta http-equiv="refresh" content="0;{0}">',
    '<link rel="canonical" rel="x" href="{0}" href="http://never.net/">', '<link\nrel\t=\n"canonical"\nhref = "{0}" title="it\'s">', "<link rel=canonical title='say \"hi\"' href='{0}'>",
]
IDLE = [
    '<!-- <link rel="canonical" href="{0}"> -->', "<script>var x = '<link rel=canonical href={0}>';</script>", '<link data-rel="canonical" href="{0}">', '<link rel="canonical" data-href="{0}">', '<link rel="canonicals" href="{0}">',
    '<link rel="stylesheet" href="{0}">', '<meta name="refresh" content="0; url={0}">', '<linkx rel="canonical" href="{0}">', '<meta http-equiv="refresh" content="30">', "<style><link rel=canonical href={0}></style>", "<p>canonical {0}</p>",
]
TARGETS = ["http://a.com/x?p=1&amp;q=2", "/x", "y", "../z", "./w/../v", "?q=1", "#top", "//b.com/k", "HTTP://B.com", "d/e?x=../y", "mailto:me@a.com", "&#47;x", "x&eacute;&zzz", "..", "https://a.com/a/b/", "%2e"]
BASES = ["", "", "", '<base href="/deep/er/">', "<base target=x><base href='http://b.com/base/p'>", '<base href="sub/">']


class Reader(HTMLParser):
    def __init__(self):
        super().__init__()
        self.targets, self.base = [], None

    def handle_starttag(self, tag, attrs):
        first = {}
        for k, v in attrs:
            first.setdefault(k, (v or "").strip(" \t\n\f\r"))
        if tag == "base" and self.base is None and "href" in first:
            self.base = first["href"]
        if tag == "link" and "canonical" in first.get("rel", "").lower().split():
            self.targets.append(first.get("href", ""))
        if tag == "meta" and first.get("http-equiv", "").lower() == "refresh":
            _, _, rest = first["content"].partition(";")
            rest = rest.strip()
            rest = rest[4:].strip() if rest.lower().startswith("url=") else rest
            self.targets.append(rest.strip("\"'"))


def node(url):
    if "://" not in url:
        return None
    rest = url.split("://", 1)[1].split("#")[0]
    cut = min((rest.find(c) for c in "/?" if c in rest), default=len(rest))
    return rest[:cut].lower() + (rest[cut:] or "/") if rest[:cut] else None


def plain_edges(rows):
    out = set()
    for _, url, html in rows:
        if url and html:
            reader = Reader()
            reader.feed(html)
            base = urljoin(url, reader.base) if reader.base is not None else url
            out |= {(node(url), node(urljoin(base, t))) for t in reader.targets if t}
    return {e for e in out if None not in e}


def corpus(seed, n=160):
    rng = random.Random(seed)
    url = lambda: f"http://{rng.choice(['a.com', 'b.com', 'c.de.com', 'a.org', 'x.example.org'])}/{rng.choice(['', 'x', 'de/1', 'fr/1', 'deep/er/', 'es/2', 'a/b/', 'k', 'z'])}{rng.choice(['', '', '?p=1&q=2', '?q=1'])}"
    rows = []
    for k in range(n):
        some = [rng.choice(FORMS if rng.random() < 0.6 else IDLE).format(rng.choice(TARGETS) if rng.random() < 0.7 else url().replace("&", "&amp;")) for _ in range(rng.randrange(3))]
        rows.append((k, url(), "<html><head>" + rng.choice(BASES) + " ".join(some) + "</head><body>canonical</body>"))
    return [*rows, (n, None, FORMS[0].format("http://a.com/x")), (n + 1, "none", FORMS[0].format("http://a.com/x")), (n + 2, "http://a.com/q", None), (n + 3, "http://a.com/q", "")]


def test_edges_are_those_of_a_plain_reader(spark):
    rows = corpus(1, 400)
    got = {tuple(r) for r in link_edges(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == plain_edges(rows) and len(got) > 150


def test_query_and_sql_agree_where_there_are_links(spark, tmp_path):
    rows = corpus(2)
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted((r.page_id, r.host, r.path, str(r.rule), r.verdict) for r in QUERIES["op10_url_filter"](spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    out = con.execute(SQL["op10_url_filter"])
    names = [d[0] for d in out.description]
    want = sorted((r["page_id"], r["host"], r["path"], str(r["rule"]), r["verdict"]) for r in (dict(zip(names, x)) for x in out.fetchall()))
    assert got == want
    # by the plain reader: blocked pages' components, but for those that a rule decides
    reach, edges = {node(u) for _, u, _ in rows if u and ("/de/" in u and "com/" in u or "example.org/es/" in u)}, plain_edges(rows)
    while more := {b for a, b in edges if a in reach} | {a for a, b in edges if b in reach}:
        if more <= reach:
            break
        reach |= more
    assert {r[0] for r in got if r[3] == "None" and r[4] == "block"} == {k for k, u, _ in rows if u and node(u) in reach} - {r[0] for r in got if r[3] != "None"}
    assert sum(r[3] == "None" and r[4] == "block" for r in got) > 5
