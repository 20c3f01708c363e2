import re
import time

from bitloom.functions.html import FOOTER_LINE, decode_entities, html_text, parse_releases
from bitloom.functions.text import JS_SPACE, PY_SPACE, strip
from pyspark.sql import functions as F


def page(title, body, links="", date="Posted On: 28 NOV 2025 6:07PM by Press Office", box=True):
    cls = "innner-page-main-about-us-content-right-part" if box else "other"
    return (
        f'<style>.innner-page-main-about-us-content-right-part{{}}</style><div class="{cls}"><div id="MinistryName">Ministry of Textiles</div>'
        f'<h1 id="Titleh2">{title}</h1><div id="PrDateTime">{date}</div>{body}<span id="ReleaseId">7</span></div><div id="P_CategoryManagement"></div>'
        f'<div class="ReleaseLang">{links}</div>'
    )


def link(prid, label):
    return f"<a href='/x.aspx?PRID={prid}' target=\"_blank\"> {label} </a>"


def parse(spark, *pages, hint=""):
    df = spark.createDataFrame([(str(k), p) for k, p in enumerate(pages)], "prid string, html string")
    return [r.asDict() for r in parse_releases(df, F.lit(hint)).orderBy("prid").collect()]


def test_an_english_page_and_its_links(spark):
    (r,) = parse(spark, page("Cotton in &amp;amp; out", "<p>One&nbsp;&nbsp; two &#8377;5 &#x20B9;.</p><p>Next</p>", link(2318933, "हिन्दी")))
    assert r["lang"] == "en" and r["translations"] == {"hi": "2318933"} and r["title"] == "Cotton in & out"
    assert r["body"] == "One two ₹5 ₹.\nNext" and r["date"] == "28 NOV 2025 6:07PM by Press Office" and r["ministry"] == "Ministry of Textiles"


def test_office_labels_fill_only_what_is_missing(spark):
    a, b = parse(spark, page("T", "x", link(1, "Bengali-TR") + link(2, "Telugu_Vw")), page("T", "x", link(1, "Hindi_Cg") + link(2, "Hindi") + link(3, "Odia") + link(4, "Oriya")))
    assert a["translations"] == {"bn": "1", "te": "2"} and b["translations"] == {"hi": "2", "or": "4"}


def test_error_pages_have_no_release(spark):
    a, b = parse(spark, "<html>Sorry</html>", None)
    assert (a["title"], a["body"], b["body"], b["translations"]) == ("", "", "", {})


def test_event_layout_and_footer_line(spark):
    html = page("T", "").replace('<div id="PrDateTime">Posted On: 28 NOV 2025 6:07PM by Press Office</div>', "<p>Prose.</p><p>Visitor Counter : 5</p><div id=\"FooterEventText\">Festival</div>")
    assert parse(spark, html)[0]["body"] == "Prose."


def test_posts_go_and_quotations_stay(spark):
    body = (
        '<p>Before.</p><blockquote class="twitter-tweet"  align="center" ><p>One.</p></blockquote><blockquote><p>Left.</p>'
        '<a href="https://x.com/someone/status/19878">x</a></BLOCKQUOTE><blockquote><p>A line of law.</p></blockquote><p>After.</p>'
    )
    assert parse(spark, page("T", body))[0]["body"] == "Before.\nA line of law.\nAfter."


def test_languages(spark):
    rows = [("भारत का", "", "hi"), ("भारत का", "mr", "mr"), ("GST भारत सरकार का", "", "hi"), ("Hello", "lus", "lus"), ("ਪੰਜਾਬ।।।।", "hi", "pa"), ("", "ta", "ta"), ("2047", "", ""), ("Hello", "hi", "en")]
    for title, hint, want in rows:
        assert parse(spark, page(title, "<p>।</p>"), hint=hint)[0]["lang"] == want, title


def test_references(spark):
    rows = [("a&zwj;b&zwnj;c", "a‍b‌c"), ("&amp;lt;", "&lt;"), ("&#1114112;&#x110000;", "&#1114112;&#x110000;"), ("&#X41;&#66;&#x1F600;", "AB😀"), ("&none; & &#;", "&none; & &#;"), ("&AMP;&Lt;", "&<")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert [r[0] for r in df.select(decode_entities(F.col("a"))).collect()] == [b for _, b in rows]
    df = spark.createDataFrame([("<p>a</p>\r\n\n\n<div> b  <b>c</b></div> ",)], "a string")
    assert df.select(html_text(F.col("a"))).first()[0] == "a\n\nb c"


def test_a_long_run_of_spaces_takes_no_longer_than_its_length(spark):
    gap, began = "\xa0" * 300_000, time.monotonic()
    (r,) = parse(spark, page("T", f"<p>{gap}a{gap}b</p>{gap}"))
    assert r["body"] == f"a{gap}b" and time.monotonic() - began < 30


def test_no_body_is_made_that_is_not_read(spark):
    df = spark.createDataFrame([("1", page("Cotton", "x")), ("2", page("", "पाठ"))], "prid string, html string")
    rel = parse_releases(df)
    plan = rel.select("prid", "lang")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(f"{FOOTER_LINE})") == 1  # of pages without a title
    assert sorted(map(tuple, rel.select("prid", "lang", "body").collect())) == [("1", "en", "x"), ("2", "hi", "पाठ")]


def test_every_sign_of_space_is_trimmed(spark):
    for space in (JS_SPACE, PY_SPACE):
        signs = [chr(k) for k in range(0x3001) if re.fullmatch(f"[{space}]", chr(k), re.ASCII)] + ["\ufeff"] * (space == JS_SPACE)
        df = spark.createDataFrame([(f"{s}\n a{s}\x00{s} \n{s}",) for s in signs], "x string")
        assert len(signs) > 20 and [r[0] for r in df.select(strip(F.col("x"), space)).collect()] == [f"a{s}\x00" for s in signs]
