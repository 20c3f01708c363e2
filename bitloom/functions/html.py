"""Release pages: entities, text of html, and every part of a release as native columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..languages import LABELS
from .text import JS_SPACE, clean_dateline, let, page_lang, redact, strip

# Entities, markers and forms of the pages ------------------------
ENTITIES = {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "zwj": "\u200d", "zwnj": "\u200c", "lsquo": "\u2018", "rsquo": "\u2019",
    "ldquo": "\u201c", "rdquo": "\u201d", "mdash": "\u2014", "ndash": "\u2013", "hellip": "\u2026", "middot": "\u00b7", "bull": "\u2022",
    "deg": "\u00b0", "times": "\u00d7", "laquo": "\u00ab", "raquo": "\u00bb", "copy": "\u00a9", "reg": "\u00ae", "trade": "\u2122", "rupee": "\u20b9",
    "amp": "&",
}
CONTAINER, MODAL = 'class="innner-page-main-about-us-content-right-part"', '<div id="P_CategoryManagement"'
DATELINE, HEADINGS = '<div id="PrDateTime"', ['<h3 id="Subtitleh3"', '<h1 id="Titleh2"']
ENDS = [
    '<span id="ReleaseId"', '<span id="lblViews"', '<div class="ReleaseLang"', '<div id="RelLink"', '<div id="FooterEventText"', '<span id="ReleaseIdEvent"',
    '<span id="lblViewsEvent"',
]
POST = r'(?i)class="(?:twitter-tweet|instagram-media)|(?:twitter|x)\.com/\w+/status/|instagram\.com/(?:p|reel)/'
FOOTER_LINE = "Visitor Counter"
# --------------------------------------------------------------------------------


def _character(code: Column) -> Column:
    """The character of a code point; Spark's chr() knows only 256."""
    return F.decode(F.unhex(F.lpad(F.hex(code.cast("long")), 8, "0")), "UTF-32")


def _numeric(c: Column, lead: str, digits: str, base: int) -> Column:
    """References of one base. Code points beyond Unicode, and surrogates, stay as written."""
    form = rf"\A{lead}0*([{digits}]+);"

    def one(p: Column) -> Column:
        number = F.regexp_extract(p, form, 1)
        code = F.when(F.length(number).between(1, 6 if base == 16 else 7), F.conv(number, base, 10).cast("long"))
        fits = lambda k: (k <= 0x10FFFF) & ~k.between(0xD800, 0xDFFF)
        character = let(code, lambda k: F.when(fits(k), _character(F.when(fits(k), k))))
        return F.coalesce(F.concat(character, F.regexp_replace(p, form, "")), F.concat(F.lit("&#"), p))

    def all_of(x: Column) -> Column:
        rest = lambda parts: F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), one), "")
        replaced = let(F.split(x, rf"&#(?={lead}[{digits}]+;)", -1), lambda parts: F.concat(parts[0], rest(parts)))
        return F.when(x.contains("&#"), replaced).otherwise(x)

    return let(c, all_of)


def _named(c: Column) -> Column:
    """Named references, each read once, so that what '&amp;' yields is not read again; unknown ones stay."""
    known = F.create_map(*(F.lit(x) for pair in ENTITIES.items() for x in pair))

    def one(part: Column) -> Column:
        name = F.regexp_extract(part, "^([A-Za-z]+);", 1)
        return let(F.struct(name.alias("name"), known[F.lower(name)].alias("char")), lambda n: F.coalesce(F.concat(n["char"], F.substr(part, F.length(n["name"]) + 2)), F.concat(F.lit("&"), part)))

    def all_of(parts: Column) -> Column:
        return F.concat(parts[0], F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), one), ""))

    return let(c, lambda x: F.when(x.contains("&"), let(F.split(x, "&", -1), all_of)).otherwise(x))


def decode_entities(c: Column) -> Column:
    """One pass: hexadecimal, then decimal, then named references; unknown ones stay."""
    return _named(_numeric(_numeric(c, "[xX]", "0-9a-fA-F", 16), "", "0-9", 10))


def html_text(c: Column) -> Column:
    """Text of html: closing blocks break lines, other tags are spaces, references are decoded twice."""
    out = F.replace(c, F.lit("\r"), F.lit(""))
    out = F.regexp_replace(out, rf"(?i)<(?:br[{JS_SPACE}]*/?|/(?:p|div|li|h[0-9]))>", "\n")
    out = decode_entities(decode_entities(F.regexp_replace(out, "<[^>]+>", " ")))
    out = F.regexp_replace(out, "\n[ \t]+", "\n")
    out = F.regexp_replace(out, "[ \t]{2,}", " ")
    return strip(F.regexp_replace(out, "\n{3,}", "\n\n"))


def without_posts(html: Column) -> Column:
    """Embedded posts go, with their quotation element; plain quotations stay."""

    def one(p: Column) -> Column:
        quote = F.regexp_extract(p, r"(?is)<blockquote\b[^>]*>.*</blockquote>\z", 0)
        return let(quote, lambda q: F.when((q != "") & q.rlike(POST), F.substring(p, F.lit(1), F.length(p) - F.length(q))).otherwise(p))

    parts = F.split(F.regexp_replace(html, "(?i)(</blockquote>)", "$1\u0001"), "\u0001", -1)
    return F.when(html.rlike("(?i)</blockquote>"), F.array_join(F.transform(parts, one), "")).otherwise(html)


def raw_field(html: Column, name: str) -> Column:
    """What the first element whose first attribute is this id holds, up to the first closing tag."""
    return F.regexp_extract(html, rf'(?i)<[a-z0-9]+ id="{name}"[^>]*>([\s\S]*?)</[a-z0-9]+>', 1)


def field(html: Column, name: str) -> Column:
    return redact(html_text(raw_field(html, name)))


def _at(marker: str, c: Column, start: Column | int = 1) -> Column:
    """Where the marker stands at or after start, or null."""
    return F.nullif(F.position(F.lit(marker), c, F.lit(start) if isinstance(start, int) else start), F.lit(0))


def container(html: Column) -> Column:
    """The release's part of a page; empty where there is none, as on an error page."""
    end = F.coalesce(_at(MODAL, html), F.length(html) + 1)
    return F.coalesce(let(_at(CONTAINER, html), lambda begin: F.substring(html, begin, F.greatest(end - begin, F.lit(0)))), F.lit(""))


def release_body(html: Column) -> Column:
    """The prose of a release, not yet redacted. A page whose markup breaks off before its prose has none."""
    prose = let(container(html), lambda box: let(_begin(box), lambda begin: _prose(box, begin)))
    lines = F.filter(F.split(prose, "\n", -1), lambda x: ~x.contains(FOOTER_LINE))
    return F.coalesce(strip(F.array_join(lines, "\n")), F.lit(""))


def _begin(box: Column) -> Column:
    """Past the dateline; without one at the end of the first heading; without either at the start."""
    dateline, heading = _at(DATELINE, box), F.coalesce(*(_at(h, box) for h in HEADINGS))
    after_heading = _at("</h", box, heading + 4)
    return F.when(dateline.isNotNull(), _at("</div>", box, dateline) + len("</div>")).when(heading.isNotNull(), after_heading).otherwise(1)


def _prose(box: Column, begin: Column) -> Column:
    prose = F.substring(box, begin, F.length(box))
    for marker in ENDS:
        prose = F.substring_index(prose, marker, 1)
    return html_text(F.regexp_replace(prose, "(?i)<input[^>]*>", ""))


def translations(html: Column) -> Column:
    """Map of language code to release id, from the first language block.

    National labels come first, of one language the last; then an office's own
    labels (the part before '-' or '_', or the label itself), of one code the
    first, where no national one stands.
    """
    block = F.regexp_extract(html, r'(?i)<div class="ReleaseLang">([\s\S]*?)</div>', 1)
    form = F.lit(rf"PRID=([0-9]+)'[^>]*>[{JS_SPACE}]*([^<]+?)[{JS_SPACE}]*</a>")
    known = F.create_map(*(F.lit(x) for kv in LABELS.items() for x in kv))

    def coded(label: Column, prid: Column) -> Column:
        own = F.coalesce(known[F.element_at(F.split(label, "[-_]", -1), 1)], label)
        return let(known[label], lambda code: F.struct(code.alias("national"), F.when(code.isNull(), own).alias("own"), prid.alias("id")))

    pairs = let(block, lambda x: F.zip_with(F.regexp_extract_all(x, form, F.lit(1)), F.regexp_extract_all(x, form, F.lit(2)), lambda i, t: let(strip(t), lambda label: coded(label, i))))
    return let(pairs, _by_code)


def _by_code(pairs: Column) -> Column:
    first = F.filter(pairs, lambda p: p["national"].isNotNull())
    first_codes = F.array_distinct(F.transform(first, lambda p: p["national"]))
    second = F.filter(pairs, lambda p: (p["own"] != "") & ~F.array_contains(first_codes, p["own"]))
    second_codes = F.array_distinct(F.transform(second, lambda p: p["own"]))
    entry = lambda some, name, k: lambda c: F.struct(c.alias("key"), F.element_at(F.filter(some, lambda p: p[name] == c), k)["id"].alias("value"))
    return F.map_from_entries(F.concat(F.transform(first_codes, entry(first, "national", -1)), F.transform(second_codes, entry(second, "own", 1))))


def parse_releases(pages: DataFrame, hint: Column | None = None) -> DataFrame:
    """pages (prid, html) as releases: prid, lang, title, subtitle, ministry, date, body, translations.

    A null page is an empty one.  The language is found on the body before it is
    redacted, and redaction comes last.  A body is made once, and only where it
    is asked for or no title tells the language.  One narrow stage: no shuffle.
    """
    hint = F.lit("") if hint is None else F.coalesce(hint, F.lit(""))
    clean = pages.select("prid", hint.alias("hint"), without_posts(F.coalesce("html", F.lit(""))).alias("html"))
    parts = clean.select(
        "prid", "hint", "html", field(F.col("html"), "Titleh2").alias("title"), field(F.col("html"), "Subtitleh3").alias("subtitle"),
        field(F.col("html"), "MinistryName").alias("ministry"), clean_dateline(field(F.col("html"), "PrDateTime")).alias("date"), translations(F.col("html")).alias("translations"),
    )
    parts = parts.withColumn("untitled", F.when(F.col("title") == "", release_body(F.col("html"))))
    body = redact(F.coalesce("untitled", release_body(F.col("html"))))
    return parts.select("prid", page_lang(F.coalesce("untitled", "title"), F.col("hint")).alias("lang"), "title", "subtitle", "ministry", "date", body.alias("body"), "translations")
