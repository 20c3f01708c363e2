"""URL filters: explicit rules, and block decisions carried over to aliases.

Aliases are pages that redirects or canonical links connect, found as connected
components over (url, url) edges.  DataFrame operations only.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html import decode_entities
from .components import connected_components
from .line_dedup import ascii_lower
from .spill import row_key

INLINE = 500
_NAMES = json.dumps({name[:-1]: char for name, char in html5.items() if name.endswith(";")})
_REFERENCE = r"^&(#?[0-9A-Za-z]+);"
_WS = r" \t\n\f\r"
# One attribute, or the tag's end, where the one before stopped: (1) the end, (2) name, (3) to (5) value by its quoting.
_ATTRIBUTE = rf"""\G(?<!>)[{_WS}/]*+(?:(>)|([^{_WS}>/=]++)(?:[{_WS}]*+=[{_WS}]*+(?:"([^"]*+)"|'([^']*+)'|([^{_WS}>"'][^{_WS}>]*+)))?+)"""
_RAW = ("script", "style", "textarea", "title", "xmp", "iframe", "template")
_NO_MARKUP = r"(?is)<!--.*?(?:-->|\z)|" + "|".join(rf"<{t}\b[^>]*>.*?(?:</{t}\b|\z)" for t in _RAW)
_REFRESH = rf"""(?is)^(?:[0-9.]+[{_WS}]*[;,{_WS}][{_WS}]*(?:url[{_WS}]*=[{_WS}]*)?|url[{_WS}]*=[{_WS}]*)(?:"([^"]*)"?.*|'([^']*)'?.*|(.*))"""


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """The resource that a url names, as far as its spelling tells: host in lower case, no scheme, no fragment; null if it has no host."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(host_of(url), F.when(rest == "", "/").otherwise(rest)))


def _let(c: Column, body) -> Column:
    """body(c) with c computed once."""
    return F.transform(F.array(c), body)[0]


def unescape(c: Column) -> Column:
    """Character references that end in a semicolon, decoded once, named ones by HTML's own table; unknown ones stay."""
    names = F.from_json(F.lit(_NAMES), "map<string,string>")

    def one(part: Column) -> Column:
        reference = F.regexp_extract(part, _REFERENCE, 0)
        name = F.regexp_extract(part, _REFERENCE, 1)
        known = F.when(name.startswith("#"), decode_entities(reference)).otherwise(F.coalesce(names[name], reference))
        return F.when(reference == "", part).otherwise(F.concat(known, F.regexp_replace(part, _REFERENCE, "")))

    return F.when(c.contains("&"), F.array_join(F.transform(F.split(c, "(?=&)", -1), one), "")).otherwise(c)


def _tags(html: Column, name: str) -> Column:
    """The attributes of every such tag that ends, as (kind, names in lower case, values); quoted values may hold any sign. Linear, whatever the tags' length."""

    def read(piece: Column) -> Column:
        group = lambda k: F.regexp_extract_all(piece, F.lit(_ATTRIBUTE), F.lit(k))
        value = F.transform(F.arrays_zip(group(3).alias("a"), group(4).alias("b"), group(5).alias("c")), lambda v: F.concat(v["a"], v["b"], v["c"]))
        return F.struct(F.lit(name).alias("kind"), F.array_position(group(1), ">").cast("int").alias("end"), F.transform(group(2), lambda x: F.lower(x)).alias("names"), value.alias("values"))

    pieces = F.split(html, rf"(?i)<{name}(?=[{_WS}/>])", -1)
    return F.filter(F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(1))), read), lambda t: t["end"] > 0)


def _attribute(names: Column, values: Column, name: Column) -> Column:
    """The value of the first attribute of that name; null if there is none."""
    at = F.array_position(names, name).cast("int")
    return F.when(at > 0, F.element_at(values, F.when(at > 0, at)))


def resolve(target: Column, base: Column) -> Column:
    """The url that a reference means on a page at ``base``, with dot segments worked in; null if either is."""

    def parts_of(x: Column) -> Column:
        b = x["base"]
        return F.struct(
            F.regexp_replace(x["target"], r"[\t\n\r]", "").alias("t"), F.regexp_extract(b, r"(?s)^(.*?)://", 1).alias("scheme"), F.regexp_extract(b, r"(?s)^(.*?://[^/?#]*)", 1).alias("root"),
            F.regexp_extract(b, r"(?s)^.*?://[^/?#]*([^?#]*)", 1).alias("path"), F.regexp_extract(b, r"(?s)^[^#]*?(\?[^#]*)", 1).alias("query"),
        )

    def joined(x: Column) -> Column:
        t, root, path = x["t"], x["root"], x["path"]
        return (
            F.when(t.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), t)
            .when(t.startswith("//"), F.concat(x["scheme"], F.lit(":"), t))
            .when(t.startswith("/"), F.concat(root, t))
            .when(t.startswith("?"), F.concat(root, path, t))
            .when((t == "") | t.startswith("#"), F.concat(root, path, x["query"], t))
            .otherwise(F.concat(root, F.regexp_extract(path, r"(?s)^(.*)/[^/]*$", 1), F.lit("/"), t))
        )

    def without_dots(whole: Column) -> Column:
        start, rest = F.regexp_extract(whole, r"(?s)^(.*?://[^/?#]*)", 1), F.regexp_extract(whole, r"(?s)^.*?://[^/?#]*[^?#]*([?#].*)", 1)
        step = lambda got, x: F.when(x == "..", F.regexp_replace(got, r"/[^/]*\z", "")).when(x == ".", got).otherwise(F.concat(got, F.lit("/"), x))
        walk = lambda parts: F.concat(
            F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(1))), F.lit(""), step), F.when(F.element_at(parts, -1).isin(".", ".."), "/").otherwise("")
        )
        walked = _let(F.split(F.regexp_extract(whole, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), "/", -1), walk)
        return F.when(whole.rlike(r"(?s)^.*?://[^?#]*/\.\.?(?:[/?#]|\z)"), F.concat(start, walked, rest)).otherwise(whole)

    return _let(_let(_let(F.struct(target.alias("target"), base.alias("base")), parts_of), joined), without_dots)


def link_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Edges (a, b) between resources: a canonical link, or a redirect by meta refresh, from a page's html.

    Comments, scripts and other elements whose content is no markup are passed
    over.  Tags and attributes may be of any length, in any order and quoting;
    ``rel`` is a list of words; references are decoded; relative targets are
    resolved against the page's first ``base`` element, or its url.
    """
    html, url = F.regexp_replace(F.col(html_col), _NO_MARKUP, " "), F.col("url")
    pages = pages.where(F.col(html_col).rlike(r"(?i)canonical|refresh")).select(F.col(url_col).alias("url"), html.alias("html"))
    bases = F.filter(_tags(F.col("html"), "base"), lambda t: F.array_contains(F.slice(t["names"], 1, t["end"]), "href"))
    found = pages.select("url", F.get(bases, F.lit(0)).alias("base"), F.explode(F.concat(_tags(F.col("html"), "link"), _tags(F.col("html"), "meta"))).alias("t"))
    names, values, link = F.slice("t.names", 1, F.col("t.end")), F.col("t.values"), F.col("t.kind") == "link"
    raw = [_attribute(names, values, F.when(link, one).otherwise(other)) for one, other in (("rel", "http-equiv"), ("href", "content"))]
    raw = F.array(*raw, _attribute(F.col("base.names"), F.col("base.values"), F.lit("href")))
    clean = F.transform(raw, lambda v: F.regexp_replace(unescape(v), rf"\A[{_WS}]+|[{_WS}]+\z", ""))

    def meant(v: Column) -> Column:
        redirect = F.concat(*(F.regexp_extract(v[1], _REFRESH, k) for k in (1, 2, 3)))
        canonical = link & F.array_contains(F.split(F.lower(v[0]), rf"[{_WS}]+"), "canonical")
        return F.struct(F.when(canonical, v[1]).when(~link & (F.lower(v[0]) == "refresh"), redirect).alias("target"), v[2].alias("base"))

    def reached(x: Column) -> Column:
        base = F.when(x["base"].isNull(), url).otherwise(resolve(x["base"], url))
        return F.when(x["target"] != "", _let(resolve(x["target"], base), node_of))

    # The explode keeps what follows from being pushed into, and so repeated in, the expressions above.
    edge = F.struct(node_of(url).alias("a"), _let(_let(clean, meant), reached).alias("b"))
    edges = found.select(F.explode(F.filter(F.array(edge), lambda e: e["a"].isNotNull() & e["b"].isNotNull())).alias("e"))
    return edges.select("e.a", "e.b")


def _best(a: Column) -> Column:
    """The longest fitting rule; of equally long ones an allowing one."""
    return F.array_max(a)


def explicit(pages: DataFrame, rules: list[tuple[str, str]] | DataFrame, url_col: str = "url") -> DataFrame:
    """pages with host, path, rule and explicit (allow, block or null).

    Rules are (verdict, "host/path") pairs.  A short list is compared in place;
    a DataFrame (columns verdict, rule) is joined on the suffixes of the host,
    as a broadcast if Spark finds it small and by shuffle otherwise.
    """
    pages = pages.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})
    if not isinstance(rules, DataFrame):
        if len(rules) > INLINE:
            raise ValueError(f"over {INLINE} rules belong into a DataFrame")
        fits = []
        for verdict, rule in rules:
            host, slash, path = rule.partition("/")
            fit = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + path)
            fits.append(F.when(fit, F.struct(F.lit(len(rule)).alias("n"), F.lit(int(verdict == "allow")).alias("allow"), F.lit(rule).alias("rule"))))
        best = _best(F.array(*fits)) if fits else F.lit(None).cast("struct<n:int,allow:int,rule:string>")
        pages = pages.withColumn("_best", best)
    else:
        k1, k2 = row_key(url_col)
        pages = pages.withColumns({"_k1": k1, "_k2": k2})
        split = F.split("host", r"\.")
        suffixes = F.transform(F.sequence(F.lit(1), F.size(split)), lambda i: F.array_join(F.slice(split, i, 10_000), "."))
        known = rules.select(
            F.substring_index("rule", "/", 1).alias("rule_host"), F.expr("substring(rule, 1 + length(substring_index(rule, '/', 1)))").alias("rule_path"),
            F.struct(F.length("rule").alias("n"), (F.col("verdict") == "allow").cast("int").alias("allow"), "rule").alias("r"),
        )
        urls = pages.where("host != ''").select("_k1", "_k2", "host", "path").distinct()
        found = urls.select("_k1", "_k2", "path", F.explode(suffixes).alias("rule_host")).join(known, "rule_host")
        found = found.where(F.col("path").startswith(F.col("rule_path"))).groupBy("_k1", "_k2").agg(F.max("r").alias("_best"))
        pages = pages.join(found, ["_k1", "_k2"], "left").drop("_k1", "_k2")
    verdict = F.when(F.col("_best.allow") == 1, "allow").when(F.col("_best.allow") == 0, "block")
    return pages.withColumns({"rule": F.col("_best.rule"), "explicit": verdict}).drop("_best")


def url_filter(
    pages: DataFrame, rules: list[tuple[str, str]] | DataFrame, edges: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str | None = "html"
) -> DataFrame:
    """Rows of (id, host, path, rule, verdict), one for each row of pages.

    Explicit rules decide first: the longest that fits, an allowing one of equals.
    A page without a rule is blocked if a blocked page is its alias, that is, in
    one component over ``edges`` (a, b: urls of redirects) and the canonical links
    and refreshes in the pages' html.  An explicit allow takes precedence: that
    page stays allowed whatever its aliases are.  All else is allowed.

    Null urls, urls without ``://`` and empty hosts have no aliases and are
    allowed; repeated rows come back as often; other columns are ignored.
    """
    columns = [F.col(id_col).alias("_id"), F.col(url_col).alias("_url")]
    judged = explicit(pages.select(*columns), rules, "_url").withColumn("_node", node_of(F.col("_url")))
    links = link_edges(pages, url_col, html_col) if html_col else None
    if edges is not None:
        given = edges.select(node_of(F.col("a")).alias("a"), node_of(F.col("b")).alias("b"))
        links = given if links is None else links.union(given)
    if links is None:
        aliased = judged.withColumn("_caught", F.lit(False))
    else:
        parts = connected_components(links, "a", "b").select(F.col("node").alias("_node"), "component")
        # Rows of one component meet only as one pre-aggregated flag; pages outside any component need no join partner.
        blocked = judged.where("explicit = 'block'").select("_node").distinct().join(parts, "_node").select("component").distinct()
        caught = parts.join(blocked, "component").select("_node", F.lit(True).alias("_caught"))
        aliased = judged.join(caught, "_node", "left")
    verdict = F.coalesce("explicit", F.when(F.col("_caught"), "block").otherwise("allow"))
    return aliased.select(F.col("_id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"))
