"""Releases joined with their translations, and reports of what they link."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.html import parse_releases
from ..functions.text import settled


def release_groups(releases: DataFrame, pages: DataFrame, columns: list[str]) -> DataFrame:
    """Each release with the translations it links: prid, date, ministry, byLang (its own language first, then ``columns`` in order).

    A linked page is read as the language asked for, whatever its script.  A
    release without a body has no group; a translation without one is left out;
    of equal languages the last wins.  Releases are parsed once with their bodies
    (what they ask for needs none), linked pages once for all languages; then one
    join on the page and one shuffle back by release.
    """
    page = lambda column, at: F.struct(at.alias("at"), column.alias("column"), F.col("translations")[column].alias("page"))
    asks = F.filter(F.transform(F.array(*map(F.lit, columns)).cast("array<string>"), page), lambda a: (a["column"] != F.col("lang")) & (a["page"] != ""))
    asked = releases.select("prid", F.inline(asks)).distinct()
    sides = asked.join(_parsed(pages, asked), F.col("page") == F.col("linked"))
    value = F.struct("linked", "title", "body")
    linked = sides.groupBy("prid").agg(F.array_sort(F.collect_list(F.struct("at", F.col("column").alias("key"), value.alias("value")))).alias("sides"))
    own = F.struct(F.col("lang").alias("key"), F.struct("prid", "title", "body").alias("value"))
    pair = lambda s: F.struct(s["key"].alias("key"), F.struct(s["value"]["linked"].alias("prid"), s["value"]["title"].alias("title"), s["value"]["body"].alias("body")).alias("value"))
    mine = F.filter("sides", lambda s: (s["key"] != F.col("lang")) & (F.col("translations")[s["key"]] == s["value"]["linked"]))
    pairs = F.when(F.col("sides").isNull(), F.array(own)).otherwise(F.concat(F.array(own), F.transform(mine, pair)))
    return _with_body(releases).join(linked, "prid", "left").select("prid", "date", "ministry", F.map_from_entries(pairs).alias("byLang"))


def _with_body(rows: DataFrame) -> DataFrame:
    """Rows that have a body. A plain filter would be moved below the step that makes the body, and make it twice."""
    return rows.select(*(c for c in rows.columns if c != "body"), F.explode(F.filter(F.array("body"), lambda b: F.length(b) > 0)).alias("body"))


def _parsed(pages: DataFrame, asked: DataFrame) -> DataFrame:
    """Title and body of each page asked for that has one; the language asked for does not change them."""
    chosen = pages.join(asked.select(F.col("page").alias("prid")).distinct(), "prid", "left_semi")
    return _with_body(parse_releases(chosen).select(F.col("prid").alias("linked"), "title", "body"))


def link_report(releases: DataFrame) -> DataFrame:
    """One row: linked, total, english (whether all releases are English, as none are), report."""
    has_any, has_english = F.size(F.map_keys("translations")) > 0, F.map_contains_key("translations", "en")
    counted = releases.agg(
        F.coalesce(F.bool_and(F.col("lang") == "en"), F.lit(True)).alias("english"), F.count("*").alias("total"), F.count_if(has_any).alias("any"), F.count_if(has_english).alias("own")
    )
    linked = F.when(F.col("english"), F.col("any")).otherwise(F.col("own"))
    kind = F.when(F.col("english"), "a").otherwise("an English")
    return counted.select(linked.alias("linked"), "total", "english", F.format_string("%d of %d releases link %s translation", linked, "total", kind).alias("report"))


def stale_pages(pages: DataFrame, now) -> DataFrame:
    """Pages to fetch again: their releases are not a week old."""
    return pages.where(~settled(F.col("html"), now))
