"""The published tables: distinct sentence pairs and document pairs, first seen first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import in_script, posted


def fold(pairs: DataFrame, copies: DataFrame | None = None, order: list[str] | None = None) -> DataFrame:
    """Distinct (lang, en, text) whose sides are in their own scripts, in first-seen order (column ``seen``), with occurrences.

    pairs: the columns of a sentence pair, and those of ``order`` (ord by
    default), which order the rows totally.  All other columns come from the
    first row.  copies: (lang, en, text, google_copy, ord); of equal keys the
    last counts.  A pair in a language that is not known is left out.
    The first row is found by a partial minimum: no window, no hot task.
    """
    order = order or ["ord"]
    kept = pairs.where(in_script(F.lit("en"), F.col("en")) & in_script(F.col("lang"), F.col("text")))
    first = F.min(F.struct(*order, "sim", "numbers", "confidence", "en_prid", "text_prid", "office", "date")).alias("f")
    folded = kept.groupBy("lang", "en", "text").agg(first, F.count("*").alias("occurrences"))
    if copies is None:
        folded = folded.withColumn("google_copy", F.lit(None).cast("boolean"))
    else:
        folded = folded.join(copies.groupBy("lang", "en", "text").agg(F.max_by("google_copy", "ord").alias("google_copy")), ["lang", "en", "text"], "left")
    line = posted(F.col("f.date"))
    return folded.select(
        "lang", "en", "text", F.col("f.sim").alias("similarity"), F.col("f.numbers").alias("numbers_agree"), "f.confidence", "google_copy", "occurrences", "f.en_prid", "f.text_prid",
        "f.office", line["date"].alias("date"), line["posted_by"].alias("posted_by"), F.struct(*(F.col("f")[c].alias(c) for c in order)).alias("seen"),
    )


def documents(groups: DataFrame) -> DataFrame:
    """One row for each (English release, translation), the first by (ord, place in the group); null ids are equal to each other here. A partial minimum: no window, no hot task."""
    sides = groups.where(F.map_contains_key("byLang", F.lit("en"))).select("*", F.col("byLang")["en"].alias("e"), F.posexplode("byLang").alias("at", "lang", "doc")).where("lang != 'en'")
    doc = F.struct("ord", "at", "lang", "e", "doc", "ministry", "office", "date")
    first = sides.groupBy(F.col("e.prid"), F.col("doc.prid")).agg(F.min(doc).alias("f")).select("f.*")
    line = posted(F.col("date"))
    return first.select(
        "lang", F.col("e.prid").alias("en_prid"), F.col("doc.prid").alias("text_prid"), F.col("e.title").alias("en_title"), F.col("e.body").alias("en_body"), "doc.title", "doc.body",
        F.coalesce("ministry", F.lit("")).alias("ministry"), "office", line["date"].alias("date"), line["posted_by"].alias("posted_by"),
    )
