"""The stratified sample, and what it says of copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.score import chrf, is_copy, one_place, wilson


def eligible(min_sim: float = 0.85, no_translation: tuple[str, ...] = ("mni",), min_units: int = 40) -> Column:
    """Well aligned, translatable, and long enough in UTF-16 units."""
    units = F.octet_length(F.encode("en", "UTF-16BE")) / 2
    return (F.col("sim") >= min_sim) & ~F.col("lang").isin(*no_translation) & (units >= min_units)


def round_robin(pairs: DataFrame, cell: list[str], group: str, order: list[str], n: int = 100) -> DataFrame:
    """At most n rows of each cell, a row of each group a round, groups and rows in first-seen order; column ``place`` from 1.

    The number of a row within its group is found on (cell, group), so a large
    cell is dealt out first; only the leading n of each group can be chosen and
    go on to the cell's own order.  The sampling limit is the operator.
    """
    within = W.partitionBy(*cell, group).orderBy(*order)
    ranked = pairs.withColumns({"_round": F.row_number().over(within), "_first": F.first(F.struct(*order)).over(within)}).where(F.col("_round") <= n)
    chosen = W.partitionBy(*cell).orderBy("_round", "_first")
    return ranked.withColumn("place", F.row_number().over(chosen)).where(F.col("place") <= n).drop("_round", "_first")


def score_copies(sample: DataFrame, order: list[str] = ()) -> DataFrame:
    """sample with ``translated`` (the machine's text) as copy rows, and its columns ``order``; the machine's text itself goes no further."""
    scored = sample.withColumn("_s", chrf("translated", "text"))
    return scored.select("prid", "office", "lang", "en", "text", one_place(F.col("_s")).alias("chrf"), is_copy(F.col("_s")).alias("google_copy"), *order)


def copy_rates(copies: DataFrame) -> DataFrame:
    """office, lang, k, n, percent and the interval, in order of office and language."""
    counted = copies.groupBy("office", "lang").agg(F.count_if("google_copy").alias("k"), F.count("*").alias("n"))
    w = wilson(F.col("k"), F.col("n"))
    return counted.select("office", "lang", "k", "n", (100.0 * F.col("k") / F.col("n")).alias("percent"), w["low"].alias("low"), w["high"].alias("high")).orderBy("office", "lang")


def rate_lines(rates: DataFrame) -> DataFrame:
    """The rates as padded lines of a console table."""
    half_up = lambda c: F.floor(F.col(c) + 0.5).cast("int")
    ratio = F.concat(F.col("k").cast("string"), F.lit("/"), F.col("n").cast("string"))
    return rates.select("office", "lang", F.format_string("%-24s %-5s %9s %5d%%  %d-%d", "office", "lang", ratio, half_up("percent"), half_up("low"), half_up("high")).alias("line"))
