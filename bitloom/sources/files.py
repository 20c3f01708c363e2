"""Reading and writing what the stages exchange."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.html import html_text
from ..schemas import GROUP, OFFICES, PASSES, RELEASE


def json_lines(spark: SparkSession, path: str, schema: StructType, **options: str) -> DataFrame:
    """Rows of JSON lines with ``path`` and ``ord``; blank lines are skipped.

    ord orders the rows as files by path and lines in a file: (path, line).
    Files are read whole, so that a line knows its number; a stage's file is one
    office's month.
    """
    files = spark.read.options(**options).text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    lines = files.select("path", F.posexplode(F.split("value", "\n", -1)).alias("line", "text")).where(~F.col("text").rlike(r"\A\s*\z"))
    return lines.select(F.from_json("text", schema).alias("r"), "path", F.struct("path", "line").alias("ord")).select("r.*", "path", "ord")


def release_groups(spark: SparkSession, root: str) -> DataFrame:
    """Release groups of every pairs.jsonl under root, at any depth, but in bench and release folders; office is the folder's name."""
    groups = json_lines(spark, root, GROUP, recursiveFileLookup="true", pathGlobFilter="pairs.jsonl")
    parts = F.split("path", "/")
    return groups.withColumn("office", F.element_at(parts, -2)).where(~F.arrays_overlap(F.slice(parts, 1, F.size(parts) - 1), F.array(F.lit("bench"), F.lit("release"))))


def pages(spark: SparkSession, path: str) -> DataFrame:
    """Cached pages (prid, html), a file each, named by its release."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("name"), F.col("value").alias("html"))
    return files.select(F.regexp_replace("name", r"\.html?$", "").alias("prid"), "html")


def saved_list(spark: SparkSession, path: str) -> DataFrame:
    """Release ids of an earlier run's list, in its order."""
    return json_lines(spark, path, RELEASE).select("prid", "ord")


def feed_items(xml: DataFrame, limit: int = 20) -> DataFrame:
    """Items (at, title, prid) of feeds (value: the xml), the first ``limit`` of each."""
    form = F.lit(r"<item>[\s\S]*?<title>([\s\S]*?)</title>[\s\S]*?PRID=([0-9]+)")
    items = F.arrays_zip(F.regexp_extract_all("value", form, F.lit(1)).alias("title"), F.regexp_extract_all("value", form, F.lit(2)).alias("prid"))
    return xml.select(F.posexplode(F.slice(items, 1, limit)).alias("at", "item")).select("at", html_text(F.col("item.title")).alias("title"), F.col("item.prid").alias("prid"))


def list_ids(lists: DataFrame) -> DataFrame:
    """Distinct release ids (at, prid) of list pages (value: the html), each where it first stands; other columns pass through."""
    found = F.array_distinct(F.regexp_extract_all("value", F.lit(r"PressReleaseDetail\.aspx\?PRID=([0-9]+)"), F.lit(1)))
    return lists.select(*(c for c in lists.columns if c != "value"), F.posexplode(found).alias("at", "prid"))


def release_url(prid: Column, site: str) -> Column:
    """Where a release's own page is; region and language spelled out."""
    return F.concat(F.lit(f"{site}/PressReleaseIframePage.aspx?PRID="), prid, F.lit("&reg=3&lang=1"))


def passes(spark: SparkSession, path: str) -> DataFrame:
    """Crawl passes (name, reg, lang, columns); lines that begin with # are comments."""
    return spark.read.csv(path, sep="\t", comment="#", schema=PASSES).select("name", "reg", "lang", F.split("cols", ",").alias("columns"))


def offices(spark: SparkSession, path: str) -> DataFrame:
    """Offices (reg, office, langs: map of feed number to label)."""
    table = spark.read.csv(path, sep="\t", schema=OFFICES)
    return table.select("reg", "office", F.transform_keys(F.str_to_map("langs", F.lit("; "), F.lit("=")), lambda k, _: k.cast("int")).alias("langs"))


def write_json_lines(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """JSON lines, in order within a file if asked; nulls are left out and non-ASCII stays as it is."""
    (df.sortWithinPartitions(*order) if order else df).write.mode("overwrite").json(path)


def write_published(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Zstandard Parquet; an empty table still has its columns. ``by``: a folder for each split."""
    writer = df.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(*by) if by else writer).parquet(path)
