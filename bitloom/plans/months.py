"""The plan of office-months, and what of it is still to do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values: (language, office, first month, last month, months of each year or None for all)
RANGES = [
    ("ne", "gangtok-ne", "2023-01", "2026-09", None), ("kha", "shillong-kha", "2023-01", "2026-09", None), ("gom", "mumbai-gom", "2023-11", "2024-11", [11]),
    ("mni", "imphal-mni", "2019-01", "2026-09", None),
]
NOT_BY_DEFAULT = ("mni",)


def plan(spark: SparkSession, ranges=tuple(RANGES)) -> DataFrame:
    """Every (lang, office, month) of the ranges."""
    table = spark.createDataFrame(list(ranges), "lang string, office string, first string, last string, only array<int>")
    day = lambda c: F.to_date(F.concat(F.col(c), F.lit("-01")))
    months = table.select("lang", "office", "only", F.explode(F.sequence(day("first"), day("last"), F.expr("interval 1 month"))).alias("d"))
    return months.where(F.col("only").isNull() | F.array_contains("only", F.month("d"))).select("lang", "office", F.date_format("d", "yyyy-MM").alias("month"))


def plan_for(planned: DataFrame, lang: str = "", first: str = "", last: str = "") -> DataFrame:
    """One language's months within bounds; without a language all but those that are not fetched by default. A language without bounds selects nothing."""
    if not lang:
        return planned.where(~F.col("lang").isin(*NOT_BY_DEFAULT))
    return planned.where((F.col("lang") == lang) & (F.col("month") >= first) & (F.col("month") <= last))


def to_do(planned: DataFrame, published: DataFrame) -> DataFrame:
    """The plan without months that are published already."""
    return planned.join(published.select("month").distinct(), "month", "left_anti").select("lang", "office", "month")


def office_months(planned: DataFrame) -> DataFrame:
    return planned.groupBy("lang").agg(F.count("*").alias("office_months"))
