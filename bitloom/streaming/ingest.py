"""Incremental ingest of pages: releases as they arrive, each once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.html import parse_releases
from ..schemas import PAGE


def page_stream(spark: SparkSession, path: str) -> DataFrame:
    """New Parquet files of (prid, html) under path."""
    return spark.readStream.schema(PAGE).parquet(path)


def ingest(pages: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Parse each page id once and append the releases; run with what is there and stop.

    State is one id a page; a restarted query goes on from its checkpoint.
    """
    releases = parse_releases(pages.dropDuplicates(["prid"]))
    return releases.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
