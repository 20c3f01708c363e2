"""A corpus from raw documents: STAGES in order, each written and read again before the next."""

from __future__ import annotations

from bitloom.llm.decontaminate import decontaminate
from bitloom.llm.line_dedup import line_dedup
from bitloom.llm.ngram_join import jaccard_join
from bitloom.llm.packing import pack
from bitloom.llm.quality_rules import quality_rules
from bitloom.llm.spill import delete, fresh_path, materialise, scratch
from bitloom.llm.token_counts import with_token_counts
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules(docs, labels).where("kept").select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten or more of them share; a text may end empty."""
    kept = line_dedup(docs)
    own = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return kept.select(*(own.get(c, F.col(c)).alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate class the document with the smallest id; rows without an id are not compared and stay."""
    first = jaccard_join(docs).where("doc_id = class_id").select("doc_id").distinct()
    return docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).union(docs.where("doc_id IS NULL")).select(docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no test item."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each with its tokens, bucket, batch and slot; texts are encoded once."""
    import public_tokenizers

    counted = materialise(with_token_counts(docs, public_tokenizers.path("byte_bpe_50k.json")), "token-counts")
    return pack(counted, F.col("n_tokens"))


STAGES = [("quality rules", quality), ("line dedup", lines), ("n-gram Jaccard join", near_duplicates), ("benchmark decontamination", benchmark), ("packing", packing)]
# The fitted ratio of the first stage and MinHash are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; what a stage wrote on its way goes when its result is written, and that when the next one's is."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, name.replace(" ", "-"))
        with scratch(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.option("compression", "zstd").parquet(path)
        if before:
            delete(spark, before)
        docs, before = spark.read.schema(kept.schema).parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
