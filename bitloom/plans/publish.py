"""From pages to published tables: each stage written and read again, the audit before all that leaves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.align import sentence_pairs
from ..operators.package import documents, fold
from ..operators.report import audit
from ..operators.sample import eligible, round_robin, score_copies
from ..operators.vectors import Encoder, encode, missing, translated
from ..sources.files import write_published


def publish(
    spark: SparkSession, groups: DataFrame, store: DataFrame, model: str, encoder: Encoder, cache: DataFrame, out: str, sample: int = 100, budget: int = 300_000
) -> dict[str, DataFrame]:
    """Align, sample, package and audit release groups; write sentences, documents and copies under ``out`` and return them.

    Every stage writes under ``out/draft``; nothing stands under its final name
    unless the audit passes.  Vectors that the store lacked are appended to
    ``out/vectors`` as they are made, so a later run that adds them to its store
    encodes no text again.
    """

    def stage(df: DataFrame, name: str) -> DataFrame:
        path = f"{out}/{name}"
        write_published(df, path)
        return spark.read.schema(df.schema).parquet(path)

    def draft(df: DataFrame, name: str) -> DataFrame:
        return stage(df, f"draft/{name}")

    def known(texts: DataFrame) -> DataFrame:
        need = draft(texts.select("text").distinct(), "texts")
        held = store.where(F.col("model") == model).join(need, "text", "left_semi").dropDuplicates(["k"]).select("k", "model", "text", "v")
        new = draft(encode(missing(need, held, model), model, encoder), "vectors")
        new.write.mode("append").option("compression", "zstd").parquet(f"{out}/vectors")
        return held.unionByName(new)

    pairs = sentence_pairs(groups, known, model, keep=draft)
    pairs = draft(pairs.withColumn("seq", F.struct("ord", "at", "n")), "pairs").withColumn("ord", F.col("seq"))
    chosen = round_robin(pairs.where(eligible()), ["office", "lang"], "prid", ["ord"], sample)
    jobs = chosen.select("prid", "office", "lang", "en", F.col("text").alias("own"), "ord", F.lit("en").alias("from"), F.col("lang").alias("to")).withColumn("text", F.col("en"))
    scored = translated(jobs, cache, budget=budget).drop("text", "from", "to").withColumnRenamed("own", "text")
    tables = {"copies": draft(score_copies(scored, ["ord"]), "copies")}
    tables["sentences"] = draft(fold(pairs, tables["copies"]).orderBy("seen").drop("seen"), "sentences")
    tables["documents"] = draft(documents(groups), "documents")
    read = {"copies": ["en", "text"], "sentences": ["en", "text"], "documents": ["en_title", "en_body", "title", "body"]}
    audit({name: (tables[name], columns) for name, columns in read.items()})
    return {name: stage(df, name) for name, df in tables.items()}
