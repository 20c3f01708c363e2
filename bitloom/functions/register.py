"""Names for SQL: native bodies as SQL functions, Arrow functions as registered ones."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..languages import SCRIPT, digit_tables
from .score import chrf
from .split import sentences
from .text import EMAIL, PHONE


def register(spark: SparkSession) -> list[str]:
    """Make redact, ascii_digits, in_script, sentences and chrf callable in this session's SQL; returns their names."""
    quoted = lambda s: "r'" + s + "'"
    by_script = {}
    for lang, script in SCRIPT.items():
        by_script.setdefault(script, []).append(lang)
    cases = " ".join(
        f"WHEN lang IN ({', '.join(map(repr, langs))}) THEN 2 * regexp_count(t, {quoted(rf'[\p{{L}}&&[{script}]]')}) > regexp_count(t, {quoted(r'\p{L}')})" for script, langs in by_script.items()
    )
    bodies = {
        "redact(t STRING) RETURNS STRING": f"regexp_replace(regexp_replace(t, {quoted(EMAIL)}, '<email>'), {quoted(PHONE)}, '<phone>')",
        "ascii_digits(t STRING) RETURNS STRING": "translate(t, '{}', '{}')".format(*digit_tables()),
        "in_script(lang STRING, t STRING) RETURNS BOOLEAN": f"CASE {cases} END",
    }
    for head, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    spark.udf.register("sentences", sentences)
    spark.udf.register("chrf", chrf)
    return [*(head.partition("(")[0] for head in bodies), "sentences", "chrf"]
