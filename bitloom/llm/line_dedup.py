"""Line dedup: drop lines that many documents share.

Lines are exploded as 128-bit hashes of their normalised keys, counted over
distinct documents, and only the positions of lines to drop travel back to the
texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spill import materialise, row_key

SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased and nothing else; plain lower() where the text is all ASCII, which is faster."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_key: int = 1, min_docs: int = 10) -> DataFrame:
    r"""docs with their repeated lines dropped: all columns, plus n_lines, n_dropped and kept_text.

    A line's key is the line stripped of ``[\x20\x09-\x0D]`` with A-Z lower-cased.
    Keys of at least ``min_key`` characters in at least ``min_docs`` documents lose
    all their lines.  A null or empty text is one empty line.  Rows with equal ids
    are one document for the count; a null id counts once for each different text.
    Repeated rows stay; columns of other names, clashing or not, pass through
    (added columns replace columns that are already called so).

    Shuffles: (hash, document) pairs for the exact distinct count, which Spark
    pre-aggregates on both levels so that a hot line is no hot task; hashes with
    positions against the hashes that are too frequent; the texts once, against
    their own drop positions.
    """
    key = ascii_lower(F.trim(F.col("line"), F.lit(SPACE)))
    k1, k2 = row_key("id", "text")
    added = ["n_lines", "n_dropped", "kept_text"]
    others = [c for c in docs.columns if c not in (text_col, *added)]
    rest = F.struct(*others) if others else F.lit(0)  # one column, whatever names are in it
    rows = docs.select(rest.alias("rest"), F.col(id_col).alias("id"), F.col(text_col).alias("text")).select("rest", "id", "text", k1, k2)
    doc = F.when(F.col("id").isNotNull(), F.xxhash64("id")).otherwise(F.col("_k1"))
    lines = (
        rows.select("_k1", "_k2", doc.alias("doc"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "line"))
        .select("_k1", "_k2", "doc", "pos", key.alias("key"))
        .where(F.char_length("key") >= min_key)
        .select("_k1", "_k2", "doc", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))
    )
    frequent = lines.groupBy("h1", "h2").agg(F.count_distinct("doc").alias("n")).where(F.col("n") >= min_docs).select("h1", "h2")
    frequent = materialise(frequent, "frequent-lines")  # a plain join side: Spark can split a hot line's partition, or broadcast a small table
    drops = lines.join(frequent, ["h1", "h2"], "left_semi").groupBy("_k1", "_k2").agg(F.array_sort(F.collect_set("pos")).alias("_drop"))
    # Between one dropped position and the next lies a slice that stays: linear, however many are dropped.
    kept = F.flatten(
        F.zip_with(
            F.concat(F.array(F.lit(-1)), F.col("_drop")),
            F.concat(F.col("_drop"), F.array(F.size("lines"))),
            lambda a, b: F.slice(F.col("lines"), a + 2, b - a - 1),
        )
    )
    text = F.coalesce("text", F.lit(""))
    cut = rows.join(drops, ["_k1", "_k2"], "left").select("rest", "text", "_drop", F.split(text, "\n", -1).alias("lines"))
    own = {text_col: F.col("text")} | {c: F.col("rest")[c] for c in others}
    done = cut.select(
        "rest", "text", F.size("lines").cast("long").alias("n_lines"), F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("_drop").isNull(), text).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
    )
    return done.select(*(own[c].alias(c) for c in docs.columns if c in own), *added)
