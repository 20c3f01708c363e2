"""Encoders and the store of their vectors: each text is encoded once, ever."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import text_key

Encoder = Callable[[list[str]], np.ndarray]


def hashed_encoder(dim: int = 64, order: int = 3) -> Encoder:
    """A deterministic stand-in for a sentence encoder: hashed character n-grams, unit length. Its similarities say nothing of translation quality."""

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim), np.float32)
        for row, text in zip(out, texts):
            padded = f" {text.lower()} "
            for k in range(max(1, len(padded) - order + 1)):
                h = int.from_bytes(hashlib.blake2b(padded[k : k + order].encode(), digest_size=4).digest(), "little")
                row[h % dim] += 1 if h >> 31 else -1
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norm == 0, 1, norm)

    return encode


def missing(texts: DataFrame, store: DataFrame, model: str) -> DataFrame:
    """Distinct texts (text) that the store has no vector of under the model, with their key."""
    keyed = texts.select("text").distinct().select("text", text_key(F.lit(model), F.col("text")).alias("k"))
    return keyed.join(store.select("k"), "k", "left_anti")


def encode(texts: DataFrame, model: str, encoder: Encoder, batch: int = 256) -> DataFrame:
    """Rows (k, model, text, v) of texts (k, text), encoded in batches on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            keys, values = rows.column(0).to_pylist(), rows.column(1).to_pylist()
            for i in range(0, len(keys), batch):
                part = values[i : i + batch]
                vectors = np.asarray(encoder(part), np.float32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[i : i + batch]), pa.array([model] * len(part)), pa.array(part), pa.array(list(vectors), pa.list_(pa.float32()))], names=["k", "model", "text", "v"]
                )

    return texts.select("k", "text").mapInArrow(run, "k string, model string, text string, v array<float>")


def with_vectors(texts: DataFrame, store: DataFrame, model: str, encoder: Encoder) -> DataFrame:
    """The store's rows for these texts, and new rows for those it lacks. Append the rows of ``missing`` to keep them."""
    need = texts.select("text").distinct()
    held = store.where(F.col("model") == model).join(need, "text", "left_semi").dropDuplicates(["k"])
    return held.select("k", "model", "text", "v").unionByName(encode(missing(need, held, model), model, encoder))


def put(store: DataFrame, new: DataFrame) -> DataFrame:
    """The store with new rows; of equal keys the new row wins."""
    return store.join(new.select("k"), "k", "left_anti").unionByName(new.dropDuplicates(["k"]))


def dot(a: Column, b: Column) -> Column:
    """Dot product of two arrays, summed in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


# ------------------------------------------------------------- translations


def uncached_cost(jobs: DataFrame, cache: DataFrame) -> DataFrame:
    """One row: the characters (UTF-16 units) of distinct jobs (from, to, text) that the cache lacks; a cache without from or to holds for all of them."""
    keys = [c for c in ("from", "to", "text") if c in cache.columns]
    todo = jobs.select("from", "to", "text").distinct().join(cache.select(keys), keys, "left_anti")
    units = F.octet_length(F.encode("text", "UTF-16BE")) / 2
    return todo.agg(F.coalesce(F.sum(units.cast("long")), F.lit(0)).cast("long").alias("cost"))


def translated(jobs: DataFrame, cache: DataFrame, source: DataFrame | None = None, budget: int = 300_000) -> DataFrame:
    """jobs with ``translated``, from the cache or the source table; raises before any work if more than the budget is new, or a job has no translation."""
    cost = uncached_cost(jobs, cache).first()["cost"]
    if cost > budget:
        raise ValueError(f"{cost} new characters exceeds the budget of {budget}; raise it to go on")
    known = cache if source is None else cache.unionByName(source.join(cache, ["from", "to", "text"], "left_anti"))
    known = known.select("from", "to", "text", "translated").dropDuplicates(["from", "to", "text"])
    out = jobs.join(known, ["from", "to", "text"], "left")
    absent = F.raise_error(F.concat(F.lit("not translated: "), F.substring("text", 1, 40)))
    return out.withColumn("translated", F.coalesce("translated", absent.cast("string")))
