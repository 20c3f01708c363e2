"""Packing: length buckets that minimise padding, and token-budget batches inside them.

A global histogram of lengths is all that reaches the driver, and its size is
bounded: lengths up to ``exact`` have a bin each, longer ones share bins a
fraction of their length wide.  Dynamic programming over the bins finds the
bucket bounds that minimise the padding of all documents together.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .spill import row_key

EXACT, FINE = 4096, 64


def bin_top(length: Column) -> Column:
    """The greatest length of the bin: itself up to EXACT, beyond it rounded up to one of FINE steps an octave."""
    step = F.pow(F.lit(2.0), F.floor(F.log2(length.cast("double")))) / FINE
    return F.when(length <= EXACT, length).otherwise((F.ceil(length / step) * step).cast("long"))


def best_bounds(tops: np.ndarray, counts: np.ndarray, k: int) -> list[int]:
    """At most k bounds, the greatest top last, that minimise the sum of count * (bound - top).

    The cost of a bucket is such that best splits never move left, so each layer
    is found by divide and conquer: k * n log n in all.
    """
    n = len(tops)
    if not n:
        return []
    order = np.argsort(tops)
    tops, counts = tops[order].astype(np.float64), counts[order].astype(np.float64)
    c = np.concatenate([[0.0], np.cumsum(counts)])
    best = np.full(n + 1, np.inf)
    best[0] = 0.0
    split = []
    for _ in range(min(k, n)):
        layer, at = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        work = [(1, n, 0, n - 1)]
        while work:
            lo, hi, a, b = work.pop()
            if lo > hi:
                continue
            mid = (lo + hi) // 2
            j = np.arange(a, min(mid - 1, b) + 1)
            # padding of bins j..mid-1 under the bound tops[mid-1], less what does not depend on the split
            cost = best[j] + tops[mid - 1] * (c[mid] - c[j])
            m = int(np.argmin(cost))
            layer[mid], at[mid] = cost[m], j[m]
            work += [(lo, mid - 1, a, int(j[m])), (mid + 1, hi, int(j[m]), b)]
        split.append(at)
        best = layer
    bounds, i = [], n
    for at in reversed(split):
        if i <= 0:
            break
        bounds.append(int(tops[i - 1]))
        i = int(at[i])
    return bounds[::-1]


def pack(docs: DataFrame, length: Column, id_col: str = "doc_id", buckets: int = 16, budget: int = 32_768, cell: int = 10_000) -> DataFrame:
    """docs with n_tokens, bucket (from 0), bucket_len, batch and slot.

    Each document lies in the bucket with the least bound that holds its length
    (at least 1, so empty and null texts take one place); bounds come from the
    dynamic program, at most ``buckets``.  Batches of a bucket are numbered from
    0 and hold floor(budget / bucket_len) documents each, but the last, and one
    at least: a document longer than the budget is a batch of its own, whole.
    Within a bucket, documents are dealt by a hash of the id, then in order of
    it; equal rows are interchangeable.  No documents give no rows.  Columns
    pass through; added columns replace columns of their names.

    Every bound is the length of a document: the greatest of its bin, so bounds
    beyond 4096 are the best of those that part bins and not lengths of one bin,
    1/64 of an octave wide.  Numbering
    needs no task that sees a whole bucket: rows are numbered in cells of about
    ``cell`` rows, and cells are put in order by the sums of their counts.
    """
    added = ["n_tokens", "bucket", "bucket_len", "batch", "slot"]
    rest = [c for c in docs.columns if c not in added]
    # All columns travel as one, whatever their names.
    sized = docs.select(F.struct(*rest).alias("row"), F.greatest(F.coalesce(length.cast("long"), F.lit(0)), F.lit(1)).alias("n_tokens"))
    histogram = np.array([tuple(r) for r in sized.groupBy(bin_top(F.col("n_tokens")).alias("bin")).agg(F.max("n_tokens").alias("top"), F.count("*")).select("top", "count(1)").collect()], np.int64).reshape(-1, 2)
    bounds = best_bounds(histogram[:, 0], histogram[:, 1], buckets)
    edges = F.array(*map(F.lit, bounds or [1])).cast("array<long>")
    k1, k2 = row_key("row")
    cells = max(1, -(-int(histogram[:, 1].sum()) // cell))
    bucket_of = lambda n: F.size(F.filter(edges, lambda b: b < n))
    # Bound by transform(), the length is computed once a row and not once a bound.
    placed = sized.select("row", "n_tokens", F.transform(F.array("n_tokens"), bucket_of)[0].alias("bucket"), k1, k2)
    placed = placed.withColumn("cell", F.pmod(F.col("_k1"), F.lit(cells)).cast("int"))
    counts = placed.groupBy("bucket", "cell").count()
    before = counts.select("bucket", "cell", (F.sum("count").over(W.partitionBy("bucket").orderBy("cell")) - F.col("count")).alias("before"))
    rank = F.row_number().over(W.partitionBy("bucket", "cell").orderBy("_k1", "_k2"))
    numbered = placed.withColumn("rank", rank).join(before, ["bucket", "cell"])
    numbered = numbered.select("row", "n_tokens", "bucket", F.element_at(edges, F.col("bucket") + 1).alias("bucket_len"), (F.col("before") + F.col("rank") - 1).alias("place"))
    holds = F.greatest(F.floor(F.lit(budget) / F.col("bucket_len")), F.lit(1))
    return numbered.select(
        *(F.col("row")[c].alias(c) for c in rest), "n_tokens", "bucket", "bucket_len", F.floor(F.col("place") / holds).cast("long").alias("batch"), (F.col("place") % holds).cast("long").alias("slot")
    )


def word_count(text: str = "text") -> Column:
    r"""How many words ``[^\x20\x09-\x0D]+`` a text has; a null one has none."""
    trimmed = F.trim(F.col(text), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(F.coalesce(trimmed, F.lit("")) == "", 0).otherwise(F.size(F.split(trimmed, r"[\x20\x09-\x0D]+")))
