"""Quality rules: plain counts, and a hashed n-gram log-likelihood ratio.

Every document's byte 3-grams are hashed into ``buckets``.  Two multinomials are
counted over the corpus: one of all documents (raw) and one of the documents that
labels trust (target).  A document's score is the mean over its n-grams of
log p_target - log p_raw; it is kept where the score reaches one threshold, the
same for all documents, which separates the labelled documents best.  For that
fit every labelled document is scored by counts without its own n-grams, as a
document that no label knows would be.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bytescan
from .bytescan import NONSPACE, Texts, U, mix, scan
from .spill import materialise, scratch, tune

NGRAM = 3
ONE = 1 << 30  # ratios are summed as whole numbers of 1/ONE, so a score depends on its document alone
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LEADING = (np.arange(256) & 0xC0) != 0x80
BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _grams(texts: Texts, buckets: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first byte, byte after the last, buckets) of one stretch after another: the bucket at each byte where an n-gram of one text begins, else ``buckets``."""
    tail = [texts.at[1:] - k for k in range(1, NGRAM)]
    tail = np.unique(np.concatenate([x[x >= texts.at[:-1]] for x in tail]))
    for a in range(0, len(texts.data), bytescan.STEP):
        b = min(a + bytescan.STEP, len(texts.data))
        code = np.ones(b - a, U)
        for k in range(NGRAM):
            part = texts.data[a + k : b + k]
            code[: len(part)] += part.astype(U) << U(8 * (NGRAM - 1 - k))
        out = (mix(code) % U(buckets)).astype(np.int32)
        out[tail[np.searchsorted(tail, a) : np.searchsorted(tail, b)] - a] = buckets
        yield a, b, out


def _per_text(texts: Texts, a: int, b: int, values: np.ndarray) -> np.ndarray:
    """Sums of the values of bytes a to b by text."""
    sums = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    edge = np.clip(texts.at, a, b) - a
    return sums[edge[1:]] - sums[edge[:-1]]


def _scores(texts: Texts, ratio: np.ndarray, buckets: int) -> np.ndarray:
    """Each text's mean ratio; 0 for a text without an n-gram."""
    total = np.zeros(texts.n, np.int64)
    for a, b, grams in _grams(texts, buckets):
        total += _per_text(texts, a, b, ratio[grams])
    n = np.maximum(np.diff(texts.at) - (NGRAM - 1), 0)
    return np.where(n > 0, total / np.maximum(n, 1) / ONE, 0.0)


def _held_out(texts: Texts, some: np.ndarray, raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Mean ratios of some texts by counts that their own n-grams are taken from: a row as if none were trusted, a row as if all were."""
    buckets, out = len(raw), np.zeros((2, len(some)))
    all_raw, all_target = buckets + int(raw.sum()), buckets + int(target.sum())

    def of(own: np.ndarray, c: np.ndarray) -> list[float]:
        n = int(c.sum())
        if not n:
            return [0.0, 0.0]
        less = (c * np.log(1 + raw[own] - c)).sum() / n - np.log(all_raw - n)
        # where a text isn't trusted, its n-grams may be more than all trusted ones; nobody asks for that value
        return [(c * np.log(np.maximum(1 + target[own] - t * c, 1))).sum() / n - np.log(max(all_target - t * n, 1)) - less for t in (0, 1)]

    if len(texts.data) > bytescan.STEP:  # one long text
        if len(some):
            c = sum(np.bincount(grams, minlength=buckets + 1) for _, _, grams in _grams(texts, buckets))[:-1]
            own = np.flatnonzero(c)
            out[:, 0] = of(own, c[own])
        return out
    for _, _, grams in _grams(texts, buckets):
        for k, (i, j) in enumerate(zip(texts.at[some], texts.at[some + 1])):
            part = np.sort(grams[i:j])
            at = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(part) else np.zeros(1, np.int64)
            own, c = part[at[:-1]], np.diff(at)
            out[:, k] = of(own[own < buckets], c[own < buckets])
    return out


def _base(texts: Texts) -> list[np.ndarray]:
    start, stop = texts.spans(NONSPACE)
    at = np.searchsorted(start, texts.at)
    words = texts._hash(start, stop, False)
    n = np.diff(at)
    line, has_word, owner = texts.lines(start)
    del stop
    line, owner = line[has_word], owner[has_word]
    order = np.lexsort((line, owner))
    line, owner = line[order], owner[order]
    again = (line[1:] == line[:-1]) & (owner[1:] == owner[:-1])
    n_dup = np.bincount(owner[1:][again], minlength=texts.n) if len(owner) else np.zeros(texts.n, np.int64)
    # words in 3-word windows that the text has twice or more
    covered = np.zeros(len(words) + 2, bool)
    if len(words) >= 3:
        text = np.repeat(np.arange(texts.n, dtype=np.int32), n)
        window = words[:-2] * U(0xD6E8FEB86659FD93)
        window += words[1:-1]
        window *= U(0xD6E8FEB86659FD93)
        window += words[2:]
        window += mix(np.arange(1, texts.n + 1, dtype=U))[text[:-2]]
        whole = np.flatnonzero(text[2:] == text[:-2])
        window = mix(window[whole])
        order = np.argsort(window, kind="stable")
        window = window[order]
        same = window[1:] == window[:-1]
        twice = whole[order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]] if len(order) else order
        for k in range(3):
            covered[twice + k] = True
    sums = np.concatenate([[0], np.cumsum(covered[: len(words)])])
    leading = NONSPACE[texts.data]
    leading &= _LEADING[texts.data]
    return [n, texts.per_text(leading), texts.per_text(_SYMBOL[texts.data]), n_dup, sums[at[1:]] - sums[at[:-1]]]


def agreed(labels: DataFrame) -> DataFrame:
    """Labelled ids (doc_id, a: 1 if trusted else 0), once each; an id with both labels is left out."""
    rows = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("a"), F.max("quality").alias("b"))
    return rows.where("a = b").select("doc_id", "a")


def separating(scored: DataFrame, parts: int = 1) -> float:
    """Of scored (score double, trusted boolean): the middle of the widest interval of thresholds with the most trusted kept plus others rejected, each kind weighing the same.

    Exact at any size: scores lie in ``parts`` ranges, running counts are taken
    in each, and only the ranges' totals and the best interval go to the driver.
    """
    spark = scored.sparkSession
    with scratch(spark):
        kinds = scored.groupBy("score").agg(F.count_if("trusted").alias("t"), F.count_if(~F.col("trusted")).alias("o"))
        # a range's number is written down: ranges are drawn anew whenever they are computed
        ranges = materialise(kinds.repartitionByRange(parts, "score").withColumn("part", F.spark_partition_id()), "scores")
        totals = ranges.groupBy("part").agg(F.min("score").alias("first"), F.sum("t").alias("t"), F.sum("o").alias("o")).orderBy("part").collect()
        n_trusted, n_other = sum(r.t for r in totals), sum(r.o for r in totals)
        if not n_trusted:
            return -np.inf
        if not n_other:
            return totals[0].first
        before = zip(accumulate((r.t for r in totals), initial=0), accumulate((r.o for r in totals), initial=0))
        after = [*(r.first for r in totals[1:]), None]
        known = spark.createDataFrame([(r.part, *n, x) for r, n, x in zip(totals, before, after)], "part int, before_t long, before_o long, after double")
        order = Window.partitionBy("part").orderBy("score")
        below = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        edges = ranges.join(F.broadcast(known), "part").select(
            "score",
            F.coalesce(F.lead("score").over(order), "after").alias("next"),
            (F.col("before_t") + F.sum("t").over(below)).cast("decimal(38,0)").alias("t"),
            (F.col("before_o") + F.sum("o").over(below)).cast("decimal(38,0)").alias("o"),
        )
        gain = F.col("o") * n_trusted - F.col("t") * n_other
        one = F.struct(gain.alias("gain"), (F.col("next") - F.col("score")).alias("width"), (-F.col("score")).alias("low"), "next")
        best = edges.where("next IS NOT NULL").agg(F.max(one).alias("best")).first().best
        return totals[0].first if best is None or best.gain < 0 else (best.next - best.low) / 2


def quality_rules(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = 1 << 16, max_labels: int | None = None, few: int = 1_000_000, texts: bool = True
) -> DataFrame:
    r"""docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score and kept.

    Words are ``[^\x20\x09-\x0D]+``; a null or empty text has none and fails.
    base_failed: fewer than 50 words, or more than half of them in 3-word
    windows found twice or more.  kept: not base_failed, and score at or above
    the threshold; without a trusted label there is no ratio, scores are 0 and
    the base rule alone decides.  Repeated rows and null ids are judged like any
    other; columns of docs pass through, except that added columns replace
    columns of their names; without ``texts`` the texts themselves don't.

    Raw counts cover all documents and target counts all trusted ones, found by
    a join on the id: up to ``few`` trusted ids (some 40 MB) are broadcast, more
    are joined by a shuffle.  The threshold is fitted on all labelled documents,
    or, only where a caller sets ``max_labels``, on that many by a hash of their
    ids.  Up to ``few`` labelled ids are broadcast to pick their texts; with more,
    every text is scored and the scores, not the texts, are shuffled to the
    labels.  To the driver go ``buckets`` counts and a few numbers for each
    million labels; to tasks the counts.  A Python worker holds a stretch of
    texts at a time, or one text that is longer.
    """
    spark = docs.sparkSession
    tune(spark)
    known = agreed(labels).select(F.col("doc_id").cast("long").alias("id"), (F.col("a") == 1).alias("trusted"))
    if max_labels is not None:
        known = known.orderBy(F.xxhash64("id"), "id").limit(max_labels)
    # Ids that are null never join; by the second key they spread over all tasks.
    trusted_ids = agreed(labels).where("a = 1").select(F.col("doc_id").cast("long").alias("id"), F.lit(0).cast("long").alias("spread"), F.lit(True).alias("trusted"))
    n_trusted = trusted_ids.count()
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets + 1, np.int64), np.zeros(buckets + 1, np.int64)
        for batch in batches:
            flags = batch.column(0).fill_null(False).to_numpy(zero_copy_only=False)
            for i, j, part in scan(batch.column(1)):
                for a, b, grams in _grams(part, buckets):
                    raw += np.bincount(grams, minlength=buckets + 1)
                    edge = np.clip(part.at, a, b)
                    target += np.bincount(grams[np.repeat(flags[i:j], np.diff(edge))], minlength=buckets + 1)
        some = np.flatnonzero(raw[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (some, raw[some], target[some])], names=["bucket", "raw", "target"])

    raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    ratio = np.zeros(buckets + 1, np.int64)
    if n_trusted:
        spread = F.when(F.col("id").isNull(), F.xxhash64("text")).otherwise(0)
        how = "broadcast" if n_trusted <= few else "shuffle_hash"
        flagged = source.withColumn("spread", spread).join(trusted_ids.hint(how), ["id", "spread"], "left").select("trusted", "text")
        sums = flagged.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()
        at, own_raw, own_target = np.array([tuple(r) for r in sums], np.int64).reshape(-1, 3).T
        raw[at], target[at] = own_raw, own_target
        exact = np.log((1 + target) / (buckets + target.sum())) - np.log((1 + raw) / (buckets + raw.sum()))
        ratio[:-1] = np.rint(exact * ONE)

    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score"]
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, part in scan(batch.column(1)):
                about = [pa.array(x.astype(np.int64)) for x in _base(part)]
                passed = [batch.column(k).slice(i, j - i) for k in range(1 + texts)]
                yield pa.RecordBatch.from_arrays([*passed, *about, pa.array(np.round(_scores(part, ratio, buckets), 9))], names=["row", "text", *names] if texts else ["row", *names])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, part in scan(batch.column(1)):
                n, _, _, _, repeated = _base(part)
                good = np.flatnonzero(~((n < 50) | (100 * repeated > 50 * n)))
                ids = batch.column(0).slice(i, j - i).take(pa.array(good))
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, _held_out(part, good, raw, target))], names=["id", "as_other", "as_trusted"])

    threshold = -np.inf
    if n_trusted:
        n_known = known.count()
        picked = source.join(F.broadcast(known.select("id")), "id", "left_semi") if n_known <= few else source.where("id IS NOT NULL")
        both = picked.select("id", "text").mapInArrow(fit, "id long, as_other double, as_trusted double").join(known, "id")
        score = F.when(F.col("trusted"), F.col("as_trusted")).otherwise(F.col("as_other"))
        threshold = separating(both.groupBy("id", "trusted").agg(F.min(score).alias("score")), 1 + n_known // 1_000_000)

    others = [c for c in docs.columns if c not in (text_col, *names, "base_failed", "kept")]
    row = docs.select(F.struct(*others).alias("row") if others else F.struct(F.lit(0).alias("none")).alias("row"), F.col(text_col).alias("text"))
    kind = row.schema["row"].dataType.simpleString()
    out = row.mapInArrow(judge, f"row {kind}, {'text string, ' * texts}{BASE}, score double")
    passed = [F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns if c in others or (texts and c == text_col)]
    return out.select(*passed, *names[:-1], failed.alias("base_failed"), "score").withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(float(threshold))))
