"""N-gram Jaccard join: MinHash banding proposes, full n-gram sets decide.

Plan, with what is shuffled:

1. One pass over the texts gives each document a 128-bit hash of its word
   sequence and its band hashes (a few hundred bytes, whatever the text).
2. Documents with equal word sequences are one class; only its representative
   goes on, so copies are never expanded into pairs.
3. Band buckets of two or more become star edges to the bucket's smallest
   member: linear, however large a bucket is.  Their connected components are
   candidate groups.
4. Only texts of candidate groups are read again as shingle sets.  A group is
   verified in one piece if its sets fit the budget; a larger one is dealt into
   blocks by size class and hash, and every two blocks that can hold a pair meet
   in one task.  A task counts each document's verified partners and emits a
   spanning forest of the links, never the pairs.
5. Components over the verified forest are the near-duplicate classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytescan import U, mix, ragged, scan, shingles
from .components import connected_components
from .spill import materialise, tune


def bands_for(threshold: float, recall: float, rows: int) -> int:
    """The least number of bands of ``rows`` rows that finds a pair at the threshold with that probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


def _band_hashes(sh: np.ndarray, at: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """bands x texts; texts without shingles get whatever, and are left out by the caller."""
    n = len(at) - 1
    out = np.zeros((bands, n), U)
    full = np.flatnonzero(np.diff(at))
    if not len(full):
        return out
    starts = at[:-1][full]
    seeds = mix(np.arange(1, 2 * bands * rows + 1, dtype=U) * U(0xC2B2AE3D27D4EB4F)) | U(1)
    for b in range(bands):
        h = np.full(len(full), b + 1, U)
        for r in range(rows):
            k = 2 * (b * rows + r)
            low = np.minimum.reduceat(sh * seeds[k] + seeds[k + 1], starts)
            h = mix(h * U(0x9FB21C651E98DF25) + low)
        out[b, full] = h
    return out


def signatures(docs: DataFrame, id_col: str, text_col: str, size: int, bands: int, rows: int) -> DataFrame:
    """id, k1, k2 (hash of the word sequence), n (distinct shingles) and band hashes of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, texts in scan(batch.column(1)):
                words, at = texts.words()
                place = (np.arange(len(words)) - np.repeat(at[:-1], np.diff(at))).astype(U)
                keys = []
                for seed in (0x8CB92BA72F3D8DD7, 0xDB4F0B9175AE2165):
                    sums = np.concatenate([np.zeros(1, U), np.cumsum(mix(words ^ (place + U(1)) * U(seed)))])
                    keys.append(mix(sums[at[1:]] - sums[at[:-1]]).view(np.int64))
                sh, sh_at = shingles(words, at, size)
                found = _band_hashes(sh, sh_at, bands, rows)
                n = np.diff(at)
                sets = np.array([len(np.unique(sh[a:b])) for a, b in zip(sh_at[:-1], sh_at[1:])], np.int64)
                per = np.where(n > 0, bands, 0)
                flat = found.T[n > 0].reshape(-1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), *map(pa.array, keys), pa.array(sets), ragged(flat.view(np.int64), np.concatenate([[0], np.cumsum(per)]), pa.int64())],
                    names=["id", "k1", "k2", "n", "bands"],
                )

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, k1 long, k2 long, n long, bands array<long>")


def _verify(ids: list[int], sets: list[np.ndarray], side: np.ndarray | None, threshold: float) -> Iterator[tuple[int, int, int]]:
    """(id, links, root) of every member of one group or pair of blocks.

    ``side`` is None where all pairs count, or tells block 0 from block 1 where
    only pairs across them do.  Common shingles are counted shingle by shingle
    where few sets hold one, else as products of 0/1 matrices.
    """
    n = len(ids)
    size = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(n), size)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    start = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    holders = np.diff(np.append(start, len(flat)))
    common = np.zeros((n, n), np.float32)
    for m in np.unique(holders):
        if m < 2:
            continue
        at = start[holders == m]
        if m * 10 < n:
            for k in range(0, len(at), step := max(1, (1 << 20) // int(m * m))):
                who = owner[at[k : k + step, None] + np.arange(m)]
                common += np.bincount((who[:, :, None] * n + who[:, None, :]).ravel(), minlength=n * n).reshape(n, n)
        else:
            for k in range(0, len(at), 1024):
                who = owner[at[k : k + 1024, None] + np.arange(m)]
                cells = np.zeros((n, len(who)), np.float32)
                cells[who, np.arange(len(who))[:, None]] = 1
                common += cells @ cells.T
    ok = np.empty((n, n), bool)
    for k in range(0, n, 256):  # counts are whole numbers, exact in single precision
        c = common[k : k + 256].astype(np.float64)
        ok[k : k + 256] = c >= threshold * (size[k : k + 256, None] + size[None, :] - c) - 1e-9
    np.fill_diagonal(ok, False)
    if side is not None:
        ok &= side[:, None] != side[None, :]
    label = np.arange(n)
    for x in range(n):
        own = np.unique(np.append(label[ok[x]], label[x]))
        if len(own) > 1:
            label[np.isin(label, own)] = own[0]
    for x, links in enumerate(ok.sum(1)):
        if links:
            yield int(ids[x]), int(links), int(ids[label[x]])


def jaccard_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, threshold: float = 0.8, recall: float = 0.9995, rows: int = 5, budget: int = 2_000_000
) -> DataFrame:
    """One row per input row: id, class_id, copy_id, n_copies, n_links.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z
    lower-cased.  Rows with equal word sequences share ``copy_id`` (their
    smallest id) and count as ``n_copies``.  ``n_links`` is how many other word
    sequences have Jaccard similarity of ``threshold`` or more on sets of
    ``size``-word shingles; ``class_id`` is the smallest id that such links
    reach.  A text with fewer words than ``size`` has one shingle of all its
    words.  A text without words (null, empty or only signs) links to nothing
    and is a class of its own; so is a row with a null id, whose ids are null.
    Repeated rows come back once each.  An id names one text: of different texts
    under one id any one may be compared for it.  Other columns are ignored.

    ``recall``: probability that banding proposes a pair just at the threshold;
    a pair proposed at any distance within its group is verified exactly.
    ``budget``: shingles that one task holds at a time.
    """
    spark = docs.sparkSession
    tune(spark)
    bands = bands_for(threshold, recall, rows)
    sig = materialise(signatures(docs, id_col, text_col, size, bands, rows), "signatures")
    known = sig.where(F.col("id").isNotNull() & (F.col("n") > 0))
    firsts = known.groupBy("k1", "k2").agg(F.min(F.struct("id", "n", "bands")).alias("first"), F.count("*").alias("n_copies"))
    reps = materialise(firsts.select("k1", "k2", "n_copies", "first.*"), "classes")

    keyed = reps.select("id", F.posexplode("bands").alias("band", "h")).select("id", F.xxhash64("band", "h").alias("bucket"), "h")
    shared = keyed.groupBy("bucket", "h").agg(F.min("id").alias("low"), F.count("*").alias("k")).where("k > 1").select("bucket", "h", "low")
    shared = materialise(shared, "buckets")  # plain join sides here and below: Spark can split a hot bucket's or group's partition
    groups = materialise(connected_components(keyed.join(shared, ["bucket", "h"]).select("id", "low"), "id", "low"), "candidates")

    # Deal large groups into blocks. A size class is a factor of 1/threshold wide, so partners are at most one class apart.
    members = reps.join(groups, reps.id == groups.node).select(
        "id", F.greatest("n", F.lit(budget // 2000)).alias("n"), "component", F.floor(F.log("n") / -math.log(threshold) + 1e-9).cast("int").alias("c")
    )
    weights = members.groupBy("component", "c").agg(F.sum("n").alias("w"))
    total = weights.groupBy("component").agg(F.sum("w").alias("all"))
    deal = weights.join(total, "component").where(F.col("all") > budget).select("component", "c", F.ceil(F.col("w") * 2 / budget).cast("int").alias("parts"))
    beside = deal.select("component", (F.col("c") - 1).alias("c"), F.col("parts").alias("above")).unionByName(
        deal.select("component", (F.col("c") + 1).alias("c"), F.col("parts").alias("below")), allowMissingColumns=True
    )
    beside = beside.groupBy("component", "c").agg(F.max("above").alias("above"), F.max("below").alias("below"))
    deal = deal.join(beside, ["component", "c"], "left").fillna(0, ["above", "below"])
    deal = materialise(deal, "deal")
    own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    name = lambda c, x, y: F.xxhash64("component", c, x, y)  # noqa: E731  the task where block x of class c meets block y of class c, or -1-y of the class above
    each = lambda n, f: F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), f)
    meets = F.concat(
        each(F.col("parts"), lambda y: F.struct(name(F.col("c"), F.least(own, y), F.greatest(own, y)).alias("task"), F.when(y == own, 2).otherwise((own > y).cast("int")).alias("side"))),
        each(F.col("above"), lambda y: F.struct(name(F.col("c"), own, -1 - y).alias("task"), F.lit(0).alias("side"))),
        each(F.col("below"), lambda y: F.struct(name(F.col("c") - 1, y, -1 - own).alias("task"), F.lit(1).alias("side"))),
    )
    whole = F.array(F.struct(F.xxhash64("component").alias("task"), F.lit(2).alias("side")))
    tasks = members.join(deal, ["component", "c"], "left").select("id", F.when(F.col("parts").isNull(), whole).otherwise(meets).alias("tasks"))

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(tasks, "id")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, part in scan(batch.column(1)):
                sh, at = shingles(*part.words(), size)
                # sorted and distinct in each text
                owner = np.repeat(np.arange(j - i), np.diff(at))
                order = np.lexsort((sh, owner))
                sh = sh[order]
                keep = np.concatenate([[True], (sh[1:] != sh[:-1]) | (owner[1:] != owner[:-1])])[: len(sh)]
                at = np.concatenate([[0], np.cumsum(np.bincount(owner[keep], minlength=j - i))])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), ragged(sh[keep].view(np.int64), at, pa.int64()), batch.column(2).slice(i, j - i)], names=["id", "sh", "tasks"])

    dealt = texts.select("id", "text", "tasks").mapInArrow(sets, "id long, sh array<long>, tasks array<struct<task:long,side:int>>")
    dealt = dealt.select("id", "sh", F.explode("tasks").alias("t")).select("t.task", "t.side", "id", "sh")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(task, rows):
            if len(rows) < 2:
                return []
            rows = list({r[1]: r for r in rows}.values())
            side = None if rows[0][0] == 2 else np.array([r[0] for r in rows])
            return list(_verify([r[1] for r in rows], [r[2] for r in rows], side, threshold))

        now, rows = None, []
        for batch in batches:
            out = []
            task, side, ids = (batch.column(k).to_pylist() for k in (0, 1, 2))
            lists = batch.column(3)
            at, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            for k in range(len(task)):
                if task[k] != now:
                    out += flush(now, rows)
                    now, rows = task[k], []
                rows.append((side[k], ids[k], values[at[k] : at[k + 1]].copy()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=["id", "links", "root"])
        if out := flush(now, rows):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=["id", "links", "root"])

    verified = dealt.repartition("task").sortWithinPartitions("task").mapInArrow(verify, "id long, links long, root long")
    verified = materialise(verified, "verified")
    links = verified.groupBy("id").agg(F.sum("links").alias("n_links"))
    classes = connected_components(verified, "id", "root")
    about = (
        reps.select("k1", "k2", F.col("id").alias("copy_id"), "n_copies")
        .join(links.withColumnRenamed("id", "copy_id"), "copy_id", "left")
        .join(classes.withColumnRenamed("node", "copy_id"), "copy_id", "left")
    )
    alone = F.col("id").isNull() | (F.col("n") == 0)
    return sig.select("id", "n", F.when(~alone, F.col("k1")).alias("k1"), F.when(~alone, F.col("k2")).alias("k2")).join(about, ["k1", "k2"], "left").select(
        F.col("id").alias(id_col),
        F.coalesce("component", "copy_id", "id").alias("class_id"),
        F.coalesce("copy_id", "id").alias("copy_id"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )
