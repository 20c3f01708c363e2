"""Benchmark decontamination: short test items inside long documents.

A whole document's MinHash says nothing of a short item in it, so documents are
searched as overlapping windows, and items are partitioned by size: items of
2^k to 2^(k+1) shingles are looked up in windows of 3 * 2^k shingles that begin
every 2^k (any run of 2^(k+1) lies in one).  An item contained to the threshold
then has a Jaccard similarity of about a quarter with its window, and one of
``perms`` minima agrees with high probability.  Minima are taken once over small
chunks, and windows of all sizes are minima over chunks (of single shingles for
items smaller than a chunk).  Candidates are
verified by exact containment in the whole document.  No shuffle of texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytescan import U, mix, scan, shingles
from .spill import tune

CHUNK = 8


def _seeds(perms: int) -> np.ndarray:
    return mix(np.arange(1, 2 * perms + 1, dtype=U) * U(0xE7037ED1A0B428DB)) | U(1)


class Items:
    """Signatures of one block of test items, by size class."""

    def __init__(self, ids: list[int], texts: pa.Array, size: int, perms: int):
        self.size, self.seeds, self.perms = size, _seeds(perms), perms
        self.sets: list[np.ndarray] = []
        self.ids: list[int] = []
        by_class: dict[int, list[int]] = {}
        brief: dict[int, list[tuple[int, int]]] = {}
        for i, j, part in scan(texts):
            words, at = part.words()
            sh, sh_at = shingles(words, at, size)
            for k in range(j - i):
                n = int(at[k + 1] - at[k])
                if n:
                    own = np.unique(sh[sh_at[k] : sh_at[k + 1]])
                    if n < size:
                        brief.setdefault(n, []).append((int(own[0]), len(self.sets)))
                    else:
                        by_class.setdefault(len(own).bit_length() - 1, []).append(len(self.sets))
                    self.sets.append(own)
                    self.ids.append(ids[i + k])
        # Items of fewer words than a shingle, by their number of words: their only shingle, sorted, and which they are.
        self.brief = [(n, *(np.array(x, t) for x, t in zip(zip(*sorted(some)), (U, np.intp)))) for n, some in sorted(brief.items())]
        self.classes = []
        for c, members in sorted(by_class.items()):
            minima = np.array([[(self.sets[m] * self.seeds[2 * p] + self.seeds[2 * p + 1]).min() for m in members] for p in range(perms)])
            seen = np.zeros((perms, 1 << 16), bool)
            for p in range(perms):
                seen[p, self._slot(minima[p])] = True
            self.classes.append((c, np.array(members), minima, seen))

    @staticmethod
    def _slot(x: np.ndarray) -> np.ndarray:
        return ((x * U(0x9E3779B97F4A7C15)) >> U(48)).astype(np.intp)

    def candidates(self, sh: np.ndarray, at: np.ndarray) -> set[tuple[int, int]]:
        """(text, item) pairs of which some window and the item share a minimum."""
        n = np.diff(at)
        full = np.flatnonzero(n > 0)
        if not len(full):
            return set()
        # A chunk never crosses texts: each text's last chunk may be short.
        counts = {1: n[full], CHUNK: -(-n[full] // CHUNK)}
        starts = {g: np.concatenate([[0], np.cumsum(k)]) for g, k in counts.items()}
        first = np.repeat(at[:-1][full] - CHUNK * starts[CHUNK][:-1], counts[CHUNK]) + CHUNK * np.arange(starts[CHUNK][-1])
        windows = {c: self._windows(c, starts[self._grain(c)]) for c, *_ in self.classes}
        found = set()
        for p in range(self.perms):
            low = {1: sh * self.seeds[2 * p] + self.seeds[2 * p + 1]}
            low[CHUNK] = np.minimum.reduceat(low[1], first)
            for c, members, minima, seen in self.classes:
                own = low[self._grain(c)]
                owner, edges, tail = windows[c]
                least = np.minimum.reduceat(own, edges)[0::2]
                least[tail] = np.minimum(least[tail], own[-1])
                hits = np.flatnonzero(seen[p, self._slot(least)])
                if len(hits):
                    order = np.argsort(minima[p])
                    ranked = minima[p][order]
                    lo, hi = np.searchsorted(ranked, least[hits]), np.searchsorted(ranked, least[hits], "right")
                    for h, a, b in zip(hits, lo, hi):
                        found.update((int(full[owner[h]]), int(members[m])) for m in order[a:b])
        return found

    @staticmethod
    def _grain(c: int) -> int:
        """Items of fewer shingles than a chunk are searched shingle by shingle."""
        return CHUNK if 1 << c >= CHUNK else 1

    def _windows(self, c: int, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Owner of each window, the edges for reduceat (begin and end in turn), and which windows reach the end of the array."""
        grain = self._grain(c)
        step = (1 << c) // grain
        wide = 3 * step + (grain > 1)  # one more chunk where items begin inside a chunk
        each = -(-np.diff(start) // step)
        owner = np.repeat(np.arange(len(each)), each)
        begin = (np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each)) * step + start[owner]
        stop = np.minimum(begin + wide, start[owner + 1])
        edges = np.empty(2 * len(begin), np.intp)
        edges[0::2], edges[1::2] = begin, np.minimum(stop, start[-1] - 1)
        return owner, edges, stop == start[-1]  # reduceat can't name the end of the array

    def hits(self, column: pa.Array, threshold: float) -> Iterator[tuple[int, int, int]]:
        """(row, item, found shingles) of each verified pair."""
        for i, j, texts in scan(column):
            words, starts = texts.words()
            sh, at = shingles(words, starts, self.size)
            for t, m in sorted(self.candidates(sh, at)):
                k = int(np.isin(self.sets[m], sh[at[t] : at[t + 1]]).sum())
                if k >= threshold * len(self.sets[m]) - 1e-9:
                    yield i + t, m, k
            for t, m in self.whole(words, starts):
                yield i + t, m, 1

    def whole(self, words: np.ndarray, at: np.ndarray) -> list[tuple[int, int]]:
        """(text, item) pairs where all words of an item of less than a shingle stand consecutively in the text."""
        found = set()
        for n, known, which in self.brief:
            runs, runs_at = shingles(words, at, n)
            places = np.flatnonzero(np.isin(runs, known))
            owner = np.searchsorted(runs_at, places, "right") - 1
            for t, h in {(int(t), int(h)) for t, h in zip(owner, runs[places])}:
                lo, hi = np.searchsorted(known, U(h)), np.searchsorted(known, U(h), "right")
                found.update((t, int(m)) for m in which[lo:hi])
        return sorted(found)


def _blocks(items: DataFrame, item_id: str, item_text: str, size: int, perms: int, block: int, block_bytes: int) -> Iterator:
    """Broadcast signatures of at most about ``block`` items, and about ``block_bytes`` of their text, at a time."""
    n, held = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(item_text)), F.lit(0))).first()
    parts = max(1, -(-n // block), -(-held // block_bytes))
    for part in range(parts):
        rows = items.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text"))
        if parts > 1:
            rows = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part)
        rows = rows.collect()
        yield items.sparkSession.sparkContext.broadcast(Items([r.id for r in rows], pa.array([r.text for r in rows], pa.string()), size, perms))


def find_items(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    size: int = 5, threshold: float = 0.8, perms: int = 48, block: int = 20_000, block_bytes: int = 16 << 20,
) -> DataFrame:
    """Rows of (id, item_id, n_shingles, n_found, containment) for each text that contains an item.

    Containment is the share of the item's distinct ``size``-word shingles that
    the whole text holds, ``threshold`` or more.  Words are
    ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased.  An item with
    fewer than ``size`` words is one shingle of them all: a text contains it
    where they stand consecutively.  Items without words (null and empty ones
    too) are in no text; null and empty texts contain nothing.  Repeated rows of
    a text or of an item give repeated results.  Other columns are ignored.

    The items are dealt into blocks of about ``block`` rows and ``block_bytes``
    of text (one longer item is a block of its own).  A block goes to every task
    as signatures (400 bytes an item for 48 permutations) and shingle sets (some
    1.4 bytes for a byte of text), 30 MB in all; more items mean more passes over
    the texts, not larger broadcasts.  The least similar
    case, 8 shingles contained to 0.8 in a window of 32, has a Jaccard similarity
    of 0.19: recall 1 - 0.81**perms, 0.9999 or more.
    """
    tune(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    out = None
    for known in _blocks(items, item_id, item_text, size, perms, block, block_bytes):

        def search(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            bench = known.value
            for batch in batches:
                ids = batch.column(0)
                if hits := [(ids[t].as_py(), bench.ids[m], len(bench.sets[m]), k) for t, m, k in bench.hits(batch.column(1), threshold)]:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*hits)], names=["id", "item_id", "n_shingles", "n_found"])

        found = source.mapInArrow(search, "id long, item_id long, n_shingles long, n_found long")
        out = found if out is None else out.union(found)
    return out.select(F.col("id").alias(id_col), "item_id", "n_shingles", "n_found", (F.col("n_found") / F.col("n_shingles")).alias("containment"))


def decontaminate(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    size: int = 5, threshold: float = 0.8, perms: int = 48, block: int = 20_000, block_bytes: int = 16 << 20,
) -> DataFrame:
    """The rows of docs, all columns, whose text contains no item as find_items() defines it; no shuffle."""
    tune(docs.sparkSession)
    at = docs.columns.index(text_col)
    for known in _blocks(items, item_id, item_text, size, perms, block, block_bytes):

        def keep(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[t for t, _, _ in known.value.hits(batch.column(at), threshold)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
