"""Sentence alignment: the one operator without a Spark primitive.

A pair of documents is aligned in order, one to one, two to one or one to two,
by dynamic programming over cosine similarity inside a band about the diagonal.
Documents are dealt to tasks by estimated cost, and vectors travel to them as
arrays; only the band's similarities exist at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import numbers, numbers_agree
from ..functions.split import sentences
from ..functions.text import text_key
from ..languages import DEFAULT_CUT, LOW_CONFIDENCE, ROUTED

SKIP = -0.3
BAND, BAND_SHARE = 200, 0.10
TIE = 1e-12  # sums in another order differ by less
# moves: (sources, targets)
ONE_ONE, TWO_ONE, ONE_TWO, SKIP_SOURCE, SKIP_TARGET = (1, 1), (2, 1), (1, 2), (1, 0), (0, 1)


def band(n: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last target position of each source row.

    At least BAND or BAND_SHARE of the longer side to either side of the
    diagonal, and never narrower than a row's step, so the rows always touch.
    """
    width = max(BAND, int(BAND_SHARE * max(n, m)), -(-m // max(n, 1)))
    middle = np.arange(n + 1) * m // max(n, 1)
    return np.maximum(0, middle - width), np.minimum(m, middle + width)


def align(one: np.ndarray, two: np.ndarray, other_one: np.ndarray, other_two: np.ndarray) -> list[tuple[int, int, int, int, float]]:
    """Matches (source, its count, target, its count, similarity) in order.

    ``one`` and ``other_one``: unit vectors of the sentences of both sides;
    ``two`` and ``other_two``: of each sentence joined with the next.  Of equal
    scores a two-to-one match comes first, then one-to-two, one-to-one, a skipped
    source, a skipped target.
    """
    n, m = len(one), len(other_one)
    if not n or not m:
        return []
    lo, hi = band(n, m)
    low = -np.inf
    rows = [np.full(m + 3, low) for _ in range(3)]  # rows i, i-1, i-2, each two places to the right, so j-2 exists
    sims: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    codes: list[np.ndarray] = []
    for i in range(n + 1):
        a, b = int(lo[i]), int(hi[i])
        best = np.full(b - a + 1, low)
        code = np.full(b - a + 1, -1, np.int8)
        now, before, earlier = rows[i % 3], rows[(i - 1) % 3], rows[(i - 2) % 3]
        now[:] = low
        if i == 0:
            best[0] = 0.0 if a == 0 else low

        def offer(values: np.ndarray, which: int) -> None:
            better = values > best  # noqa: B023
            best[better], code[better] = values[better], which  # noqa: B023

        def shifted(row: np.ndarray, by: int, gain: np.ndarray, start: int) -> np.ndarray:
            """row[j - by] + gain[j - by - start] for j in a..b, where both exist."""
            at = np.arange(a, b + 1) - by - start  # noqa: B023
            fits = (at >= 0) & (at < len(gain))
            return np.where(fits, row[a + 2 - by : b + 3 - by] + gain[np.clip(at, 0, max(len(gain) - 1, 0))] if len(gain) else low, low)  # noqa: B023

        if i >= 2:
            offer(shifted(earlier, 1, sims[i - 2][1], int(lo[i - 2])), 1)
        if i >= 1:
            offer(shifted(before, 2, sims[i - 1][2], int(lo[i - 1])), 2)
            offer(shifted(before, 1, sims[i - 1][0], int(lo[i - 1])), 0)
            offer(before[a + 2 : b + 3] + SKIP, 3)
        # A skipped target costs the same at every place, so the best way to come along the row is a running maximum.
        slope = SKIP * np.arange(len(best))
        level = np.maximum.accumulate(best - slope)
        passed = np.concatenate([[False], level[:-1] > (best - slope)[1:] + TIE])
        best[passed], code[passed] = (level + slope)[passed], 4
        now[a + 2 : b + 3] = best
        codes.append(code)
        if i < n:
            c = b + 1
            sims.append(
                tuple(
                    x.astype(np.float64)
                    for x in (other_one[a:c] @ one[i], other_one[a:c] @ two[i] if i + 1 < n else np.zeros(0, np.float32), other_two[a:c] @ one[i])
                )
            )
            if i >= 2:
                sims[i - 2] = None
    out, i, j = [], n, m
    while i or j:
        s, t = (ONE_ONE, TWO_ONE, ONE_TWO, SKIP_SOURCE, SKIP_TARGET)[codes[i][j - lo[i]]]
        i, j = i - s, j - t
        if s and t:
            u, v = (one if s == 1 else two)[i], (other_one if t == 1 else other_two)[j]
            out.append((i, s, j, t, float(np.dot(u, v))))
    return out[::-1]


def jobs_of(groups: DataFrame) -> DataFrame:
    """Document pairs to align: English with each other language of a group, every pair of releases once.

    groups: prid, date, byLang, office and ord (a total order of the groups, as
    of files and lines).  Of equal pairs the first stays; a pair without both
    release ids is never equal to another.
    """
    sides = groups.where(F.map_contains_key("byLang", F.lit("en"))).select("*", F.col("byLang")["en"].alias("en"), F.posexplode("byLang").alias("at", "lang", "doc")).where("lang != 'en'")
    jobs = sides.select(
        "office", "prid", "date", "ord", "at", "lang", F.col("en.prid").alias("en_prid"), F.col("doc.prid").alias("text_prid"),
        F.concat_ws("\n", "en.title", "en.body").alias("en_text"), F.concat_ws("\n", "doc.title", "doc.body").alias("lang_text"),
    )
    both = F.col("en_prid").isNotNull() & F.col("text_prid").isNotNull()
    row = F.struct("ord", "at", *(c for c in jobs.columns if c not in ("ord", "at")))
    return jobs.where(both).groupBy("en_prid", "text_prid").agg(F.min(row).alias("r")).select("r.*").select(jobs.columns).unionByName(jobs.where(~both))


def needed_texts(split: DataFrame) -> DataFrame:
    """All texts that alignment reads: (job, side, kind, pos, lang, text); kind 2 joins a sentence with the next."""
    tail = lambda name, k: F.slice(name, k, F.greatest(F.size(name) - 1, F.lit(0)))
    joined = lambda name: F.zip_with(tail(name, 1), tail(name, 2), lambda a, b: F.concat(a, F.lit(" "), b))
    rows = lambda texts, side, kind: F.transform(texts, lambda x, at: F.struct(F.lit(side).alias("side"), F.lit(kind).alias("kind"), at.alias("pos"), x.alias("text")))
    every = F.concat(*(rows(texts, side, kind) for side, name in enumerate(("src", "tgt")) for kind, texts in ((1, F.col(name)), (2, joined(name)))))
    return split.select("job", "lang", F.inline(every))


def cut_of(lang: Column, routed: dict = ROUTED, default: float = DEFAULT_CUT) -> Column:
    """The least similarity that a language's pairs are kept at."""
    if not routed:
        return F.lit(default)
    return F.coalesce(F.create_map(*(F.lit(x) for name, r in routed.items() for x in (name, r[2])))[lang], F.lit(default))


def align_documents(jobs: DataFrame, vectors: DataFrame, default_model: str, routed: dict = ROUTED) -> DataFrame:
    """Aligned pairs (job, n, en, text, sim) above each language's cut, sim not yet rounded.

    jobs: job (id), lang, src, tgt (arrays of sentences).  vectors: (k, v), keyed
    by text_key.  A text whose vector is missing raises: a routed language has no
    fallback.  One shuffle of the texts to their vectors, one back to their job.
    """
    english = F.create_map(*(F.lit(x) for lang, (en, _, _) in routed.items() for x in (lang, en))) if routed else F.create_map().cast("map<string,string>")
    own = F.create_map(*(F.lit(x) for lang, (_, tx, _) in routed.items() for x in (lang, tx))) if routed else F.create_map().cast("map<string,string>")
    model = F.coalesce(F.when(F.col("side") == 0, english[F.col("lang")]).otherwise(own[F.col("lang")]), F.lit(default_model))
    texts = needed_texts(jobs).withColumn("k", text_key(model, F.col("text")))
    found = texts.join(vectors.select("k", "v"), "k", "left")
    lost = F.raise_error(F.concat(F.lit("no vector of: "), F.substring("text", 1, 40))).cast("array<float>")
    placed = found.groupBy("job").agg(F.array_sort(F.collect_list(F.struct("side", "kind", "pos", F.coalesce("v", lost).alias("v")))).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                rows = batch.column(1)[k].values
                parts = {}
                side, kind = rows.field("side").to_numpy(), rows.field("kind").to_numpy()
                flat = rows.field("v").flatten().to_numpy().reshape(len(rows), -1)
                for s in (0, 1):
                    for d in (1, 2):
                        parts[s, d] = flat[(side == s) & (kind == d)]
                found = align(parts[0, 1], parts[0, 2], parts[1, 1], parts[1, 2])
                if found:
                    cols = list(zip(*found))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([batch.column(0)[k].as_py()] * len(found)), pa.array(range(len(found)), pa.int32()), *(pa.array(c, pa.int32()) for c in cols[:4]), pa.array(cols[4], pa.float64())],
                        names=["job", "n", "i", "s", "j", "t", "sim"],
                    )

    matched = placed.mapInArrow(run, f"job {dict(jobs.dtypes)['job']}, n int, i int, s int, j int, t int, sim double")
    both = matched.join(jobs.select("job", "lang", "src", "tgt"), "job").where(F.col("sim") >= cut_of(F.col("lang"), routed))
    text = lambda side, at, n: F.array_join(F.slice(side, F.col(at) + 1, F.col(n)), " ")
    return both.select("job", "n", "lang", text("src", "i", "s").alias("en"), text("tgt", "j", "t").alias("text"), "sim")


def sentence_pairs(groups: DataFrame, vectors, default_model: str, routed: dict = ROUTED, keep=lambda df, name: df) -> DataFrame:
    """Groups to sentence pairs with what checks them: numbers, confidence and where they come from.

    ``vectors``: a DataFrame (k, v), or a function from the texts needed (lang,
    side, text) to one, which may encode what its store lacks.  ``keep(df, name)``
    may write a table and read it back: the split texts are read three times.
    """
    jobs = jobs_of(groups).withColumn("job", F.xxhash64("office", "ord", "at", "lang", "en_prid", "text_prid"))
    split = jobs.select("*", sentences("en_text").alias("src"), sentences("lang_text").alias("tgt"))
    split = keep(split.drop("en_text", "lang_text"), "split")
    table = vectors(needed_texts(split)) if callable(vectors) else vectors
    pairs = align_documents(split, table, default_model, routed)
    about = split.select("job", "prid", "en_prid", "text_prid", F.coalesce("date", F.lit("")).alias("date"), "office", "ord", "at")
    return pairs.join(about, "job").select(
        "lang", "en", "text", F.round("sim", 3).alias("sim"), numbers_agree(numbers(F.col("en")), numbers(F.col("text"))).alias("numbers"),
        F.when(F.col("lang").isin(*LOW_CONFIDENCE), "low").otherwise("normal").alias("confidence"), "prid", "en_prid", "text_prid", "date", "office", "ord", "at", "n",
    )
