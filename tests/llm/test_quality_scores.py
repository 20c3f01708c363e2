"""Scores, threshold and memory of the quality rules, against plain recounts."""

import math
import random
import tracemalloc
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from bitloom.llm import bytescan, decontaminate, ngram_join
from bitloom.llm import quality_rules as Q
from pyspark.sql import functions as F

from . import brute

MASK = (1 << 64) - 1


def plain_mix(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & MASK
    return x ^ (x >> 31)


def grams(text, buckets):
    b = (text or "").encode()
    return Counter(plain_mix(1 + (b[i] << 16) + (b[i + 1] << 8) + b[i + 2]) % buckets for i in range(len(b) - 2))


def ratio(own, raw, target, buckets):
    n = sum(own.values())
    of = lambda counts, k, total: math.log((1 + counts[k]) / (buckets + total))
    r, t = sum(raw.values()), sum(target.values())
    return sum(c * (of(target, k, t) - of(raw, k, r)) for k, c in own.items()) / n if n else 0.0


def corpus():
    rng = random.Random(12)
    word = lambda kind: "".join(rng.choice(kind) for _ in range(rng.randrange(2, 9)))
    rows = [(k, " ".join(word("abcdefgé漢 ") for _ in range(rng.choice([20, 70, 90])))) for k in range(60)]
    rows += [(k, " ".join(word("XYZ0123456789#%") for _ in range(70))) for k in range(60, 100)]
    rows += [(200, None), (201, ""), (202, "ab"), (None, rows[3][1]), (4, rows[4][1])]
    labels = [(k, int(k < 60), 0) for k in range(0, 100, 2)] + [(4, 0, 0), (None, 1, 0)]
    return rows, labels


def test_scores_and_threshold_by_dictionaries(spark):
    rows, labels = corpus()
    buckets = 512
    got = Q.quality_rules(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), buckets=buckets).collect()
    known = {k: q for k, q, _ in labels if k not in (None, 4)}
    raw, target = Counter(), Counter()
    for i, t in rows:
        raw += grams(t, buckets)
        target += grams(t, buckets) if known.get(i) == 1 else Counter()
    scores = [ratio(grams(t, buckets), raw, target, buckets) for _, t in rows]
    assert len(got) == len(rows)
    by_text = {t: s for (_, t), s in zip(rows, scores)}
    assert all(abs(r.score - by_text[r.text]) < 1e-8 for r in got)
    # the threshold separates labelled documents by counts without their own n-grams
    held = []
    for i, t in rows:
        if i in known and not brute.base_rules(t)[5]:
            own = grams(t, buckets)
            held.append((ratio(own, raw - own, target - own if known[i] else target, buckets), known[i]))
    best, at = -1, []
    points = sorted(s for s, _ in held)
    for low, high in zip([points[0] - 1, *points], [*points, points[-1] + 1]):
        if high - low < 1e-12:
            continue
        cut = (low + high) / 2
        gain = sum(s >= cut for s, q in held if q) / sum(q for _, q in held) + sum(s < cut for s, q in held if not q) / sum(1 - q for _, q in held)
        if gain > best + 1e-12:
            best, at = gain, [(low, high)]
        elif gain > best - 1e-12:
            at.append((low, high))
    low, high = max(at, key=lambda x: x[1] - x[0])
    assert best == 2
    verdicts = {r.text: r.kept for r in got}
    assert all(verdicts[t] == (not brute.base_rules(t)[5] and s >= (low + high) / 2) for t, s in by_text.items())


def test_unlabelled_documents_are_judged_right(spark):
    rows, labels = corpus()
    got = Q.quality_rules(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), texts=False).collect()
    assert "text" not in got[0]
    judged = [r for r in got if r.doc_id is not None and r.doc_id % 2 and r.doc_id < 100 and not r.base_failed]
    assert len(judged) > 30 and all(r.kept == (r.doc_id < 60) for r in judged)
    none = Q.quality_rules(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), few=0)
    assert Counter((r.doc_id, r.score) for r in none.collect()) == Counter((r.doc_id, r.score) for r in Q.quality_rules(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect())


def test_threshold_is_fitted_on_every_labelled_document(spark):
    """The 400 labelled ids of the greatest hashes, which a sample of 20,000 leaves out, are trusted and unlike the others that are."""
    rng = random.Random(21)
    ids = [r.id for r in spark.range(20_400).orderBy(F.xxhash64("id"), "id").collect()]
    good, poor = (["".join(rng.choice(kind) for _ in range(3)) for _ in range(400)] for kind in ("abcdefgh", "stuvwxyz"))
    rows = [(i, " ".join(rng.choices(good, k=60) if k % 2 else rng.choices(poor, k=60))) for k, i in enumerate(ids[:20_000])]
    rows += [(i, " ".join(rng.choices(good, k=18) + rng.choices(poor, k=42))) for i in ids[20_000:]]
    trusted = {i for k, i in enumerate(ids) if k % 2 or k >= 20_000}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(i in trusted), 0) for i in ids], "doc_id long, quality int, toxic int")
    for few in (1_000_000, 0):
        got = Q.quality_rules(docs, labels, few=few, texts=False).where("kept").select("doc_id").collect()
        assert len(got) == len(trusted) and {r.doc_id for r in got} == trusted


@pytest.mark.parametrize("parts", [1, 5])
def test_separating_by_trying_every_threshold(spark, parts):
    rng = random.Random(parts)
    for kinds in ([True, False], [True], [False], []):
        for n in (1, 2, 300):
            rows = [(rng.randrange(60) / 8 + 2 * t, t) for t in (rng.choice(kinds) for _ in range(n if kinds else 0))]
            got = Q.separating(spark.createDataFrame(rows, "score double, trusted boolean"), parts)
            points = sorted({s for s, _ in rows})
            if True not in kinds or not any(t for _, t in rows):
                assert got == -math.inf
                continue
            if all(t for _, t in rows):
                assert got == points[0]
                continue
            tried = [(0, 0.0, -points[0], points[0])]
            for low, high in zip(points, points[1:]):
                right = sum(Fraction(1, sum(u == t for _, u in rows)) * (1 if (s >= high) == t else 0) for s, t in rows)
                tried.append((right - 1, high - low, -low, (low + high) / 2))
            assert got == max(tried)[3]


def test_held_out_scores_of_long_and_short_texts(monkeypatch):
    rng = random.Random(5)
    texts = ["".join(rng.choice("abé漢 ") for _ in range(k)) for k in (0, 1, 2, 3, 40, 400)]
    counts = [grams(t, 64) for t in texts]
    raw, target = sum(counts, Counter()) + Counter({3: 5}), sum(counts[3:], Counter())
    arrays = [np.array([c[k] for k in range(64)], np.int64) for c in (raw, target)]
    for step in (1 << 19, 100):
        monkeypatch.setattr(bytescan, "STEP", step)
        got = [Q._held_out(part, np.arange(part.n), *arrays) for _, _, part in bytescan.scan(pa.array(texts))]
        as_other, as_trusted = np.concatenate(got, axis=1)
        for k, own in enumerate(counts):
            assert abs(as_other[k] - ratio(own, raw - own, target, 64)) < 1e-12
            assert k < 3 or abs(as_trusted[k] - ratio(own, raw - own, target - own, 64)) < 1e-12


@pytest.mark.parametrize("texts, bound", [(["a fair word or two, and more. " * 100] * 1400, 24 << 20), (["a fair word " * 700_000], 8_400_000 * 20), (["x" * 8_000_000], 8_000_000 * 6)])
def test_memory_follows_a_stretch_or_the_longest_text(texts, bound):
    column = pa.array(texts)
    peaks = []

    def count():
        for _, _, part in bytescan.scan(column):
            for _ in Q._grams(part, 1 << 16):
                pass

    def judge():
        for _, _, part in bytescan.scan(column):
            Q._base(part)
            Q._scores(part, np.zeros((1 << 16) + 1, np.int64), 1 << 16)

    def signatures():
        for _, _, part in bytescan.scan(column):
            ngram_join._band_hashes(*bytescan.shingles(*part.words(), 5), 20, 5)

    bench = decontaminate.Items([1], pa.array(["one two three four five six seven eight nine"]), 5, 48)
    for work in (count, judge, signatures, lambda: list(bench.hits(column, 0.8))):
        tracemalloc.start()
        work()
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert max(peaks) < bound, peaks


def test_long_words_and_lines_hash_alike_in_pieces(monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choice(["a", "bé", " ", "\n", ".", "Z", "漢"]) for _ in range(rng.randrange(60))) for _ in range(100)] + [None, "", "x" * 500 + " y\nyy"]

    def all_of():
        out = []
        for i, j, part in bytescan.scan(pa.array(texts)):
            words, at = part.words()
            line, has_word, owner = part.lines(part.spans(bytescan.NONSPACE)[0])
            sh, sh_at = bytescan.shingles(words, at, 5)
            out += [(words[at[k] : at[k + 1]].tolist(), sh[sh_at[k] : sh_at[k + 1]].tolist(), line[owner == k].tolist(), has_word[owner == k].tolist()) for k in range(j - i)]
        return out

    whole = all_of()
    monkeypatch.setattr(bytescan, "STEP", 16)
    bytescan._powers.clear()
    assert all_of() == whole
    bytescan._powers.clear()
    assert [len(w) for w, *_ in whole] == [len(brute.words(t)) for t in texts]
    assert [len(s) for _, s, *_ in whole] == [max(len(w) - 4, int(bool(w))) for w, *_ in whole]
