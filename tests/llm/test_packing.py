import itertools
import random
from collections import Counter, defaultdict

import numpy as np
from bitloom.llm.packing import best_bounds, bin_top, pack, word_count
from pyspark.sql import functions as F


def padding(tops, counts, bounds):
    return sum(c * (min(b for b in bounds if b >= t) - t) for t, c in zip(tops, counts))


def test_bounds_are_optimal():
    rng = random.Random(6)
    for _ in range(200):
        n, k = rng.randrange(1, 9), rng.randrange(1, 5)
        tops = rng.sample(range(1, 60), n)
        counts = [rng.randrange(1, 30) for _ in tops]
        bounds = best_bounds(np.array(tops), np.array(counts), k)
        rest = sorted(tops)[:-1]
        best = min(padding(tops, counts, [*some, max(tops)]) for r in range(min(k, n)) for some in itertools.combinations(rest, r))
        assert len(bounds) <= k and padding(tops, counts, bounds) == best
    assert best_bounds(np.zeros(0), np.zeros(0), 3) == []


def test_bins_hold_their_lengths(spark):
    rows = spark.createDataFrame([(n,) for n in [1, 2, 4096, 4097, 5000, 8192, 8193, 10**6, 10**9]], "n long").select("n", bin_top(F.col("n")).alias("top")).collect()
    assert all(r.n <= r.top <= max(r.n, r.n * 65 / 64) for r in rows)


def test_batches(spark):
    rng = random.Random(7)
    rows = [(k if k % 7 else None, " ".join(["w"] * rng.choice([0, 1, 3, 10, 50, 200, 900])), "x") for k in range(400)] + [(1, None, "x"), (2, "a b", "x"), (2, "a b", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, batch string")
    got = pack(df, word_count(), buckets=4, budget=500, cell=60).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(r[:2] for r in rows)
    bounds = {r.bucket: r.bucket_len for r in got}
    lengths = Counter(max(1, len((t or "").split())) for _, t, _ in rows)
    assert sorted(bounds.values()) == best_bounds(np.array(list(lengths)), np.array(list(lengths.values())), 4)
    batches = defaultdict(list)
    for r in got:
        assert r.n_tokens == max(1, len((r.text or "").split())) <= r.bucket_len == min(b for b in bounds.values() if b >= r.n_tokens)
        batches[r.bucket, r.batch].append(r.slot)
    for bucket, bound in bounds.items():
        mine = {k: v for k, v in batches.items() if k[0] == bucket}
        holds = max(1, 500 // bound)
        assert sorted(k[1] for k in mine) == list(range(len(mine)))
        for k, slots in mine.items():
            assert sorted(slots) == list(range(len(slots))) and (len(slots) == holds or k[1] == len(mine) - 1)
    assert pack(df.limit(0), word_count()).count() == 0


def test_query_packs_tokens(spark, tmp_path):
    import public_tokenizers
    from bitloom.llm.queries import op5_packing
    from tokenizers import Tokenizer

    texts = [None, "", "one two", "antidisestablishmentarianism", "漢字" * 3_000, "x1y2" * 25_000]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {k: max(1, len(library.encode(t or "", add_special_tokens=False))) for k, t in enumerate(texts)}
    got = op5_packing(spark, str(tmp_path)).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want and want[4] > 1000 and want[5] > 32_768
    assert all(r.n_tokens <= r.bucket_len for r in got)
    assert [r.doc_id for r in got if (r.bucket, r.batch) == next((x.bucket, x.batch) for x in got if x.doc_id == 5)] == [5]


def test_long_bounds_are_lengths_of_documents(spark):
    rows = spark.createDataFrame([(k, [10_922, 16_380, 16_400][k % 3]) for k in range(27)], "doc_id long, n long")
    got = pack(rows, F.col("n"), buckets=2).collect()
    assert {(r.n, r.bucket_len) for r in got} == {(10_922, 10_922), (16_380, 16_400), (16_400, 16_400)}
    assert Counter(Counter((r.bucket, r.batch) for r in got if r.n == 10_922).values()) == {3: 3}
