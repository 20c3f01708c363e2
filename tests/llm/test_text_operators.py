import random
from collections import Counter

import pytest
from bitloom.llm.decontaminate import decontaminate, find_items
from bitloom.llm.line_dedup import line_dedup
from bitloom.llm.ngram_join import bands_for, jaccard_join
from bitloom.llm.quality_rules import quality_rules

from . import brute


def corpus(seed, near=40, plain=60):
    """Random texts with copies, near copies in a large group, shared lines, odd cases and repeated rows."""
    rng = random.Random(seed)
    vocabulary = ["a", "the", "of", "Ünï", "x1", "ñandú"] + [f"w{k}" for k in range(300)]
    make = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    texts = [" ".join(make(rng.choice([3, 5, 60, 120]))) for _ in range(plain)]
    base = make(150)
    for _ in range(near):
        w = list(base)
        for _ in range(rng.randrange(1, 5)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        texts.append(" ".join(w).upper() if rng.random() < 0.3 else ", ".join(w))
    texts += rng.choices(texts, k=30)
    texts = [t + "\n  Shared LINE here \t" * (k % 3 == 0) + "\nshared line here" * (k % 4 == 0) for k, t in enumerate(texts)]
    texts += [None, "", "   ", "...", "\n\n", "one", "word " * 3000, "word " * 3000]
    rows = [(k, t) for k, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[5]), (None, texts[5]), (None, None)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus(1)


def frame(spark, rows):
    names = ["id", "row", "rest", "_k1", "lines", "pos", "score", "rank", "cell"]
    schema = "doc_id long, text string, class_id string, n_lines int, " + ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([(i, t, "clash", 7, *names) for i, t in rows], schema)


def test_line_dedup(spark, rows):
    df = frame(spark, rows)
    got = Counter((r.doc_id, r.text, r.n_lines, r.n_dropped, r.kept_text, r.class_id) for r in line_dedup(df).collect())
    assert got == Counter((i, t, *x, "clash") for (i, t), x in zip(rows, brute.line_dedup(rows)))
    assert sum(r.n_dropped for r in line_dedup(df).collect()) > 50
    few = line_dedup(df, min_key=4, min_docs=3).collect()
    assert Counter((r.doc_id, r.kept_text) for r in few) == Counter((i, x[2]) for (i, _), x in zip(rows, brute.line_dedup(rows, 4, 3)))
    assert line_dedup(df.limit(0)).count() == 0


@pytest.mark.parametrize("budget", [2_000_000, 4000])
def test_jaccard_join(spark, rows, budget):
    df = frame(spark, rows)
    got = Counter(tuple(r) for r in jaccard_join(df, budget=budget).collect())
    want = Counter((i, *x) for (i, _), x in zip(rows, brute.jaccard_classes(rows)))
    assert got == want
    assert max(r[4] for r in got) >= 20
    assert jaccard_join(df.limit(0)).count() == 0


def test_bands_reach_their_recall():
    b = bands_for(0.8, 0.9995, 5)
    assert 1 - (1 - 0.8**5) ** b >= 0.9995 > 1 - (1 - 0.8**5) ** (b - 1)


def test_decontamination(spark, rows):
    rng = random.Random(8)
    items = []
    long = [t for _, t in rows if t and len(brute.words(t)) > 60]
    for m in range(30):
        w = rng.choice(long).split()
        k = rng.randrange(len(w) - 40)
        part = w[k : k + rng.choice([4, 5, 12, 15, 30, 40])]
        if m % 3 == 0:
            part[rng.randrange(len(part))] = "changed"
        items.append((m, " ".join(part)))
    items += [(90, None), (91, ""), (92, "w1 w2"), (93, "W1, x1 the"), (94, "nowhere"), (95, "Ünï"), (3, items[3][1])]
    items.append((96, " ".join(long) + " " + "and so on it goes " * 40_000))  # 1 MB
    rows = [*rows, (3000, items[-1][1] + " more"), (3001, "it is w1, x1 the")]
    df, bench = frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    want = Counter(brute.contained(rows, items))
    got = find_items(df, bench)
    assert Counter(tuple(r)[:4] for r in got.collect()) == want and len(want) > 40
    assert Counter(tuple(r)[:4] for r in find_items(df, bench, block=10).collect()) == want
    assert Counter(tuple(r)[:4] for r in find_items(df, bench, block_bytes=100_000).collect()) == want and {94, 96, 93} & {m for _, m, _, _ in want} == {96, 93}
    dirty = {rows[k][1] for k, *_ in brute.contained([(k, t) for k, (_, t) in enumerate(rows)], items)}
    assert Counter((r.doc_id, r.text) for r in decontaminate(df, bench).collect()) == Counter((i, t) for i, t in rows if t not in dirty)
    assert find_items(df.limit(0), bench).count() == 0 and find_items(df, bench.limit(0)).count() == 0


def test_quality_rules(spark, rows):
    rng = random.Random(9)
    extra = [(1000 + k, " ".join(f"W{rng.randrange(300)}!!%%" for _ in range(80))) for k in range(40)]
    extra.append((2000, " ".join(f"w{k}" for k in range(100)) + "\n#x\n#x\n \n \n" + "a b c d a b c"))
    both = [*rows, *extra]
    labels = [(i, 1, None) for i, t in rows if i is not None and i % 2 == 0] + [(i, 0, 0) for i, _ in extra[:20]] + [(None, 1, 0), (5, None, 1)]
    df = frame(spark, both)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality_rules(df, lab).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert Counter((r.doc_id, r.text, *(r[n] for n in names)) for r in got) == Counter((i, t, *brute.base_rules(t)) for i, t in both)
    junk = {i for i, _ in extra[:40]}
    assert all(not r.kept for r in got if r.doc_id in junk or r.base_failed)
    assert all(r.kept for r in got if r.doc_id not in junk and not r.base_failed)
    assert got[0].class_id == "clash"
    alone = quality_rules(df, lab.limit(0)).collect()
    assert all(r.kept == (not r.base_failed) for r in alone)
    assert quality_rules(df.limit(0), lab).count() == 0


def test_target_counts_cover_all_trusted_documents(spark):
    rng = random.Random(9)
    rows = [(k if k % 9 else None, " ".join(rng.choice(["alpha", "beta", f"w{k}", f"x{rng.randrange(99)}"]) for _ in range(60))) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(60)], "doc_id long, quality int, toxic int")
    scores = [sorted((r.text, r.score) for r in quality_rules(docs, labels, max_labels=n).collect()) for n in (6, 60)]
    assert scores[0] == scores[1] and len(scores[0]) == 60 and any(s for _, s in scores[0])
