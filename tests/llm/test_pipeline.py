"""run() against a plain version of every stage, on a small corpus."""

import random
from collections import Counter

import corpus_pipeline
import public_tokenizers
from bitloom.llm.quality_rules import quality_rules
from tokenizers import Tokenizer

from . import brute
from .test_text_operators import corpus


def test_run_and_stages(spark, tmp_path):
    rng = random.Random(4)
    rows = [(k, t) for k, (_, t) in enumerate(corpus(3, near=15, plain=40))] + [(None, "no id " + " ".join(f"w{k}" for k in range(60)))]
    rows += [(500 + k, " ".join(f"THE{rng.randrange(30)}##" for _ in range(80))) for k in range(12)]
    passage = " ".join(f"item{k}" for k in range(20))
    rows += [(600, passage + " and " + " ".join(f"w{rng.randrange(300)}" for _ in range(80)))]
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    labels = [(i, 1, 0) for i, _ in rows[:40] if i is not None] + [(500 + k, 0, 0) for k in range(6)]
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, passage), (2, None), (3, "item3 item4")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    # the fitted verdict is taken from the operator; its rules are held in its own tests
    verdict = quality_rules(docs, spark.read.parquet(str(tmp_path / "labels.parquet"))).where("kept").collect()
    want = [(r.doc_id, r.text) for r in verdict]
    assert 600 in {i for i, _ in want} and not {i for i, _ in want} & set(range(500, 512))
    assert all(not brute.base_rules(t)[5] for _, t in want)
    want = [(i, x[2]) for (i, _), x in zip(want, brute.line_dedup(want))]
    want = [(i, t) for (i, t), c in zip(want, brute.jaccard_classes(want)) if i is None or c[0] == i]
    want = [(i, t) for i, t in want if not brute.contained([(i, t)], [(1, passage)])]

    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(want) and len(want) > 20 and 600 not in {r.doc_id for r in got}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = lambda text: len(library.encode(text, add_special_tokens=False))
    assert all(r.n_chars == len(r.text) and r.n_tokens == max(1, tokens(r.text)) <= r.bucket_len for r in got)

    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "packing"]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, str(tmp_path))
        assert out.count() == 0
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
