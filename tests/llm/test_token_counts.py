import json
import os
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import regex
from bitloom.llm import token_counts as T
from bitloom.llm.token_counts import counter, joined_bytes, pieces_of, token_counts, with_token_counts
from tokenizers import Tokenizer

JSON = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(JSON)
PAIRS = counter(JSON)[1]
SMALL = "/root/testdata/sf0.001/documents.parquet"


def library(texts):
    return [len(e) for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_cut_pieces_count_as_the_whole():
    rng = random.Random(5)
    some = ["a", "bc", " ", "  ", "\n", "1", ".", "'s", "'", "é", "ж", "<|endoftext|>", "　", "漢", "字", "の", "\x85", "\x1c", "Qz", "́", "😀", "'re", "!"]
    for round_ in range(600):
        kinds = some if round_ % 2 else [x for x in some if x.strip()]
        text = "".join(rng.choice(kinds) for _ in range(200))
        pieces = pieces_of(text, PAIRS, 7)
        assert "".join(pieces) == text
        assert sum(library(pieces)) == library([text])[0], pieces


def test_long_runs_are_cut():
    for text in ("漢字仮名" * 50_000, "word " * 60_000, "a, " * 30_000, "x1y2Zq" * 30_000):
        pieces = pieces_of(text, PAIRS)
        assert max(map(len, pieces)) < 3 * T.PIECE and "".join(pieces) == text
        assert sum(library(pieces)) == library([text])[0]
    assert pieces_of(" " * 50_000, PAIRS) == [" " * 50_000]  # one pre-token


def units_of(text):
    data = text.encode()
    edges = [0, *T.unit_cuts(np.frombuffer(data, np.uint8)).tolist(), len(data)]
    return [data[a:b].decode() for a, b in zip(edges, edges[1:])]


def test_units_are_cut_after_no_white_space():
    some = [chr(c) for c in range(0x110000) if (c < 0x3100 or c % 97 == 0) and not 0xD800 <= c < 0xE000]
    cut = [c for c in some if len(units_of(c + " ")) == 2]
    assert not [c for c in cut if c.isspace() or regex.match(r"\s|\p{White_Space}", c)]
    assert len(cut) > 12_000 and all(c in cut for c in "aZ9.)}é!ж~_")
    after = library(["\na"])[0]
    assert all(x == y + after for x, y in zip(library([c + "\na" for c in cut]), library(cut)))
    assert units_of("a.b, 'c.' 1.5 é,") == ["a", ".b", ",", " 'c", ".'", " 1", ".5", " é,"]


def test_units_count_as_the_whole():
    rng = random.Random(6)
    some = ["a", "bc", " ", "  ", "\n", "\t", "1", ".", "'s", "é", "ж", "<|endoftext|>", "　", "漢", "\x85", "\xa0", "\x1c", "Qz", "́", "😀", " the", " of", "word", ",", "n, ", "5."]
    texts = ["".join(rng.choice(some) for _ in range(rng.randrange(120))) for _ in range(500)] + ["", "", "漢字" * 9_000, " " * 3_000, "x" * 20_000]
    want = library(texts)
    assert all("".join(units_of(t)) == t and sum(library(units_of(t))) == n for t, n in zip(texts, want) if t)
    column = pa.array(["before", *texts, None])
    for block in (1, 7, 300, 1 << 20):
        sums = T.Remembered(lambda u: library(u), PAIRS, 200)
        assert T._unit_lengths(sums, column[1:], block).tolist() == [*want, 0]
        assert T._unit_lengths(sums, column.cast(pa.large_string())[1:-1], block).tolist() == want
    assert T._unit_lengths(sums, column[:0]).tolist() == [] and T._unit_lengths(sums, pa.array(["", None])).tolist() == [0, 0]


def test_units_are_encoded_once_while_remembered():
    calls = []

    def count(units):
        calls.extend(units)
        return library(units)

    units = [f" w{k}".encode() for k in range(1_000)] + [b" " + b"y" * T.LONG]
    kept, few = T.Remembered(count, PAIRS), T.Remembered(count, PAIRS, 50)
    want = library([u.decode() for u in units])
    assert kept(units) == want and kept(units) == want and len(calls) == len(units) + 1, "only the long one is encoded again"
    assert few(units) == want and few(units[::-1]) == want[::-1] and len(few.young) + len(few.old) <= 100
    assert kept([]) == []


def test_other_tokenizers_get_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        assert joined_bytes(json.load(f)) is None
    assert pieces_of("word " * 60_000, counter(path)[1]) == ["word " * 60_000]


@pytest.mark.skipif(not os.path.exists(SMALL), reason="the given tables are not here")
def test_all_given_documents_count_as_the_library_says(spark):
    rows = pq.read_table(SMALL, columns=["doc_id", "text"]).to_pylist()
    want = dict(zip((r["doc_id"] for r in rows), library([r["text"] or "" for r in rows])))
    got = {r.doc_id: r.n_tokens for r in token_counts(spark.read.parquet(SMALL), JSON).collect()}
    assert got == want


def test_rows(spark):
    texts = [None, "", "hello world", "a<|endoftext|>b", "ж" * 50, "word " * 30_000, "x" * 40_000, "hello world", "漢字" * 20_000]
    df = spark.createDataFrame([(i if i != 3 else None, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    rows = token_counts(df, JSON).collect()
    assert sorted(r.n_tokens for r in rows) == sorted(library([t or "" for t in texts]))
    assert all(r.over_limit == (r.n_tokens > 1024) for r in rows)
    assert sorted(r.n_bytes for r in rows) == sorted(len((t or "").encode()) for t in texts)
    assert token_counts(df.limit(0), JSON).count() == 0
    kept = with_token_counts(df, JSON).collect()
    assert kept[0].asDict().keys() == {"doc_id", "text", "n_tokens"}
    assert sorted((str(r.doc_id), str(r.text), r.n_tokens) for r in kept) == sorted((str(i if i != 3 else None), str(t), library([t or ""])[0]) for i, t in enumerate(texts))


def test_sentencepiece(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    df = spark.createDataFrame([(1, "hello there"), (2, None)], "doc_id long, text string")
    want = len(sentencepiece.SentencePieceProcessor(model_file=path).encode("hello there"))
    assert {r.doc_id: r.n_tokens for r in token_counts(df, path).collect()} == {1: want, 2: 0}
