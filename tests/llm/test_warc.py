import base64
import hashlib
import random
from collections import Counter

import pytest
from bitloom.llm import warc
from bitloom.llm.spill import fresh_path


def b32(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_round_trip(spark):
    rng = random.Random(3)
    page = lambda: "<html>" + " ".join(rng.choice(["<p>", "</p>", "word", "ünï", "x"]) for _ in range(200)) + "</html>"
    htmls = [page() for _ in range(300)] + [None, "", "\r\n\r\n", "P*M\x18\0\0\0\0", "big " * 300_000]
    rows = [(k, f"http://e.com/{k}", h) for k, h in enumerate(htmls)] + [(1000 + k, "http://e.com/\r\nEvil: 1", htmls[k % 7]) for k in range(40)] + [(None, None, htmls[0]), (None, "u", "only null")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")
    path = fresh_path(spark, "test")
    warc.write_archives(pages.repartition(3), path)
    got = warc.read_archives(spark, path, payload=True).collect()
    first = {}
    for i, _, h in rows:
        p = (h or "").encode()
        if i is not None:
            first[p] = min(i, first.get(p, i))
    want = Counter()
    for i, _, h in rows:
        p = (h or "").encode()
        revisit = p in first and first[p] != i
        want[(i, len(p), b32(p), "revisit" if revisit else "response", first[p] if revisit else None, None if revisit else p)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got) == want
    assert {r.url for r in got if r.page_id == 1000} == {"http://e.com/%0D%0AEvil: 1"}
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()
    assert all(bytes(f.content[:4]) == warc.DICTIONARY_MAGIC for f in files if f.length)
    assert sum(f.length for f in files) < sum(len(h or "") for h in htmls) / 2


def test_small_payloads_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "u", "same"), (2, "u", "same"), (2, "u", "same")], "page_id long, url string, html string")
    assert Counter((r.page_id, r.record_type) for r in warc.round_trip(pages, min_revisit=5).collect()) == {(1, "response"): 1, (2, "response"): 2}
    assert Counter((r.page_id, r.record_type, r.refers_to) for r in warc.round_trip(pages).collect()) == {(1, "response", None): 1, (2, "revisit", 1): 2}
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_a_damaged_archive_raises(spark):
    record = warc.record_bytes(1, "u", b"payload", b32(b"other"), None, "1970-01-01T00:00:00Z")
    with pytest.raises(ValueError, match="digest"):
        warc.parse_record(record)
    with pytest.raises(ValueError, match="no frame"):
        list(warc.records_of(b"garbage!"))
