import json
import random

import numpy as np
import pytest
from bitloom import schemas
from bitloom.operators import align, package, releases, report, sample, vectors
from bitloom.plans import months
from bitloom.plans.publish import publish
from bitloom.sources import files
from bitloom.streaming.ingest import ingest, page_stream
from pyspark.sql import functions as F

from .test_html import link, page

GROUP = "prid string, date string, ministry string, byLang map<string,struct<prid:string,title:string,body:string>>, office string, ord int"


def doc(prid, title, body=""):
    return {"prid": prid, "title": title, "body": body}


# ------------------------------------------------------------------- alignment


def plain_alignment(s, s2, t, t2):
    """The best score over the whole table, cell by cell."""
    n, m = len(s), len(t)
    best = {(0, 0): 0.0}
    for i in range(n + 1):
        for j in range(m + 1):
            options = [best[i, j]] if (i, j) in best else []
            if i and j:
                options.append(best[i - 1, j - 1] + float(t[j - 1] @ s[i - 1]))
            if i > 1 and j:
                options.append(best[i - 2, j - 1] + float(t[j - 1] @ s2[i - 2]))
            if i and j > 1:
                options.append(best[i - 1, j - 2] + float(t2[j - 2] @ s[i - 1]))
            if i:
                options.append(best[i - 1, j] + align.SKIP)
            if j:
                options.append(best[i, j - 1] + align.SKIP)
            best[i, j] = max(options)
    return best[n, m]


def unit(rng, n, dim=8):
    v = rng.normal(size=(max(n, 0), dim)).astype(np.float32)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def test_alignment_is_optimal_monotone_and_disjoint():
    rng = np.random.default_rng(5)
    for _ in range(40):
        n, m = rng.integers(1, 12, 2)
        s, s2, t, t2 = unit(rng, n), unit(rng, n - 1), unit(rng, m), unit(rng, m - 1)
        found = align.align(s, s2, t, t2)
        used_s, used_t = sum(x[1] for x in found), sum(x[3] for x in found)
        score = sum(x[4] for x in found) + align.SKIP * (n - used_s + m - used_t)
        assert abs(score - plain_alignment(s, s2, t, t2)) < 1e-5
        ends = [(0, 0), *((i + a, j + b) for i, a, j, b, _ in found)]
        assert all(i >= p and j >= q for (i, _, j, _, _), (p, q) in zip(found, ends))


def test_equal_scores_prefer_merges():
    same = np.ones((2, 1), np.float32) / 2
    assert [x[:4] for x in align.align(same * 2, same[:1] * 4, same[:1] * 2, same[:0])] == [(0, 2, 0, 1)]
    assert align.align(same[:0], same[:0], same, same[:1]) == []


def test_a_long_document_and_uneven_sides():
    rng = np.random.default_rng(7)
    s = unit(rng, 1500, 16)
    other = np.delete(s, 700, axis=0)
    found = align.align(s, unit(rng, 1499, 16), other, unit(rng, 1498, 16))
    ones = [x for x in found if x[1] == x[3] == 1 and x[4] > 0.99]
    assert len(ones) >= 1490
    assert align.align(unit(rng, 1), unit(rng, 0), unit(rng, 900), unit(rng, 899))  # rows of the band still touch


ROWS = [
    ("g1", "05 NOV 2018 2:20PM by Desk", "M", {"en": doc("1", "One 5. Two"), "hi": doc("2", "One 5. Two"), "mni": doc("3", "One 5. Two")}, "delhi-en", 0),
    ("g2", "", "M", {"hi": doc("2", "One 5. Two"), "en": doc("1", "One 5. Two")}, "mumbai-hi", 1),
    ("g3", None, None, {"en": doc(None, "Sole line"), "mr": doc(None, "Sole line")}, "x-mr", 2), ("g4", None, None, {"en": doc(None, "Sole line"), "mr": doc(None, "Sole line")}, "x-mr", 3),
    ("g5", "", "", {"hi": doc("9", "No pivot")}, "x-hi", 4),
]


def test_sentence_pairs(spark):
    groups = spark.createDataFrame(ROWS, GROUP)
    assert sorted((r.lang, r.prid) for r in align.jobs_of(groups).collect()) == [("hi", "g1"), ("mni", "g1"), ("mr", "g3"), ("mr", "g4")]
    encoder = vectors.hashed_encoder()
    store = spark.createDataFrame([], schemas.VECTOR)

    def known(texts):
        out = None
        for model in ("m", "LASER2:eng_Latn", "LASER3:mni_Beng"):
            new = vectors.with_vectors(texts, store, model, encoder)
            out = new if out is None else out.unionByName(new)
        return out

    rows = align.sentence_pairs(groups, known, "m").orderBy("ord", "at", "n").collect()
    assert [(r.lang, r.en, r.text, r.sim, r.numbers, r.confidence, r.office) for r in rows[:4]] == [
        ("hi", "One 5.", "One 5.", 1.0, True, "normal", "delhi-en"), ("hi", "Two", "Two", 1.0, None, "normal", "delhi-en"), ("mni", "One 5.", "One 5.", 1.0, True, "low", "delhi-en"), ("mni", "Two", "Two", 1.0, None, "low", "delhi-en"),
    ]
    assert len(rows) == 6 and rows[4].date == ""
    with pytest.raises(Exception, match="no vector of"):
        align.sentence_pairs(groups, lambda texts: vectors.with_vectors(texts, store, "m", encoder), "m").collect()


def test_each_text_is_encoded_once(spark):
    texts = spark.createDataFrame([("a",), ("b",), ("a",)], "text string")
    encoder = vectors.hashed_encoder()
    store = vectors.encode(vectors.missing(texts, spark.createDataFrame([], schemas.VECTOR), "m"), "m", encoder)
    assert store.count() == 2 and vectors.missing(texts, store, "m").count() == 0 and vectors.missing(texts, store, "other").count() == 2
    assert vectors.put(store, store.withColumn("text", F.lit("new"))).select("text").distinct().collect()[0][0] == "new"


def test_translation_budget(spark):
    jobs = spark.createDataFrame([("en", "hi", "ab"), ("en", "hi", "ab"), ("en", "mr", "a😀"), ("en", "hi", "xyz")], "`from` string, `to` string, text string")
    cache = spark.createDataFrame([("en", "hi", "xyz", "XYZ")], schemas.TRANSLATION)
    assert vectors.uncached_cost(jobs, cache).first()["cost"] == 5
    source = spark.createDataFrame([("en", "hi", "ab", "AB"), ("en", "mr", "a😀", "M"), ("en", "hi", "xyz", "no")], schemas.TRANSLATION)
    assert sorted(r.translated for r in vectors.translated(jobs, cache, source, budget=5).collect()) == ["AB", "AB", "M", "XYZ"]
    with pytest.raises(ValueError, match="exceeds the budget"):
        vectors.translated(jobs, cache, source, budget=4)
    with pytest.raises(Exception, match="not translated"):
        vectors.translated(jobs, cache).collect()


# ------------------------------------------------------------ releases and packages


def test_release_groups(spark):
    pages = spark.createDataFrame([("1", page("Cotton", "<p>Body</p>", link(2, "Hindi") + link(3, "Tamil"))), ("2", page("कपास", "<p>पाठ</p>")), ("3", "<html>gone</html>"), ("4", page("T", ""))], schemas.PAGE)
    from bitloom.functions.html import parse_releases

    rel = parse_releases(pages.where("prid IN ('1', '4')"), F.lit("en"))
    rows = releases.release_groups(rel, pages, ["hi", "ta", "en"]).collect()
    assert [(r.prid, {k: (v.prid, v.body) for k, v in r.byLang.items()}) for r in rows] == [("1", {"en": ("1", "Body"), "hi": ("2", "पाठ")})]
    assert list(rows[0].byLang) == ["en", "hi"]
    assert releases.link_report(rel).first()["report"] == "1 of 2 releases link a translation"
    assert releases.link_report(rel.limit(0)).first()[:] == (0, 0, True, "0 of 0 releases link a translation")
    regional = spark.createDataFrame([("pa", {}), ("pa", {}), ("pa", {"en": "9"})], "lang string, translations map<string,string>")
    assert releases.link_report(regional).first()["report"] == "1 of 3 releases link an English translation"
    assert [r.prid for r in releases.stale_pages(pages, F.lit("2025-11-30").cast("timestamp")).orderBy("prid").collect()] == ["1", "2", "4"]


def test_a_release_is_parsed_once_for_its_group_and_once_as_a_linked_page(spark):
    pages = spark.createDataFrame([("1", page("Cotton", "<p>Body</p>", link(2, "Hindi"))), ("2", page("कपास", "<p>पाठ</p>")), ("3", page("T", "", link(2, "Hindi")))], schemas.PAGE)
    from bitloom.functions.html import FOOTER_LINE, parse_releases

    groups = releases.release_groups(parse_releases(pages, F.lit("en")), pages, ["hi", "ta", "en"])
    plan = groups._jdf.queryExecution().optimizedPlan()
    nodes = [plan]
    for node in nodes:
        nodes.extend(node.children().apply(k) for k in range(node.children().size()))
    made = [n for n in nodes if f"{FOOTER_LINE})" in n.verboseString(10**6)]
    assert "Filter" not in {n.nodeName() for n in made}
    assert sum(n.verboseString(10**6).count(f"{FOOTER_LINE})") for n in made) == 6  # one of two for a release and for a linked page; two more for the language of an untitled one
    assert {r.prid: sorted(r.byLang) for r in groups.collect()} == {"1": ["en", "hi"], "2": ["hi"]}


def test_fold_and_documents(spark):
    pair = lambda en, text, lang, office, k: (lang, en, text, 0.9, None, "normal", "p", "1", "2", "05 NOV 2018 2:20PM by Desk", office, k)
    rows = [pair("Friends", "मित्रों", "hi", "a", 3), pair("Friends", "मित्रों", "hi", "b", 1), pair("Friends", "Friends", "hi", "a", 2), pair("x", "y", "doi", "a", 5), pair("Hello", "नमस्ते", "hi", "a", 4)]
    pairs = spark.createDataFrame(rows, "lang string, en string, text string, sim double, numbers boolean, confidence string, prid string, en_prid string, text_prid string, date string, office string, ord int")
    copies = spark.createDataFrame([("hi", "Friends", "मित्रों", True, 0), ("hi", "Friends", "मित्रों", False, 1)], "lang string, en string, text string, google_copy boolean, ord int")
    got = package.fold(pairs, copies).orderBy("seen").collect()
    assert [(r.en, r.office, r.occurrences, r.google_copy, r.date, r.posted_by) for r in got] == [("Friends", "b", 2, False, "2018-11-05", "Desk"), ("Hello", "a", 1, None, "2018-11-05", "Desk")]
    assert {n: t for n, t in package.fold(pairs).drop("seen").dtypes} == {f.name: f.dataType.simpleString() for f in schemas.SENTENCES}
    docs = package.documents(spark.createDataFrame(ROWS, GROUP))
    assert sorted((r.lang, r.office, r.ministry, r.date) for r in docs.collect()) == [("hi", "delhi-en", "M", "2018-11-05"), ("mni", "delhi-en", "M", "2018-11-05"), ("mr", "x-mr", "", "")]
    assert [f.name for f in docs.schema] == [f.name for f in schemas.DOCUMENTS]


def test_round_robin(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), rng.choice("xyz"), k) for k in range(60)]
    got = sample.round_robin(spark.createDataFrame(rows, "cell string, grp string, k int"), ["cell"], "grp", ["k"], 10).collect()
    for cell in "ab":
        groups = {}
        for c, g, k in rows:
            if c == cell:
                groups.setdefault(g, []).append(k)
        want = [v[i] for i in range(60) for v in groups.values() if i < len(v)][:10]
        assert [r.k for r in sorted((r for r in got if r.cell == cell), key=lambda r: r.place)] == want
    rates = sample.copy_rates(spark.createDataFrame([("a-hi", "hi", True)] * 3 + [("a-hi", "hi", False)] * 5, "office string, lang string, google_copy boolean"))
    assert sample.rate_lines(rates).first()["line"] == f"{'a-hi':<24} {'hi':<5} {'3/8':>9}    38%  14-69"


def test_reports(spark):
    row = lambda month, office, lang, copy: (month, office, lang, copy)
    rows = [row("2018-11", "kolkata-bn", "bn", False)] * 100 + [row("2025-11", "kolkata-bn", "bn", False)] * 88 + [row("2025-11", "chandigarh-pa", "hi", True)] * 5
    rows += [row("2025-11", "delhi-en", "hi", True)] * 29 + [row("2025-11", "delhi-en", "hi", False)] * 71
    lines = report.copy_lines(report.copy_table(spark.createDataFrame(rows, "month string, office string, lang string, google_copy boolean")))
    assert lines == ["| Office, language | November 2018 | November 2025 |", "| --- | --- | --- |", "| Kolkata, Bengali | 0% | 0% (of 88) |", "| Delhi's Hindi translations |  | 29% |"]
    text = report.configs(report.layout(spark.createDataFrame([("2019-07",), ("2025-11",)], "month string"), spark.createDataFrame([("ne",)], "lang string")))
    assert text.splitlines()[:5] == ["- config_name: sentences", "  default: true", "  data_files:", '    - split: "jul2019"', "      path: sentences/2019-07.parquet"]
    assert text.count("default: true") == 1 and '- split: "nov2025"\n      path: documents/2025-11.parquet' in text and "path: regional/documents/ne.parquet" in text
    found = spark.createDataFrame([("2023-11", "{}"), ("2024-11", "x"), ("2024-05", " \n"), ("2024-12", "y")], "month string, content string")
    kept = report.months_with_releases(found)
    assert [r.month for r in kept.collect()] == ["2023-11", "2024-11", "2024-12"]
    assert report.month_span(kept).first()["span"] == "November 2023 to December 2024 (3)"
    assert report.month_span(kept.limit(1)).first()["span"] == "November 2023"
    s = spark.createDataFrame([("hi", 0.9, "normal", None, 0, "2025-11"), ("mni", 0.8, "low", True, 1, "2025-11"), ("hi", 0.7, "normal", False, 2, "2025-11")], "lang string, similarity double, confidence string, google_copy boolean, ord int, month string")
    d = spark.createDataFrame([("hi", "1", "2025-11"), ("ta", "1", "2025-11")], "lang string, en_prid string, month string")
    table = [r.line for r in report.language_table(report.month_stats(s, d)).orderBy("rank").collect()]
    assert table == ["| Hindi | `hi` | 2 | 1 | 1 |", "| Manipuri (low confidence) | `mni` | 1 | 0 | 0 |", "| Tamil | `ta` | 0 | 0 | 1 |", "| **All** | | **3** | **1** | **2** |"]
    copies = spark.createDataFrame([("2025-11", "delhi-en", "hi", True)], "month string, office string, lang string, google_copy boolean")
    text = report.card("{{total_pairs}} {{size}} {{known}}/{{known_copies}} {{months}} {{languages_yaml}} {{first_split}}", s, d, copies)
    assert "3 10K<n<100K 2/1" in text and "| `nov2025` | November 2025 | 3 | 2 | 1 |" in text and "- en\n- hi\n- mni\n- ta nov2025" in text
    section = report.regional_section(report.month_stats(s, d), spark.createDataFrame([("hi", "May 2020")], "lang string, span string"), copies.select("lang", "google_copy"))
    assert [r.line for r in section.collect()][0] == "| Hindi | `hi` | 2 | 1 | 1 | May 2020 | 100% (of 1) |"
    leaky = spark.createDataFrame([("en", "call 9827170170", None), ("hi", "fine", "a@b.gov.in")], "lang string, a string, b string")
    with pytest.raises(ValueError, match="2 signs"):
        report.audit({"t": (leaky, ["a", "b"])})
    report.audit({"t": (leaky, ["lang"])})


def test_plans(spark):
    planned = months.plan(spark)
    assert planned.count() == 45 + 45 + 2 + 93
    assert months.plan_for(planned).where("lang = 'mni'").count() == 0 and months.plan_for(planned, "mni", "2019-01", "2019-03").count() == 3 and months.plan_for(planned, "mni").count() == 0
    done = spark.createDataFrame([("2023-11",)], "month string")
    assert months.to_do(months.plan_for(planned, "gom", "2000-01", "2100-01"), done).collect()[0].month == "2024-11"


# ---------------------------------------------------------------- sources and runs


def test_sources(spark, tmp_path):
    for office, lines in (("b-hi", ['{"prid": "2"}', "", '{"prid": "3", "byLang": {"en": {"prid": "3"}, "hi": {"prid": "4"}}}']), ("a-hi", ['{"prid": "1"}']), ("bench", ['{"prid": "0"}'])):
        (tmp_path / "month" / office).mkdir(parents=True)
        (tmp_path / "month" / office / "pairs.jsonl").write_text("\n".join(lines) + "\n", encoding="utf-8")
    (tmp_path / "month" / "a-hi" / "other.jsonl").write_text("{}")
    got = files.release_groups(spark, str(tmp_path)).orderBy("ord").collect()
    assert [(r.prid, r.office) for r in got] == [("1", "a-hi"), ("2", "b-hi"), ("3", "b-hi")] and list(got[2].byLang) == ["en", "hi"]
    (tmp_path / "passes.tsv").write_text("# comment\na-hi\t3\t1\thi,ur\n")
    (tmp_path / "offices.tsv").write_text("3\tDesk\t2=हिन्दी; 1=English\n", encoding="utf-8")
    assert files.passes(spark, str(tmp_path / "passes.tsv")).first()["columns"] == ["hi", "ur"]
    assert files.offices(spark, str(tmp_path / "offices.tsv")).first()["langs"] == {2: "हिन्दी", 1: "English"}
    (tmp_path / "html").mkdir()
    (tmp_path / "html" / "77.html").write_text("<p>a\nb</p>")
    assert tuple(files.pages(spark, str(tmp_path / "html")).first()) == ("77", "<p>a\nb</p>")
    xml = spark.createDataFrame([("<item> <title>A &amp;amp; B</title><link>x?PRID=5</link></item>\n<item><title>C</title>PRID=6</item>",)], "value string")
    assert [tuple(r) for r in files.feed_items(xml).collect()] == [(0, "A & B", "5"), (1, "C", "6")]
    lists = spark.createDataFrame([("PressReleaseDetail.aspx?PRID=2 PressReleaseDetail.aspx?PRID=1 PressReleaseDetail.aspx?PRID=2",)], "value string")
    assert [r.prid for r in files.list_ids(lists).collect()] == ["2", "1"]
    empty = spark.createDataFrame([], schemas.SENTENCES)
    files.write_published(empty, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).schema == schemas.SENTENCES
    files.write_json_lines(spark.createDataFrame([("1", "é")], "prid string, title string"), str(tmp_path / "json"))
    written = [x for p in (tmp_path / "json").glob("part-*") for x in p.read_text(encoding="utf-8").splitlines()]
    assert [json.loads(x) for x in written] == [{"prid": "1", "title": "é"}] and "é" in written[0]
    assert files.saved_list(spark, str(tmp_path / "json")).first()["prid"] == "1"


def test_publish_runs_and_the_audit_stops_it(spark, tmp_path):
    long = "This sentence is long enough to be sampled for the check. "
    rows = [("g1", "05 NOV 2018 by Desk", "M", {"en": doc("1", "T one", long), "lus": doc("2", "T one", long)}, "a-lus", 0)]
    groups = spark.createDataFrame(rows, GROUP)
    store, cache = spark.createDataFrame([], schemas.VECTOR), spark.createDataFrame([("en", "lus", long.strip(), long)], schemas.TRANSLATION)
    out = publish(spark, groups, store, "m", vectors.hashed_encoder(), cache, str(tmp_path / "a"))
    assert {r.en: r.google_copy for r in out["sentences"].collect()} == {"T one": None, long.strip(): True} and out["documents"].count() == 1
    leaky = spark.createDataFrame([("g1", "", "M", {"en": doc("1", "Call 9827170170"), "lus": doc("2", "Call 9827170170")}, "a-lus", 0)], GROUP)
    with pytest.raises(ValueError, match="contact detail"):
        publish(spark, leaky, store, "m", vectors.hashed_encoder(), cache, str(tmp_path / "b"))
    assert sorted(x.name for x in (tmp_path / "b").iterdir()) == ["draft", "vectors"]
    held = spark.read.parquet(str(tmp_path / "a" / "vectors"))
    texts = spark.createDataFrame([(long.strip(),), ("T one",), ("unseen",)], "text string")
    assert [r.text for r in vectors.missing(texts, held, "m").collect()] == ["unseen"]


def test_split_texts_are_read_few_times(spark, tmp_path):
    """The splitter is Python: with a table kept after it, the plan of the pairs has none of it, without one three."""
    groups = spark.createDataFrame(ROWS, GROUP)
    store = vectors.encode(spark.createDataFrame([("k", "x")], "k string, text string"), "m", vectors.hashed_encoder()).persist()
    plan = lambda **how: align.sentence_pairs(groups, store, "m", **how)._jdf.queryExecution().optimizedPlan().toString()
    assert plan().count("ArrowEvalPython") <= 4 and "row_number" not in plan()

    def keep(df, name):
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    assert "ArrowEvalPython" not in plan(keep=keep)
    assert spark.range(1).select(files.release_url(F.lit("7"), "https://x")).first()[0] == "https://x/PressReleaseIframePage.aspx?PRID=7&reg=3&lang=1"


def test_ties_of_skips_and_long_rows():
    rng = np.random.default_rng(3)
    for _ in range(60):
        n, m = rng.integers(1, 9, 2)
        s, s2, t, t2 = (rng.choice([0.0, 0.5, 1.0, -0.5], size=(max(k, 0), 2)).astype(np.float32) for k in (n, n - 1, m, m - 1))
        found = align.align(s, s2, t, t2)
        score = sum(x[4] for x in found) + align.SKIP * (n - sum(x[1] for x in found) + m - sum(x[3] for x in found))
        assert abs(score - plain_alignment(s, s2, t, t2)) < 1e-9


def test_ingest_reads_each_page_once(spark, tmp_path):
    df = spark.createDataFrame([("1", page("T", "<p>Body</p>")), ("1", page("T", "<p>Body</p>"))], schemas.PAGE)
    for _ in range(2):
        df.write.mode("append").parquet(str(tmp_path / "in"))
        ingest(page_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert [r.body for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["Body"]


def test_budget_gate_knows_cached_texts_in_every_language(spark, tmp_path):
    from bitloom.queries import QUERIES

    rows = [(f"l{k}", "cached") for k in range(1_200)] + [(None, "cached"), ("l1", "new"), ("l1", "new"), ("l2", "new")]
    spark.createDataFrame(rows, "lang string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "cached")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert QUERIES["budget_gate"](spark, str(tmp_path)).first()["cost"] == 6
