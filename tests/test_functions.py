import pytest
from bitloom.functions import text as T
from bitloom.functions.numbers import numbers, numbers_agree
from bitloom.functions.score import chrf, is_copy, one_place, wilson
from bitloom.functions.split import sentences_of
from pyspark.sql import functions as F


def apply(spark, f, values):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, a string")
    return [r[0] for r in df.orderBy("k").select(f(F.col("a"))).collect()]


REDACTED = [
    ("+ 91-11-20907757 call", "<phone> call"), ("no. -23000761 +91-40 here", "no. <phone> here"), ("call 1-800-891-4416 today", "call <phone> today"),
    ("to adv.ca@trai. gov.in or", "to <email> or"), ("email rm.kl.@indiapost.gov.in x", "email <email> x"), ("( csm-x [at] nic [dot] in )", "( <email> )"),
    ("jsseeds-agri [at]gov[dot]in x", "<email> x"), ("a@b.gov.in. Next sentence.", "<email>. Next sentence."), ("74283-21144", "<phone>"), ("৭২১৭৭৩৫৩৭২", "<phone>"),
    ("Phone: + 91.40.3086 6419", "Phone: <phone>"), ("+91-11- 20907774.", "<phone>."), (":+ ৯১ - ১১ - ২৬৮৪৮৯১৭ (", ":<phone> ("), ("+ 91 (22) 6665 8282 x", "<phone> x"),
    ("+91-11-23210481ರಲ್ಲಿ", "<phone>ರಲ್ಲಿ"), ("INFO@PIX.GOV.IN. THE", "<email>. THE"), ("advfea২@trai.gov.in", "<email>"), ("ddg1[dot]nad[at]mospi[dot]gov[dot]in today", "<email> today"),
    ("App id6739700695, report MPR011020257F52BD, Rs 1,00,00,000 crore, 29.10.2025, year 2047.",) * 2, ("Call 7827170170, 1800-180-1503, (080-4611 0007)", "Call <phone>, <phone>, (<phone>)"),
]


def test_redaction_and_audit(spark):
    assert apply(spark, T.redact, [a for a, _ in REDACTED]) == [b for _, b in REDACTED]
    assert not any(apply(spark, T.leaks, [b for _, b in REDACTED[:-2]]))
    leaky = ["TRAI + 91-11-20907757", "-23000761 +91-40", "adv.ca@trai. gov.in", "( csm-upsc [at] nic [dot] in )", "৯৮২৭১৭০১৭০", "011-23385271"]
    assert all(apply(spark, T.leaks, leaky))
    clean = ["<email> <phone>", "@Some_Goa, @Other", "General 21741389   183725535263", "https://doi.org/10.1016/S0140-6736(21)02143-7", "Bharat @2047.", "kits @ Rs. 500", "by @handle. The", None]
    assert not any(apply(spark, T.leaks, clean))


def test_datelines(spark):
    lines = ["05 NOV 2018 2:20PM by Press Bengaluru", "", "5 NOV 2018", "05 Nov 2018", "05 XXX 2018 by A", None, " 31 FEB 2020 by  B "]
    got = [tuple(r) for r in apply(spark, T.posted, lines)]
    assert got == [("2018-11-05", "Press Bengaluru"), ("", ""), ("2018-11-05", ""), ("", ""), ("", ""), ("", ""), ("2020-02-31", "B")]
    assert apply(spark, T.clean_dateline, ["Posted On:  28 NOV\xa02025 6:07PM", "28 NOV 2025 6:07PM"]) == ["28 NOV 2025 6:07PM", "07PM"]


def test_settled(spark):
    page = '<div id="PrDateTime">Posted On: 04 OCT 2026 6:07PM</div>'
    df = spark.createDataFrame([(page, "2026-10-06 12:00:00"), (page, "2026-10-12 12:00:00"), ("x", "2026-10-12 12:00:00"), (page, "2026-10-11 00:00:00"), (page, "2026-10-10 23:59:59")], "h string, t string")
    assert [r[0] for r in df.select(T.settled(F.col("h"), F.col("t").cast("timestamp"))).collect()] == [False, True, True, True, False]


def test_scripts(spark):
    rows = [("hi", "भारत ab", True), ("hi", "abcdef भा", False), ("en", "123", False), ("doi", "x", None), ("en", "Élan", True), ("pa", "।", False)]
    df = spark.createDataFrame(rows, "l string, t string, w boolean")
    assert [r[0] for r in df.select(T.in_script(F.col("l"), F.col("t"))).collect()] == [w for *_, w in rows]


def test_labels(spark):
    df = spark.range(1)
    one = lambda c: df.select(c).first()[0]
    assert one(T.split_name(F.lit("2025-11"))) == "nov2025" and one(T.month_label(F.lit("2018-05"))) == "May 2018"
    assert one(T.office_label(F.lit("new-town-hi"))) == "New Town, Hindi" and one(T.office_label(F.lit("x-zz"))) == "X, zz"
    assert [one(T.rate(F.lit(k), F.lit(n))) for k, n in ((0, 88), (29, 100), (1, 8), (3, 8), (1, 200))] == ["0% (of 88)", "29%", "12% (of 8)", "38% (of 8)", "0%"]
    assert one(T.ascii_digits(F.lit("২๓𝟗"))) == "239"


def test_numbers(spark):
    texts = ["Rs 4,500 on 28 November 2025", "६.३ लाख", "6.3 million", "63 lakh", "1.1 lakh", "0.5 3.25 12345678.5", "", None, "5crore, 2 lakhs", "0.00005"]
    assert apply(spark, numbers, texts) == [["2025", "28", "4500"], ["630000"], ["6300000"], ["6300000"], ["110000.0"], ["0.5", "12345678.5", "3.25"], [], [], ["200000", "50000000"], ["5e-05"]]
    df = spark.createDataFrame([("5 6", "6 5 5", True), ("5", "6", False), ("a", "b", None), ("5", "b", False)], "a string, b string, w boolean")
    assert [r[0] for r in df.select(numbers_agree(numbers(F.col("a")), numbers(F.col("b")))).collect()] == [True, False, None, False]


def test_long_numbers_keep_every_digit(spark):
    texts = ["4879548823211410", "1152921504606846976", "909955422195631329054", "9223372036854775807", "9" * 36]
    assert apply(spark, numbers, texts) == [[str(int(float(t)))] for t in texts]


def test_numbers_as_sql_has_them(spark, tmp_path):
    """Words that begin like a scale word, long numbers, other digits and halves of a millionth, against the query's own SQL."""
    import duckdb
    from bitloom.queries import QUERIES, SQL

    texts = ["247.72 lacionta, 5 lakh 6 Millionen", "909955422195631329054 1152921504606846976", "५ 5५6", "37313329466.866 0.00001 5.0000001 0.0000005 2.50", "", None, "1,234.5 007"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = sorted(con.execute(SQL["numbers_plain"]).fetchall())
    assert sorted(map(tuple, QUERIES["numbers_plain"](spark, str(tmp_path)).collect())) == want


@pytest.mark.parametrize(
    "text, n",
    [
        ("Dr. Rao met A. Kumar. He spoke etc. and left. (Dr. Rao stayed.) Yes", 3), ("It grew 17.92. In 2025 it fell. 29.10.2025. Next", 4), ("कि.मी. दूर है. अगला वाक्य", 2),
        ("ਪਹਿਲਾ ਵਾਕ। ਦੂਜਾ ਵਾਕ। ਡਾ. ਸਿੰਘ", 3), ("What?! Yes... No", 3), ("Dr.\nRao came", 1), ("one\n\ntwo\n-\n", 2), ("", 0), (None, 0), ("एल. मुरुगन आहे. पुढे", 2), ("H.E. the envoy. x", 1),
    ],
)
def test_sentences(text, n):
    assert len(sentences_of(text)) == n


def test_a_batch_is_split_a_few_texts_at_a_time():
    """Python's own memory does not grow with the batch."""
    import tracemalloc

    import pyarrow as pa
    from bitloom.functions.split import sentences

    def peak(n):
        texts = pa.array(["One two three. Four five six.\nSeven eight. " * 100, None, ""] * n)
        tracemalloc.start()
        found = sentences.func(texts)
        top = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(found) == 3 * n and found[0].as_py() == ["One two three.", "Four five six.", "Seven eight."] * 100 and found[1].as_py() == found[2].as_py() == []
        return top

    assert peak(2000) < 2 * peak(20) + 500_000
    assert len(sentences.func(pa.array([], pa.string()))) == 0


def test_chrf_and_wilson(spark):
    df = spark.createDataFrame([("the cat sat on the mat", "the cat sat on the mat"), ("abc", ""), (None, "abc"), ("ab", "ba"), ("the cat", "a dog ran")], "a string, b string")
    got = [r[0] for r in df.select(chrf("a", "b")).collect()]
    assert got[:3] == [100.0, 0.0, 0.0] and got[3] == 50.0 and 0 < got[4] < 30
    assert df.select(is_copy(F.lit(90.0)), one_place(F.lit(2.25))).first()[:] == (True, 2.3)
    lo, hi = spark.range(1).select(wilson(F.lit(45), F.lit(200)).alias("w")).first()["w"]
    assert (round(lo, 2), round(hi, 2)) == (17.26, 28.77)
    assert tuple(spark.range(1).select(wilson(F.lit(0), F.lit(0)).alias("w")).first()["w"]) == (0.0, 0.0)


def test_sql_names(spark):
    from bitloom.functions.register import register

    assert register(spark) == ["redact", "ascii_digits", "in_script", "sentences", "chrf"]
    row = spark.sql("SELECT redact('to a@b.gov.in, 7827170170') AS r, ascii_digits('২3') AS d, in_script('hi', 'भारत') AS s, in_script('zz', 'x') AS u, sentences('One. Two.') AS p, chrf('ab', 'ab') AS c").first()
    assert tuple(row) == ("to <email>, <phone>", "23", True, None, ["One.", "Two."], 100.0)
