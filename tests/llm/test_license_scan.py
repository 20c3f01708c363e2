import math
import random
import re

from bitloom.llm.license_scan import PHRASES, TEMPLATES, license_scan


def brute(text, threshold=0.85, window=64):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at, base = [], set()
    for label, phrase in PHRASES:
        p = phrase.split()
        hits = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        at += hits
        base |= {label} if hits else set()
    labels, score = set(base), 1.0 if at else 0.0
    for i in range(0, max(len(w) - window // 2, 1), window // 2):
        best = {}
        for label, family, t in TEMPLATES:
            t = set(t.split())
            share = len(t & set(w[i : i + window])) / len(t)
            if share * len(t) >= math.ceil(threshold * len(t) - 1e-9):
                best[family] = max(best.get(family, (0, 0, "")), (share, len(t), label))
        for share, _, label in best.values():
            labels.add(label)
            score = max(score, share)
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), round(score, 9)


def test_against_brute_force(spark):
    rng = random.Random(2)
    some = ["the", "of", "license", "under", "2", "cc", "by", "nc", "Ünï", "x", "apache", "version", "MIT"]
    notices = [t for *_, t in TEMPLATES] + [p for _, p in PHRASES]
    texts = [None, "", "  \n", "Released under the MIT License.", "Licensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0.", "licensed under cc by 4.0", "the mit license"]
    for _ in range(150):
        w = [rng.choice(some) for _ in range(rng.choice([3, 40, 400]))]
        for _ in range(rng.randrange(3)):
            notice = rng.choice(notices).upper().split()
            if rng.random() < 0.5:
                notice.pop(rng.randrange(len(notice)))
            k = rng.randrange(len(w) + 1)
            w[k:k] = notice
        texts.append(rng.choice([" ", "\n", ", "]).join(w))
    texts.append("word " * 20_000 + "Released under the MIT License")
    texts += texts[:5]
    rows = [(None if k == 5 else k, t, "extra") for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, labels string")
    got = sorted((str(r[0]), *map(str, r[1:-1]), str(round(r[-1], 9))) for r in license_scan(df).collect())
    assert got == sorted((str(i), *map(str, brute(t))) for i, t, _ in rows)
    assert license_scan(df.limit(0)).count() == 0


def test_query_finds_every_notice_of_a_family(spark, tmp_path):
    from bitloom.llm.queries import op3_license_scan

    gpl, cc = "This work is licensed under the GNU General Public License version", "licensed under a Creative Commons Attribution"
    texts = {
        f"{gpl} 2. {gpl} 3.": "gpl-2,gpl-3",
        f"{gpl} 3": "gpl-3",
        "Licensed under CC BY 4.0 and CC BY-NC 4.0": "cc-by,cc-by-nc",
        "Licensed under CC BY-NC 4.0, code licensed under CC BY 4.0": "cc-by,cc-by-nc",
        "Licensed under CC BY-NC 4.0 or CC BY 4.0": "cc-by,cc-by-nc",
        "Licensed under CC BY-NC 4.0": "cc-by-nc",
        f"{cc} NonCommercial 4.0 International License": "cc-by-nc",
        f"{cc} NonCommercial 4.0 International License\n{cc} 4.0 International License": "cc-by,cc-by-nc",
        f"{cc} 4.0 International License": "cc-by",
        "nothing here": "",
    }
    spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.labels for r in op3_license_scan(spark, str(tmp_path)).collect()}
    assert got == dict(enumerate(texts.values()))


def test_many_and_long_templates(spark):
    """A thousand notices of 200 words over 3,000 tokens, and one of two words; each found where it stands, or 90 % of it, and nowhere else."""
    rng = random.Random(4)
    words = [f"t{k}" for k in range(3_000)]
    templates = [(f"l{k}", f"f{k}", " ".join(rng.sample(words, 200))) for k in range(1_000)] + [("two", "two", "public domain"), ("none", "none", "")]
    plain = lambda n: [f"w{rng.randrange(50)}" for _ in range(n)]
    texts, want = [], []
    for k in (0, 17, 999):
        notice = templates[k][2].split()
        texts.append(" ".join(plain(333) + notice + plain(70)))
        want.append(f"l{k}")
        part = [w for j, w in enumerate(notice) if j % 10]
        texts.append("\n".join(plain(70) + part))
        want.append(f"l{k}")
        texts.append(" ".join(notice[:150] + plain(400)))
        want.append("")
    texts += ["Public Domain", " ".join(templates[3][2].split() + plain(300) + templates[4][2].split() + ["public", "domain"]), None]
    want += ["two", "l3,l4,two", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.labels for r in license_scan(df, templates=templates, phrases=[("x", "no such phrase")]).collect()}
    assert got == dict(enumerate(want))
    none = license_scan(df, templates=[]).collect()
    assert {r.labels for r in none} == {""} and len(none) == len(texts)
