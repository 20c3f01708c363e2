"""License scans: notices as templates, found by an exact set-similarity join.

Template tokens are ordered by how many documents of the corpus hold them,
rarest first.  A block of text that holds a template to the threshold must hold
one of the template's first |T| - need + 1 tokens in that order (prefix filter),
have enough template tokens at all (length filter), and enough of them left from
the matching token on (positional filter).  What passes is verified exactly.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .line_dedup import ascii_lower
from .spill import row_key

# Labels, their families, and notices as they usually stand.
TEMPLATES = [
    ("mit", "mit", "released under the mit license"),
    ("mit", "mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "apache", "licensed under the apache license version 2 0"),
    ("cc-by-nc", "cc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "cc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by", "cc", "licensed under cc by 4 0"),
    ("cc-by", "cc", "licensed under a creative commons attribution 4 0 international license"),
    ("gpl-3", "gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl-2", "gpl", "this work is licensed under the gnu general public license version 2"),
    ("bsd", "bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
]
PHRASES = [("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")]


_APART = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"  # what stands between words, before A-Z are lower-cased


def _let(c: Column, body) -> Column:
    """body(c) with c computed once; inside a lambda function it would be computed for each element."""
    return F.transform(F.array(c), body)[0]


def count_words(text: Column) -> Column:
    """How many words a text has; lower-casing would not change it."""
    ends = lambda a: F.size(a) - (a[0] == "").cast("int") - ((F.size(a) > 1) & (F.element_at(a, -1) == "")).cast("int")
    return _let(F.split(text, f"{_APART}+", -1), ends)


def _holds(lowered: Column, phrases: list[str]) -> Column:
    """Whether a text lower-cased by lower() may hold one of the phrases.

    lower() is faster than ascii_lower() and changes no word that is all ASCII,
    so no text is missed; what else it lets through is sorted out exactly later.
    """
    forms = "|".join(sorted({p.replace(" ", f"{_APART}+") for p in phrases}))
    return lowered.rlike(f"(?:^|{_APART})(?:{forms})(?:{_APART}|$)")


def normalised(text: Column) -> Column:
    r"""The words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of the text with A-Z lower-cased, one space apart."""
    return F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))


def _words(norm: Column) -> Column:
    return F.when(norm == "", F.array().cast("array<string>")).otherwise(F.split(norm, " "))


def _strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>")


SHORT, MANY = 64, 200  # the least window, in words; how many tokens are looked for by one pattern


def window_of(text: str) -> int:
    """Words in the windows that a template is looked for in: twice its own at least, in powers of two."""
    return max(SHORT, 1 << (2 * len(text.split()) - 1).bit_length())


def _found(rows: DataFrame, templates: list[tuple[str, str, str]], rank: dict[str, int], threshold: float, window: int, every: bool) -> DataFrame:
    """(_k1, _k2, label, score) of the templates that windows of the rows' texts hold; see license_scan()."""
    sets = [(label, family, list(dict.fromkeys(text.split()))) for label, family, text in templates]
    order = sorted({t for *_, tokens in sets for t in tokens}, key=rank.get)
    index = []
    beside = [set(zip(text.split(), text.split()[1:])) for *_, text in templates]
    # For each template the numbers of those of its family that have all its tokens and more, and the pairs that tell it from them.
    kin: dict[str, list[int]] = {}
    for b, (_, family, _) in enumerate(sets):
        kin.setdefault(family, []).append(b)
    over = [[(b, sorted(map(" ".join, beside[a] - beside[b]))) for b in kin[family] if set(tokens) < set(sets[b][2])] for a, (_, family, tokens) in enumerate(sets)]
    telling = sorted({p for x in over for _, pairs in x for p in pairs}) if every else []
    for a, (label, family, tokens) in enumerate(sets):
        tokens, need = sorted(tokens, key=rank.get), math.ceil(threshold * len(tokens) - 1e-9)
        index += [(t, label, family, tokens, need, j, a, over[a]) for j, t in enumerate(tokens[: len(tokens) - need + 1])]
    schema = "token string, label string, family string, tokens array<string>, need int, j int, number int, over array<struct<number:int,pairs:array<string>>>"
    index_df = rows.sparkSession.createDataFrame(index, schema)
    if sum(len(x[3]) for x in index) <= 100_000:  # some MB
        index_df = F.broadcast(index_df)

    first = sorted({t[0] for t in index})
    held = _holds(F.col("low"), first) if len(first) <= MANY else F.arrays_overlap(F.split("low", f"{_APART}+", -1), _strings(first))
    near = rows.where(held).select("_k1", "_k2", "text").distinct()
    step = window // 2

    def windows(words: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(words) - step, F.lit(1)), F.lit(step))
        own = lambda i: F.array_intersect(_strings(order), F.slice(words, i, window))
        line = lambda i: F.concat(F.lit(" "), F.array_join(F.slice(words, i, window), " "), F.lit(" "))
        stand = lambda i: _let(line(i), lambda x: F.filter(_strings(telling), lambda p: x.contains(F.concat(F.lit(" "), p, F.lit(" ")))))
        return F.transform(starts, lambda i: F.struct(own(i).alias("own"), (stand(i) if telling else _strings([])).alias("stand")))

    cut = _let(normalised(F.col("text")), lambda norm: _let(_words(norm), windows))
    blocks = near.select("_k1", "_k2", F.posexplode(cut).alias("block", "cut")).select("_k1", "_k2", "block", "cut.own", "cut.stand")
    probes = blocks.select("_k1", "_k2", "block", "own", "stand", F.posexplode("own").alias("i", "token"))
    pairs = probes.join(index_df, "token")
    left = 1 + F.least(F.size("own") - F.col("i") - 1, F.size("tokens") - F.col("j") - 1)
    pairs = pairs.where((F.size("own") >= F.col("need")) & (left >= F.col("need")))
    shared = F.size(F.array_intersect("own", "tokens"))
    hit = F.struct((shared / F.size("tokens")).alias("score"), F.size("tokens").alias("n"), "label").alias("hit")
    found = pairs.where(shared >= F.col("need")).select("_k1", "_k2", "block", "family", hit, "stand", F.struct("number", "label", "over").alias("template"))
    best = found.groupBy("_k1", "_k2", "block", "family")
    if every:
        full = F.collect_set(F.when(F.col("hit.score") == 1.0, F.col("template")))
        best = best.agg(F.max("hit").alias("hit"), F.first("stand").alias("stand"), full.alias("full")).withColumn("numbers", F.transform("full", lambda t: t["number"]))
        apart = lambda o: ~F.array_contains("numbers", o["number"]) | (F.size(F.array_except(o["pairs"], "stand")) == 0)
        more = F.transform(F.filter("full", lambda t: F.forall(t["over"], apart)), lambda t: t["label"])
        best = best.select("_k1", "_k2", "hit", F.explode(F.array_union(F.array("hit.label"), more)).alias("label"))
    else:
        best = best.agg(F.max("hit").alias("hit")).select("_k1", "_k2", "hit", "hit.label")
    return best.select("_k1", "_k2", "label", F.col("hit.score").alias("score"))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=tuple(TEMPLATES), phrases=tuple(PHRASES), threshold: float = 0.85, every: bool = False) -> DataFrame:
    """Rows of (id, n_words, n_base, first_word, last_word, base_labels, labels, score), one for each row of docs.

    Blocks are windows of at least 64 words and twice a template's, each half
    over the next, so a notice lies whole in one; together they cover the text.
    Templates are any number of (label, family, words) of any length; those of
    one window size are searched together.  A template is found in a block that
    holds ``threshold`` of its distinct tokens or more; of one family and window
    size the best found in a block counts (the greater share, then the longer
    template); with ``every`` also all that it holds to the last token, but for
    those whose tokens are a part of another such one's, unless their own pairs
    of neighbouring words, which that one lacks, stand there too (none: they
    count).  ``labels`` joins the found ones and those of phrases whose words
    stand consecutively (``base_labels``, n_base places, first_word, last_word:
    their smallest and largest word position, else null).  ``score``: the
    greatest share found, 1 where a phrase stands, else 0.

    Null and empty texts have no words and no labels; repeated rows and null ids
    are rows like any other; other columns are ignored.  The templates are the
    caller's list, so they fit the driver; from about 100,000 tokens in all on
    their index is joined by a shuffle instead of broadcast.
    """
    k1, k2 = row_key("id", "text")
    templates = [t for t in templates if t[2].split()]
    vocabulary = sorted({t for *_, words in templates for t in words.split()})
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).select("id", k1, k2, text.alias("text"), F.lower(text).alias("low"))

    # Counted on lower(): the order decides what is looked at first, not what is found.
    held = rows.select(F.explode(F.array_intersect(_strings(vocabulary), F.split("low", f"{_APART}+", -1))).alias("token")).groupBy("token").count()
    often = {r["token"]: r["count"] for r in held.collect()}
    rank = {t: k for k, t in enumerate(sorted(vocabulary, key=lambda t: (often.get(t, 0), t)))}
    sizes: dict[int, list] = {}
    for t in templates:
        sizes.setdefault(window_of(t[2]), []).append(t)
    best = None
    for window, some in sorted(sizes.items()):
        part = _found(rows, some, rank, threshold, window, every)
        best = part if best is None else best.unionByName(part)
    if best is None:
        best = rows.sparkSession.createDataFrame([], "_k1 long, _k2 long, label string, score double")
    own = best.groupBy("_k1", "_k2").agg(F.collect_set("label").alias("more"), F.max("score").alias("share"))

    def places(norm: Column) -> Column:
        """For each phrase the places where its words stand."""

        def at(p: list[str], words: Column) -> Column:
            first = F.filter(F.sequence(F.lit(0), F.greatest(F.size(words) - len(p), F.lit(0))), lambda i: F.slice(words, i + 1, len(p)) == _strings(p))
            return F.when(F.concat(F.lit(" "), norm, F.lit(" ")).contains(f" {' '.join(p)} "), first).otherwise(F.array().cast("array<int>"))

        return _let(F.split(norm, " "), lambda words: F.array(*(at(phrase.split(), words) for _, phrase in phrases)))

    nowhere = F.array(*(F.array().cast("array<int>") for _ in phrases))
    found_at = F.when(_holds(F.col("low"), [p for _, p in phrases]), _let(normalised(F.col("text")), places)).otherwise(nowhere)
    names = _strings([label for label, _ in phrases])
    based = rows.select("id", "_k1", "_k2", count_words(F.col("text")).cast("long").alias("n_words"), found_at.alias("places")).select(
        "id", "_k1", "_k2", "n_words", F.flatten("places").alias("at"),
        F.array_distinct(F.filter(F.transform("places", lambda x, k: F.when(F.size(x) > 0, F.element_at(names, k + 1))), lambda x: x.isNotNull())).alias("base"),
    )
    none = F.array().cast("array<string>")
    return based.join(own, ["_k1", "_k2"], "left").select(
        F.col("id").alias(id_col),
        "n_words",
        F.size("at").cast("long").alias("n_base"),
        F.array_min("at").cast("long").alias("first_word"),
        F.array_max("at").cast("long").alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", none))), ",").alias("labels"),
        F.when(F.size("at") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
