"""Statistics of the published tables, the audit gate, and the Markdown report."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import language_name, leaks, month_label, office_label, rate, size_category, split_name
from ..languages import MONTH_NAMES


def month_stats(sentences: DataFrame, documents: DataFrame, by: list[str] | None = None) -> DataFrame:
    """For each language (and each of ``by``, say month): n, high (similarity of 0.85 or more), docs, low (the last row's confidence).

    sentences: lang, similarity, confidence, ord; documents: lang.  Languages
    that only one of them holds have zeros of the other.
    """
    keys = [*(by or []), "lang"]
    s = sentences.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(F.col("similarity") >= 0.85).alias("high"), F.max_by(F.col("confidence") == "low", "ord").alias("low"), F.min("ord").alias("first"))
    d = documents.groupBy(*keys).agg(F.count("*").alias("docs"))
    return s.join(d, keys, "full").select(*keys, *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "high", "docs")), F.coalesce("low", F.lit(False)).alias("low"), "first")


def month_totals(sentences: DataFrame, documents: DataFrame, by: list[str] | None = None) -> DataFrame:
    """For each of ``by`` (or one row): pairs, high, docs, releases (distinct English ones), known and copies of the sample."""
    keys = by or []
    s = sentences.groupBy(*keys).agg(
        F.count("*").alias("pairs"), F.count_if(F.col("similarity") >= 0.85).alias("high"), F.count("google_copy").alias("known"), F.count_if("google_copy").alias("copies")
    )
    d = documents.groupBy(*keys).agg(F.count("*").alias("docs"), F.count_distinct("en_prid").alias("releases"))
    both = s.join(d, keys, "full") if keys else s.crossJoin(d)  # one row each
    return both.select(*keys, *(F.coalesce(c, F.lit(0)).alias(c) for c in ("pairs", "high", "docs", "releases", "known", "copies")))


def language_table(stats: DataFrame) -> DataFrame:
    """Ranked rows (rank, line) of a language table, most pairs first, first seen before later; the last is the total."""
    thousands = lambda c: F.format_number(c, 0)
    name = F.concat(language_name(F.col("lang")), F.when(F.col("low"), " (low confidence)").otherwise(""))
    line = F.concat(F.lit("| "), name, F.lit(" | `"), F.col("lang"), F.lit("` | "), thousands("n"), F.lit(" | "), thousands("high"), F.lit(" | "), thousands("docs"), F.lit(" |"))
    rows = stats.select(F.struct(-F.col("n"), F.col("first").isNull(), "first", "lang").alias("o"), line.alias("line"))
    ranked = rows.agg(F.array_sort(F.collect_list(F.struct("o", "line"))).alias("rows")).select(F.posexplode("rows").alias("rank", "r")).select("rank", "r.line")
    bold = lambda c: F.concat(F.lit("**"), thousands(F.coalesce(F.sum(c), F.lit(0))), F.lit("**"))
    total = F.concat(F.lit("| **All** | | "), bold("n"), F.lit(" | "), bold("high"), F.lit(" | "), bold("docs"), F.lit(" |"))
    return ranked.unionByName(stats.agg(F.lit(2**31 - 1).alias("rank"), total.alias("line")))


def copy_table(copies: DataFrame, hub: str = "delhi-en") -> DataFrame:
    """One row for each regional office's own language, then for each of the hub's: by_hub, key, name, and a column of rates for each month.

    copies: month, office, lang, google_copy.  A regional office's other
    languages are left out.  Months without a sample of a row are null.
    """
    by_hub = F.col("office") == hub
    own = copies.where(by_hub | F.col("office").endswith(F.concat(F.lit("-"), F.col("lang"))))
    keyed = own.select("month", by_hub.alias("by_hub"), F.when(by_hub, F.col("lang")).otherwise(F.col("office")).alias("key"), F.col("google_copy").cast("int").alias("c"))
    cells = keyed.groupBy("by_hub", "key", "month").agg(F.sum("c").alias("k"), F.count("*").alias("n")).withColumn("cell", rate(F.col("k"), F.col("n")))
    name = F.when(F.col("by_hub"), F.concat(F.initcap(F.lit(hub.rpartition("-")[0])), F.lit("'s "), language_name(F.col("key")), F.lit(" translations"))).otherwise(office_label(F.col("key")))
    return cells.groupBy("by_hub", "key", name.alias("name")).pivot("month").agg(F.first("cell")).orderBy("by_hub", "key")


def copy_lines(table: DataFrame) -> list[str]:
    """The copy table in Markdown; as many lines as there are offices and languages."""
    months = table.columns[3:]
    label = lambda m: f"{MONTH_NAMES[int(m[5:]) - 1]} {m[:4]}"
    lines = ["| Office, language | " + " | ".join(map(label, months)) + " |", "| --- |" + " --- |" * len(months)]
    return lines + [f"| {r['name']} | " + " | ".join(r[m] or "" for m in months) + " |" for r in table.collect()]


def months_with_releases(files: DataFrame) -> DataFrame:
    """Distinct months (month) of files (month, content) with anything but white space in them."""
    return files.where(~F.col("content").rlike(r"\A\s*\z")).select("month").distinct().orderBy("month")


def month_span(months: DataFrame, by: list[str] | None = None) -> DataFrame:
    """'first to last (n)' of more than two months, else all of them."""
    gathered = months.groupBy(*(by or [])).agg(F.array_sort(F.collect_set("month")).alias("m"))
    first, last = month_label(F.element_at("m", 1)), month_label(F.element_at("m", -1))
    span = F.when(F.size("m") > 2, F.concat(first, F.lit(" to "), last, F.lit(" ("), F.size("m").cast("string"), F.lit(")")))
    return gathered.select(*(by or []), span.otherwise(F.array_join(F.transform("m", month_label), ", ")).alias("span"))


def leak_report(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Every sign of a contact detail left in the texts: (table, column, lang, leak)."""
    out = None
    for name, (df, columns) in tables.items():
        for c in columns:
            found = df.select(F.lit(name).alias("table"), F.lit(c).alias("column"), "lang", F.explode(leaks(F.col(c))).alias("leak"))
            out = found if out is None else out.unionByName(found)
    return out


def audit(tables: dict[str, tuple[DataFrame, list[str]]], show: int = 30) -> None:
    """Raise, with the first leaks, if any text holds one. The limit is on what is shown, not on what is read."""
    found = leak_report(tables)
    first = found.limit(show).collect()
    if first:
        listed = "\n  ".join(f"{r['table']}.{r['column']} [{r['lang']}] {r['leak']}" for r in first)
        raise ValueError(f"{found.count()} signs of a contact detail\n  {listed}")


def yaml_of(value, indent: int = 0) -> str:
    """Lists, dicts and scalars as block YAML; quoted strings must come quoted."""
    pad = " " * indent
    if isinstance(value, list):
        return "\n".join(f"{pad}- {yaml_of(x, indent + 2).lstrip()}" for x in value)
    if isinstance(value, dict):
        return "\n".join(f"{pad}{k}:" + (f"\n{yaml_of(v, indent + 2)}" if isinstance(v, (list, dict)) else f" {str(v).lower() if isinstance(v, bool) else v}") for k, v in value.items())
    return f"{pad}{value}"


def layout(months: DataFrame, regional: DataFrame) -> DataFrame:
    """Rows (at, config, split, path) of the published files, for months (month) and regional languages (lang); at: where the config stands."""
    part = lambda at, config, rows, split, folder, name: rows.select(
        F.lit(at).alias("at"), F.lit(config).alias("config"), split.alias("split"), F.concat(F.lit(f"{folder}/"), F.col(name), F.lit(".parquet")).alias("path")
    )
    monthly = [part(k, t, months, split_name(F.col("month")), t, "month") for k, t in enumerate(("sentences", "documents"))]
    pooled = [part(2, "regional", regional, F.col("lang"), "regional/sentences", "lang"), part(3, "regional_documents", regional, F.col("lang"), "regional/documents", "lang")]
    return monthly[0].union(monthly[1]).union(pooled[0]).union(pooled[1])


def configs(files: DataFrame) -> str:
    """The report's YAML of layout(): a config for each table, a quoted split for each file, the first config the default."""
    split = F.struct("path", F.concat(F.lit('"'), "split", F.lit('"')).alias("split"))
    grouped = files.groupBy("at", "config").agg(F.array_sort(F.collect_list(split)).alias("files")).orderBy("at").collect()
    first = lambda r: {"default": True} if r["at"] == 0 else {}
    return yaml_of([{"config_name": r["config"], **first(r), "data_files": [{"split": f["split"], "path": f["path"]} for f in r["files"]]} for r in grouped])


def regional_section(stats: DataFrame, spans: DataFrame, copies: DataFrame) -> DataFrame:
    """A line for each regional language (lang, line): stats of month_stats, spans (lang, span), copies (lang, google_copy)."""
    counted = copies.groupBy("lang").agg(F.count_if("google_copy").alias("k"), F.count("*").alias("m"))
    rows = stats.join(spans, "lang", "left").join(counted, "lang", "left")
    name = F.concat(language_name(F.col("lang")), F.when(F.col("low"), " (low confidence)").otherwise(""))
    measured = F.coalesce(F.when(F.col("m") > 0, rate(F.col("k"), F.col("m"))), F.lit("not measured"))
    cells = [name, F.concat(F.lit("`"), F.col("lang"), F.lit("`")), *(F.format_number(c, 0) for c in ("n", "high", "docs")), F.coalesce("span", F.lit("")), measured]
    return rows.select("lang", F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line")).orderBy("lang")


def month_lines(totals: DataFrame) -> DataFrame:
    """A line for each month (month, line) of month_totals by month."""
    number = lambda c: F.format_number(c, 0)
    return totals.select("month", F.format_string("| `%s` | %s | %s | %s | %s |", split_name(F.col("month")), month_label(F.col("month")), number("pairs"), number("docs"), number("releases")).alias("line"))


def month_tables(stats: DataFrame) -> DataFrame:
    """Each month's language table in Markdown (month, block): stats of month_stats by month; a row of it is small, one for each language."""
    thousands = lambda c: F.format_number(c, 0)
    name = F.concat(language_name(F.col("lang")), F.when(F.col("low"), " (low confidence)").otherwise(""))
    line = F.concat(F.lit("| "), F.concat_ws(" | ", name, F.concat(F.lit("`"), "lang", F.lit("`")), *map(thousands, ("n", "high", "docs"))), F.lit(" |"))
    order = F.struct(-F.col("n"), F.col("first").isNull(), "first", "lang").alias("o")
    bold = lambda c: F.concat(F.lit("**"), thousands(F.sum(c)), F.lit("**"))
    rows = stats.withColumns({"line": line, "o": order}).groupBy("month").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("o", "line"))), lambda r: r["line"]).alias("lines"),
        F.concat(F.lit("| **All** | | "), F.concat_ws(" | ", bold("n"), bold("high"), bold("docs")), F.lit(" |")).alias("all"),
    )
    head = F.concat(F.lit("### "), month_label(F.col("month")), F.lit(f"\n\n{LANGUAGE_HEAD}\n"))
    return rows.select("month", F.concat(head, F.array_join("lines", "\n"), F.lit("\n"), "all").alias("block"))


# The tables' heads
LANGUAGE_HEAD = "| Language | Code | Sentence pairs | Similarity ≥ 0.85 | Document pairs |\n| --- | --- | --- | --- | --- |"
MONTH_HEAD = "| Split | Month | Sentence pairs | Document pairs | English releases |\n| --- | --- | --- | --- | --- |"


def card(template: str, sentences: DataFrame, documents: DataFrame, copies: DataFrame, regional: str = "", regional_langs: list[str] = ()) -> str:
    """The template with its {{fills}}: sentences and documents of all months, with a column month, and the copies samples.

    Lines and sums are made where the rows are; one row of sums and one line a month and language reach the driver.  An unknown fill stays.
    """
    spark = sentences.sparkSession
    totals, stats = month_totals(sentences, documents, ["month"]), month_stats(sentences, documents, ["month"])
    number = lambda c: F.format_number(F.coalesce(F.sum(c), F.lit(0)), 0)
    months = F.count("*")
    sums = totals.agg(
        number("pairs").alias("total_pairs"), number("docs").alias("total_docs"), number("known").alias("known"), number("copies").alias("known_copies"),
        size_category(F.coalesce(F.sum("pairs"), F.lit(0))).alias("size"), F.coalesce(split_name(F.max("month")), F.lit("")).alias("first_split"),
        F.concat(months.cast("string"), F.when(months == 1, " month").otherwise(" months")).alias("month_count"),
    )
    langs = [r["lang"] for r in stats.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").collect()]
    known = spark.createDataFrame([(x,) for x in regional_langs], "lang string")
    fills = sums.first().asDict() | {
        "configs": configs(layout(totals.select("month"), known)), "regional": regional, "languages_yaml": yaml_of(["en", *langs]), "languages_count": str(len(langs)),
        "months": "\n".join([MONTH_HEAD, *(r["line"] for r in month_lines(totals).orderBy("month").collect())]), "copies": "\n".join(copy_lines(copy_table(copies))),
        "per_month": "\n\n".join(r["block"] for r in month_tables(stats).orderBy(F.desc("month")).collect()),
    }
    return re.sub(r"\{\{(\w+)\}\}", lambda m: fills.get(m[1], m[0]), template)
