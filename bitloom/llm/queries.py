"""One thin query for each operator over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import find_items
from .html_extract import html_extract
from .license_scan import PHRASES, TEMPLATES, license_scan
from .line_dedup import line_dedup
from .ngram_join import jaccard_join
from .packing import pack
from .quality_rules import quality_rules
from .spill import materialise
from .token_counts import token_counts
from .url_filter import _NO_MARKUP, _REFRESH, url_filter
from .warc import round_trip

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"), every=True)


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths are tokens, counted once: pack() reads them several times."""
    docs = materialise(op8_token_counts(spark, sf_dir).select("doc_id", F.col("n_tokens").alias("length")), "lengths")
    return pack(docs, F.col("length")).select("doc_id", "n_tokens", "bucket", "bucket_len", "batch", "slot")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"), texts=False)
    return done.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"), RULES)


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_license_scan": op3_license_scan,
    "op4_html_extract": op4_html_extract,
    "op5_packing": op5_packing,
    "op6_decontamination": op6_decontamination,
    "op7_warc": op7_warc,
    "op8_token_counts": op8_token_counts,
    "op9_quality_rules": op9_quality_rules,
    "op10_url_filter": op10_url_filter,
}

_TEMPLATES = ", ".join(f"('{label}', '{family}', list_distinct(string_split('{text}', ' ')))" for label, family, text in TEMPLATES)
_PHRASES = ", ".join(f"('{label}', string_split('{phrase}', ' '))" for label, phrase in PHRASES)
_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"list_filter(string_split_regex({_LOW}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
_GRAMS = "list_distinct(list_transform(range(0, greatest(len(w) - 4, 1)), lambda i: array_to_string(w[i + 1 : i + 5], ' ')))"

# The same reading of links as url_filter's, in RE2 and lists.
_ENTITIES = "MAP {" + ", ".join(f"'{name[:-1]}': '{char.replace(chr(39), chr(39) * 2)}'" for name, char in html5.items() if name.endswith(";")) + "}"
_HOST = r"translate(regexp_extract({0}, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_NODE = f"CASE WHEN {_HOST} <> '' THEN {_HOST} || CASE WHEN regexp_extract({{0}}, '^.*?://[^/?#]*([^#]*)', 1, 's') = '' THEN '/' ELSE regexp_extract({{0}}, '^.*?://[^/?#]*([^#]*)', 1, 's') END END"
_VALUE = r"""(?:"([^"]*)"|''([^'']*)''|([^ \t\n\f\r>"''][^ \t\n\f\r>]*))"""
_TAG = r"""[ \t\n\f\r/](?:[ \t\n\f\r/]|[^ \t\n\f\r>/=]+(?:[ \t\n\f\r]*=[ \t\n\f\r]*""" + _VALUE.replace("(", "(?:").replace("(?:?:", "(?:") + """)?)*>"""
_ONE = r"[ \t\n\f\r/]*([^ \t\n\f\r>/=]+)(?:[ \t\n\f\r]*=[ \t\n\f\r]*" + _VALUE + ")?"
_RESOLVED = r"""CASE WHEN regexp_matches({t}, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN {t} WHEN starts_with({t}, '//') THEN regexp_extract({b}, '^(.*?)://', 1, 's') || ':' || {t}
    WHEN starts_with({t}, '/') THEN {r} || {t} WHEN starts_with({t}, '?') THEN {r} || {p} || {t}
    WHEN {t} = '' OR starts_with({t}, '#') THEN {r} || {p} || regexp_extract({b}, '^[^#]*?(\?[^#]*)', 1, 's') || {t} ELSE {r} || regexp_extract({p}, '^(.*)/[^/]*$', 1, 's') || '/' || {t} END"""


def _resolved(target: str, base: str) -> str:
    target = f"regexp_replace({target}, '[\\t\\n\\r]', '', 'g')"
    return _RESOLVED.format(t=target, b=base, r=f"regexp_extract({base}, '^(.*?://[^/?#]*)', 1, 's')", p=f"regexp_extract({base}, '^.*?://[^/?#]*([^?#]*)', 1, 's')")


_DOTS = r"""CASE WHEN regexp_matches({0}, '^.*?://[^?#]*/\.\.?(?:[/?#]|$)', 's') THEN regexp_extract({0}, '^(.*?://[^/?#]*)', 1, 's') || list_reduce(
    list_concat([''], string_split(regexp_extract({0}, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '/')[2:]), lambda got, x: CASE WHEN x = '..' THEN regexp_replace(got, '/[^/]*$', '') WHEN x = '.' THEN got ELSE got || '/' || x END)
    || CASE WHEN string_split(regexp_extract({0}, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '/')[-1] IN ('.', '..') THEN '/' ELSE '' END || regexp_extract({0}, '^.*?://[^/?#]*[^?#]*([?#].*)', 1, 's') ELSE {0} END"""
_REFRESH_SQL = _REFRESH.replace("'", "''").replace("(?is)", "")
_URL_SQL = rf"""
    WITH RECURSIVE names AS (SELECT {_ENTITIES} AS known
    ), p AS (
        SELECT page_id, url, html, coalesce({_HOST.format("url")}, '') AS host, coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path, {_NODE.format("url")} AS node FROM pages
    ), r(verdict, rule) AS (VALUES {", ".join(f"('{v}', '{rule}')" for v, rule in RULES)}
    ), fits AS (
        SELECT url, r.* FROM (SELECT DISTINCT url, host, path FROM p) p JOIN r ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
            AND starts_with(path, substr(rule, 1 + length(split_part(rule, '/', 1))))
    ), best AS (SELECT url, arg_max(rule, (length(rule), verdict = 'allow')) AS rule, arg_max(verdict, (length(rule), verdict = 'allow')) AS verdict FROM fits GROUP BY 1
    ), judged AS (SELECT p.*, rule, verdict FROM p LEFT JOIN best USING (url)
    ), clean AS (
        SELECT row_number() OVER () AS n, node, url, regexp_replace(html, '{_NO_MARKUP}', ' ', 'g') AS html FROM judged WHERE regexp_matches(html, '(?i)canonical|refresh')
    ), tags AS (
        SELECT n, node, url, kind, pos, tag FROM (
            SELECT n, node, url, kind, unnest(found) AS tag, generate_subscripts(found, 1) AS pos
            FROM (SELECT *, regexp_extract_all(html, '(?is)<' || kind || '{_TAG}') AS found FROM clean, (VALUES ('base'), ('link'), ('meta')) k(kind)))
    ), read AS (
        SELECT n, node, url, kind, pos, list_transform(regexp_extract_all(inside, '{_ONE}', 1, 's'), lambda x: lower(x)) AS names,
               list_transform(list_zip(regexp_extract_all(inside, '{_ONE}', 2, 's'), regexp_extract_all(inside, '{_ONE}', 3, 's'), regexp_extract_all(inside, '{_ONE}', 4, 's')),
                   lambda x: concat(x[1], x[2], x[3])) AS vals
        FROM (SELECT *, substr(tag, 6, length(tag) - 6) AS inside FROM tags)
    ), wanted AS (
        SELECT n, node, url, kind, pos, a.name, vals[list_position(names, a.name)] AS v FROM read, (VALUES ('href'), ('rel'), ('http-equiv'), ('content')) a(name) WHERE list_contains(names, a.name)
    ), decoded AS (
        SELECT n, node, url, kind, pos, name, regexp_replace(string_split(v, '&')[1] || array_to_string(list_transform(string_split(v, '&')[2:], lambda x: CASE
            WHEN regexp_matches(x, '^#[0-9]+;') AND try_cast(regexp_extract(x, '^#0*([0-9]*);', 1) AS BIGINT) BETWEEN 1 AND 1114111
                AND NOT try_cast(regexp_extract(x, '^#0*([0-9]*);', 1) AS BIGINT) BETWEEN 55296 AND 57343
                THEN chr(CAST(regexp_extract(x, '^#0*([0-9]*);', 1) AS INT)) || regexp_replace(x, '^#[0-9]+;', '')
            WHEN regexp_matches(x, '^#[xX][0-9a-fA-F]+;') AND try_cast('0x' || regexp_extract(x, '^#[xX]0*([0-9a-fA-F]*);', 1) AS BIGINT) BETWEEN 1 AND 1114111
                AND NOT try_cast('0x' || regexp_extract(x, '^#[xX]0*([0-9a-fA-F]*);', 1) AS BIGINT) BETWEEN 55296 AND 57343
                THEN chr(CAST('0x' || regexp_extract(x, '^#[xX]0*([0-9a-fA-F]*);', 1) AS INT)) || regexp_replace(x, '^#[xX][0-9a-fA-F]+;', '')
            WHEN regexp_matches(x, '^[0-9A-Za-z]+;') AND map_contains(known, regexp_extract(x, '^([0-9A-Za-z]+);', 1))
                THEN map_extract(known, regexp_extract(x, '^([0-9A-Za-z]+);', 1))[1] || regexp_replace(x, '^[0-9A-Za-z]+;', '')
            ELSE '&' || x END), ''), '^[ 	

]+|[ 	

]+$', '', 'g') AS v FROM wanted, names
    ), own AS (SELECT n, node, url, kind, pos, max(v) FILTER (WHERE name = 'href') AS href, max(v) FILTER (WHERE name = 'rel') AS rel,
            max(v) FILTER (WHERE name = 'http-equiv') AS equiv, max(v) FILTER (WHERE name = 'content') AS content FROM decoded GROUP BY ALL
    ), bases AS (SELECT n, arg_min(href, pos) AS href FROM own WHERE kind = 'base' AND href IS NOT NULL GROUP BY n
    ), based AS (SELECT n, {_resolved("bases.href", "clean.url")} AS u FROM bases JOIN clean USING (n)
    ), targets AS (
        SELECT n, node, url, href AS target FROM own WHERE kind = 'link' AND list_contains(string_split_regex(lower(rel), '[ 	

]+'), 'canonical')
        UNION ALL SELECT n, node, url, regexp_extract(content, '{_REFRESH_SQL}', 1, 'is') || regexp_extract(content, '{_REFRESH_SQL}', 2, 'is') || regexp_extract(content, '{_REFRESH_SQL}', 3, 'is')
        FROM own WHERE kind = 'meta' AND lower(equiv) = 'refresh'
    ), bases_of AS (SELECT t.*, coalesce({_DOTS.format("based.u")}, url) AS base FROM targets t LEFT JOIN based USING (n) WHERE target <> ''
    ), full_urls AS (SELECT node AS a, {_resolved("target", "base")} AS u FROM bases_of
    ), ends AS (SELECT a, {_DOTS.format("u")} AS u FROM full_urls
    ), one AS (SELECT a, {_NODE.format("u")} AS b FROM ends
    ), edge AS (SELECT a, b FROM one WHERE a IS NOT NULL AND b IS NOT NULL UNION SELECT b, a FROM one WHERE a IS NOT NULL AND b IS NOT NULL
    ), caught AS (SELECT node FROM judged WHERE verdict = 'block' AND node IS NOT NULL UNION SELECT b FROM caught JOIN edge ON edge.a = caught.node)
    SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN node IN (SELECT node FROM caught) THEN 'block' ELSE 'allow' END) AS verdict FROM judged"""

SQL = {
    # Every two classes that share a shingle, exactly.
    "op2_ngram_jaccard_join": f"""
        WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents
        ), c AS (SELECT w, min(doc_id) AS copy_id, count(*) AS n_copies FROM d WHERE len(w) > 0 AND doc_id IS NOT NULL GROUP BY w
        ), x AS (SELECT copy_id, len(g) AS n, unnest(g) AS g FROM (SELECT copy_id, {_GRAMS} AS g FROM c)
        ), p AS (
            SELECT a.copy_id AS a, b.copy_id AS b FROM x a JOIN x b ON a.g = b.g AND a.copy_id <> b.copy_id
            GROUP BY a.copy_id, b.copy_id, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-9
        ), reach AS (SELECT copy_id AS node, copy_id AS low FROM c UNION SELECT p.b, low FROM reach JOIN p ON p.a = reach.node
        ), classes AS (SELECT node, min(low) AS class_id FROM reach GROUP BY node
        ), links AS (SELECT a, count(*) AS k FROM p GROUP BY a)
        SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(copy_id, doc_id) AS copy_id, coalesce(n_copies, 1) AS n_copies, coalesce(k, 0) AS n_links
        FROM d LEFT JOIN c ON c.w = d.w AND doc_id IS NOT NULL LEFT JOIN classes ON node = copy_id LEFT JOIN links ON a = copy_id""",
    # A short item is one run of words, looked for among the texts' runs of as many.
    "op6_decontamination": f"""
        WITH i AS (SELECT row_number() OVER () AS i, item_id, {_WORDS} AS w FROM benchmark
        ), d AS (SELECT row_number() OVER () AS d, doc_id, {_WORDS} AS w FROM documents
        ), ig AS (SELECT i, item_id, least(len(w), 5) AS size, len(g) AS n, unnest(g) AS g FROM (SELECT i, item_id, w, {_GRAMS} AS g FROM i WHERE len(w) > 0)
        ), sizes AS (SELECT DISTINCT size FROM ig
        ), dg AS (
            SELECT d, doc_id, size, unnest(list_distinct(list_transform(range(0, len(w) - size + 1), lambda k: array_to_string(w[k + 1 : k + size], ' ')))) AS g
            FROM d, sizes WHERE len(w) >= size)
        SELECT doc_id, item_id, n AS n_shingles, count(*) AS n_found, count(*) / n AS containment FROM ig JOIN dg USING (size, g)
        GROUP BY d, doc_id, i, item_id, n HAVING count(*) >= 0.8 * n - 1e-9""",
    # Every window against every template, without the filters of the join.
    "op3_license_scan": rf"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
        ), t(label, family, tokens) AS (VALUES {_TEMPLATES}), p(label, ws) AS (VALUES {_PHRASES}
        ), places AS (
            SELECT r, label, unnest(list_filter(range(0, len(w)), lambda i: w[i + 1 : i + len(ws)] = ws)) AS place FROM d, p
        ), base AS (SELECT r, count(*) AS n, min(place) AS a, max(place) AS b, list(DISTINCT label) AS l FROM places GROUP BY r
        ), windows AS (
            SELECT r, i, w[i + 1 : i + 64] AS own FROM (SELECT r, w, unnest(range(0, greatest(len(w) - 32, 1), 32)) AS i FROM d)
        ), shared AS (
            SELECT r, i, label, family, len(tokens) AS n, len(list_intersect(own, tokens)) AS k FROM windows, t WHERE list_has_any(own, tokens)
        ), best AS (
            SELECT r, i, family, arg_max(label, (k / n, n, label)) AS label, max(k / n) AS score FROM shared WHERE k >= ceil(0.85 * n - 1e-9) GROUP BY ALL
        ), more AS (SELECT r, list(DISTINCT label) AS l, max(score) AS score FROM best GROUP BY r)
        SELECT doc_id, len(w) AS n_words, coalesce(base.n, 0) AS n_base, a AS first_word, b AS last_word, array_to_string(list_sort(coalesce(base.l, [])), ',') AS base_labels,
               array_to_string(list_sort(list_distinct(list_concat(coalesce(base.l, []), coalesce(more.l, [])))), ',') AS labels,
               CASE WHEN base.n > 0 THEN 1.0 ELSE coalesce(more.score, 0.0) END::DOUBLE AS score
        FROM d LEFT JOIN base USING (r) LEFT JOIN more USING (r)""",
    "op10_url_filter": _URL_SQL,
    "op7_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
        f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
        SELECT page_id, octet_length(encode(html)) AS payload_bytes,
               list_aggregate(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + CAST((CAST('0x' || substr(p.h, 1 + 5 * (k // 4), 5) AS BIGINT) >> (5 * (3 - k % 4))) & 31 AS BIGINT), 1)), 'string_agg', '') AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
        FROM p JOIN f USING (h)""",
    "op1_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
        ), keyed AS (
            SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
        ), often AS (
            SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE o.k IS NOT NULL) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE o.k IS NULL), '')) AS kept_sha256
        FROM keyed LEFT JOIN often o USING (k) GROUP BY doc_id""",
}
