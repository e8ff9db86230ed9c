"""The corpus queries, each with the SQL that must give the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.llm import bpe, decontaminate, extract, licenses, lines, neardup, personal, pivots, quality, resample, trie, urls, warc

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        if name in ENTRIES:
            raise ValueError(f"{name} is registered twice")
        ENTRIES[name] = Entry(run, sql)
        return run
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BENCHMARK_SQL = r"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (SELECT DISTINCT item, array_to_string(w[i:i + 12], ' ') AS win, least(len(w), 13) AS n
        FROM (SELECT item, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
size AS (SELECT DISTINCT n FROM win),
place AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
          FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM doc, size)),
hit AS (SELECT doc_id, item, i, n FROM place JOIN win USING (win, n)),
word AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY 1),
items AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM hit GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
    sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op1_decontamination", BENCHMARK_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


@query("op2_byte_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op3_main_text")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.main_texts(table(spark, sf_dir, "pages"))


# the short notices, which are the ones that stand in the test table
LICENSES_SQL = f"""
WITH notice(name, words) AS (VALUES {", ".join(f"('{name}', '{texts[0]}')" for name, texts in licenses.TEMPLATES.items())}),
line AS (SELECT DISTINCT text, unnest(string_split(text, chr(10))) AS l FROM documents),
named AS (SELECT text, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses FROM line JOIN notice ON contains(l, words) GROUP BY text)
SELECT doc_id, coalesce(licenses, '') AS licenses FROM documents LEFT JOIN named USING (text)
"""


@query("op4_license_scan", LICENSES_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(table(spark, sf_dir, "documents")).select("doc_id", "licenses")


URLS_SQL = r"""
WITH cut AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
bare AS (SELECT page_id, regexp_extract(coalesce(rest, ''), '^[^?#]*') AS rest FROM cut),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    substr(rest, length(regexp_extract(rest, '^[^/]*')) + 1) AS path FROM bare),
page AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)[.]', '') || regexp_replace(path, '([.]html?|/)$', '') END AS canonical,
    CASE WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
         WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
         WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
         WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule FROM parts),
listed AS (SELECT DISTINCT canonical FROM page JOIN labels ON page_id = doc_id WHERE toxic = 1)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN canonical IN (SELECT canonical FROM listed WHERE canonical IS NOT NULL) THEN 'block' ELSE 'allow' END AS verdict
FROM page
"""


@query("op5_url_filter", URLS_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list holds the URLs of the pages that are labelled toxic."""
    pages = table(spark, sf_dir, "pages")
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("page_id"))
    host, path = urls.host_and_path(F.col("url"))
    listed = pages.join(toxic, "page_id", "left_semi").select(urls.canonical(host, path).alias("canonical"))
    return urls.judged(pages, listed).drop("canonical")


@query("op6_near_vectors")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op7_warc_derivatives")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of each derivative of the pages, taken as responses of one crawl."""
    found = warc.responses(table(spark, sf_dir, "pages"), "2024-01-31T00:00:00Z")
    return warc.derivatives(found, "page_id").drop("block").withColumn("record", F.sha2(F.col("record").cast("binary"), 256)).withColumnRenamed("record", "record_sha256")


@query("op8_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_near_duplicates")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


LINES_SQL = f"""
WITH row_line AS (SELECT DISTINCT text, source, trim(l, ' ') AS l
    FROM (SELECT text, source, unnest(string_split(text, chr(10))) AS l FROM documents WHERE text IS NOT NULL) WHERE trim(l, ' ') <> ''),
wide AS (SELECT l FROM row_line GROUP BY l HAVING count(DISTINCT source) >= {lines.MIN_SITES} AND count(DISTINCT text) >= {lines.MIN_SITES}),
text_line AS (SELECT DISTINCT text, l, l IN (SELECT l FROM wide) AS wide FROM row_line),
bare AS (SELECT text FROM text_line GROUP BY text HAVING bool_and(wide)),
keeper AS (SELECT DISTINCT arg_min(text, md5(text)) AS text FROM text_line JOIN bare USING (text) GROUP BY l),
cuts AS (SELECT text, list(l) AS cut FROM text_line WHERE wide AND text NOT IN (SELECT text FROM keeper) GROUP BY text),
named AS (SELECT doc_id, documents.text AS text, cut, string_split(documents.text, chr(10)) AS ls
          FROM documents LEFT JOIN cuts ON documents.text = cuts.text),
left_over AS (SELECT *, CASE WHEN cut IS NULL THEN ls ELSE list_filter(ls, lambda x: NOT list_contains(cut, trim(x, ' '))) END AS rest FROM named),
worth AS (SELECT *, cut IS NULL OR len(list_filter(rest, lambda x: trim(x, ' ') <> '')) > 0 AS worth FROM left_over)
SELECT doc_id, CAST(coalesce(len(ls), 0) AS BIGINT) AS n_lines,
    CAST(CASE WHEN ls IS NULL THEN 0 WHEN worth THEN len(ls) - len(rest) ELSE len(ls) END AS BIGINT) AS n_removed,
    sha256(CASE WHEN worth THEN array_to_string(rest, chr(10)) ELSE '' END) AS text_sha256
FROM worth
"""


@query("op10_line_dedup", LINES_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_dedup(table(spark, sf_dir, "documents"), counts=True).selectExpr(
        "doc_id", "n_lines", "n_removed", "sha2(cast(text as binary), 256) as text_sha256")


@query("op11_personal_data")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.digest(personal.personal_data(table(spark, sf_dir, "documents")))


def _words_sql(text: str) -> str:
    return f"""list_filter(regexp_split_to_array(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"""


def _runs_sql(words: str) -> str:
    """All runs of one to three words."""
    return f"""list_concat({words}, list_transform(generate_series(1, len({words}) - 1), lambda i: {words}[i] || ' ' || {words}[i + 1]),
    list_transform(generate_series(1, len({words}) - 2), lambda i: {words}[i] || ' ' || {words}[i + 1] || ' ' || {words}[i + 2]))"""


def _crc32_sql(text: str) -> str:
    """The checksum bit by bit, from the polynomial."""
    return f"""xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(generate_series(0, 8 * strlen({text}) - 1),
    lambda i: (CAST(('0x' || substr(hex({text}), CAST(2 * (i // 8) + 1 AS BIGINT), 2)) AS BIGINT) >> CAST(i % 8 AS BIGINT)) & 1)),
    lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))))"""


RESAMPLE_SQL = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {_words_sql('text')} AS w FROM documents),
doc_run AS (SELECT r, f, count(*) AS n FROM (SELECT r, unnest({_runs_sql('w')}) AS f FROM doc) GROUP BY ALL),
item_run AS (SELECT f, count(*) AS n FROM (SELECT unnest({_runs_sql('w')}) AS f FROM (SELECT {_words_sql('text')} AS w FROM benchmark)) GROUP BY ALL),
named AS (SELECT f, {_crc32_sql('f')} % 10000 AS b FROM (SELECT f FROM doc_run UNION SELECT f FROM item_run)),
s AS (SELECT b, sum(n) AS s FROM doc_run JOIN named USING (f) GROUP BY b),
t AS (SELECT b, sum(n) AS t FROM item_run JOIN named USING (f) GROUP BY b),
gain AS (SELECT b, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE
    / ((s + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE))) AS BIGINT) AS g FROM s LEFT JOIN t USING (b)),
weighed AS (SELECT r, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * g) AS BIGINT) AS weight FROM doc_run JOIN named USING (f) JOIN gain USING (b) GROUP BY r),
scored AS (SELECT r, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE)
    / 4294967296::DOUBLE))) AS BIGINT) AS score FROM doc LEFT JOIN weighed USING (r)),
placed AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * n // 100 THEN place END AS rank FROM scored LEFT JOIN placed USING (r)
"""


@query("op12_importance_resampling", RESAMPLE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


TRIE_SQL = f"""
WITH turns AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(e)) - 1 AS i
    FROM (SELECT conv_id, turn, coalesce(text, '') AS text, strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS e
          FROM conversations WHERE conv_id IS NOT NULL)),
conv AS (SELECT conv_id AS c, {_crc32_sql('CAST(conv_id AS VARCHAR)')} % 4 AS h, conv_id - conv_id % 20 AS base FROM (SELECT DISTINCT conv_id FROM turns)),
built AS (SELECT c, i, e, text FROM turns JOIN conv ON conv_id = c WHERE i >= h UNION ALL
    SELECT c, i, e, text FROM conv JOIN turns ON conv_id = base WHERE i < h),
seq AS (SELECT c, coalesce(list(e ORDER BY i) FILTER (e IS NOT NULL), []) AS s, coalesce(list(text ORDER BY i) FILTER (e IS NOT NULL), []) AS texts
    FROM conv LEFT JOIN built USING (c) GROUP BY c),
path AS (SELECT c, d, s[1:d] AS p, len(s) = d AS ends, CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(texts[d], '[^\\x20\\x09-\\x0D]+')) END AS words
    FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM seq)),
node AS (SELECT d, p, min(c) AS c, count(*) AS n, any_value(words) AS words,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends FROM path GROUP BY d, p),
child AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1),
own AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN child USING (p)),
below AS (SELECT p[1:a] AS p, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum((n - 1) * words) AS BIGINT) AS saved
    FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM own) GROUP BY 1)
SELECT own.c AS conv_id, own.d AS depth, up.c AS parent_conv_id, own.n AS n_convs, own.n_children AS n_children, n_leaves, saved AS saved_tokens, own.ends AS ends_sha256
FROM own JOIN below USING (p) LEFT JOIN node up ON own.d > 0 AND up.p = own.p[1:own.d - 1]
"""


@query("op13_conversation_trie", TRIE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))
