"""The registered queries over these operators and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from almsflow.llm import decontaminate, divergence, fingerprints, htmltext, language, lexical, licenses, lines, mixing, neardup, shards, substrings, warc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_UP, _DOWN = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op1_minhash_near_dedup", rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_DOWN}'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) END)) AS shingle FROM w),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
link AS MATERIALIZED (
  SELECT x, y FROM both_ JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * i >= 85 * (p.n + q.n - i)),
edge AS MATERIALIZED (SELECT x, y FROM link UNION SELECT y, x FROM link),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM reach r JOIN edge e ON r.y = e.x),
low AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, low.component_id, d.doc_id = low.component_id AS kept
FROM documents d JOIN low ON low.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
""")
def minhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf, "documents"), size=3, percent=85)


@query("op5_kd_tree_shards")
def kd_tree_shards(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    placed = shards.assign(docs, shards.default_dims(), shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query("op7_benchmark_decontamination", rf"""
WITH d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_DOWN}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_DOWN}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
v AS MATERIALIZED (
  SELECT DISTINCT item_id, least(len(ws), 13) AS k, array_to_string(ws[p:p + least(len(ws), 13) - 1], ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(len(ws), 13) + 2)) AS p FROM b WHERE len(ws) > 0)),
k AS (SELECT DISTINCT k FROM v),
p AS (SELECT doc_id, k, ws, unnest(range(1, len(ws) - k + 2)) AS p FROM d, k WHERE len(ws) >= k),
hit AS MATERIALIZED (SELECT p.doc_id, p.p, p.k, v.item_id FROM p JOIN v ON v.k = p.k AND v.win = array_to_string(p.ws[p.p:p.p + p.k - 1], ' ')),
covered AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS names
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
""")
def benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark")).drop("spans")


@query("op9_source_mixing")
def source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return mixing.report(docs, mixing.plan(docs))


@query("op10_language_id")
def language_id(spark: SparkSession, sf: str) -> DataFrame:
    return language.identify(table(spark, sf, "documents"))


@query("op6_substring_dedup", r"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS MATERIALIZED (
  SELECT doc_id, p, md5(array_to_string(ws[p:p + 49], ' ')) AS win
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS p FROM d WHERE len(ws) >= 50)),
owner AS (SELECT win, min(doc_id) AS first FROM w GROUP BY win),
gone AS (SELECT DISTINCT doc_id, q FROM (SELECT w.doc_id, unnest(range(w.p, w.p + 50)) AS q FROM w JOIN owner USING (win) WHERE w.doc_id > first)),
each AS (SELECT doc_id, list(q) AS qs FROM gone GROUP BY doc_id),
kept AS (
  SELECT d.doc_id, len(ws) AS n_words, coalesce(len(qs), 0) AS n_removed,
         CASE WHEN qs IS NULL THEN ws ELSE list_select(ws, list_filter(range(1, len(ws) + 1), lambda i: NOT list_contains(qs, i))) END AS k
  FROM d LEFT JOIN each USING (doc_id))
SELECT doc_id, n_words, n_removed, sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept
""")
def substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substrings.repeated_substrings(table(spark, sf, "documents"))


@query("op2_html_extraction")
def html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return htmltext.extract(table(spark, sf, "pages"))


@query("op3_document_fingerprints")
def document_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf, "documents"))


def _license_sql() -> str:
    """The same sentences and rules as literals of the SQL text."""
    known = {s: name for name, texts in licenses.SENTENCES.items() for s in texts}
    cases = " ".join(f"WHEN '{s}' THEN '{name}'" for s, name in known.items())
    rewritten = "array_to_string(list_transform(ids, lambda i: '<' || i || '>'), '')"
    for sequence, name in licenses.RULES:
        rewritten = f"replace({rewritten}, '{''.join(f'<{i}>' for i in sequence)}', '[{name}]')"
    return rf"""
WITH s AS (
  SELECT doc_id, list_transform(string_split(regexp_replace(regexp_replace(translate(coalesce(text, ''), '{_UP}', '{_DOWN}'),
    '[.!?]+(?:\s+|$)|\n', chr(1), 'g'), '[^a-z0-9\x01]+', ' ', 'g'), chr(1)), lambda x: trim(x)) AS ss FROM documents),
i AS (SELECT doc_id, list_filter(list_transform(ss, lambda x: CASE x {cases} END), lambda x: x IS NOT NULL) AS ids FROM s),
r AS (SELECT doc_id, ids, regexp_extract_all({rewritten}, '\[([^\]]+)\]', 1) AS found FROM i)
SELECT doc_id, len(ids) AS n_known, array_to_string(ids, ',') AS sentence_ids,
       array_to_string(list_filter(found, lambda x, k: list_position(found, x) = k), ',') AS licenses
FROM r"""


@query("op4_license_scan", _license_sql())
def license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf, "documents"))


@query("op8_line_dedup", r"""
WITH l AS MATERIALIZED (
  SELECT doc_id, source, pos, line FROM (
    SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
    FROM documents WHERE text IS NOT NULL)),
spread AS (SELECT trim(line, ' ') AS t FROM l WHERE trim(line, ' ') <> '' GROUP BY 1 HAVING count(DISTINCT source) >= 8),
m AS (SELECT l.*, trim(line, ' ') <> '' AS counted, s.t IS NOT NULL AS gone FROM l LEFT JOIN spread s ON s.t = trim(line, ' '))
SELECT d.doc_id, coalesce(count(*) FILTER (WHERE counted), 0) AS n_lines, coalesce(count(*) FILTER (WHERE gone), 0) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM documents d LEFT JOIN m USING (doc_id) GROUP BY d.doc_id
""")
def line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = lines.without_spread_lines(table(spark, sf, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


@query("op13_source_divergence", rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_DOWN}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
t AS MATERIALIZED (SELECT r, lang, source, term, count(*) AS n FROM (SELECT r, lang, source, unnest(ws) AS term FROM d) GROUP BY ALL),
k AS MATERIALIZED (SELECT lang, term FROM t GROUP BY lang, term HAVING count(*) >= 30),
v AS MATERIALIZED (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS MATERIALIZED (SELECT lang, source, term, sum(n)::HUGEINT AS n FROM t JOIN k USING (lang, term) GROUP BY lang, source, term),
g AS MATERIALIZED (
  SELECT lang, source, coalesce(any_value(v.v), 0)::HUGEINT AS v, coalesce(any_value(s.n), 0)::HUGEINT AS n
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN v USING (lang) LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) s USING (lang, source) GROUP BY ALL),
p AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.n + 5 * g.v) AS p
  FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
l AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 5)) // (total + 5 * v) AS q
  FROM (SELECT lang, term, sum(n)::HUGEINT AS n FROM c GROUP BY ALL) JOIN (SELECT lang, sum(n)::HUGEINT AS total, any_value(v) AS v FROM g GROUP BY lang) USING (lang)),
pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(any_value(x.value), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS other, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y USING (lang, term) GROUP BY ALL) x
    ON x.lang = a.lang AND x.source = a.source AND x.other = b.source GROUP BY ALL),
term AS (SELECT p.lang, p.source, p.term AS item, p.p - l.q AS value FROM p JOIN l USING (lang, term) WHERE p.n > 0 AND p.p > l.q),
o AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pair
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM term)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM o WHERE part = 'pair' OR rank <= 50
""")
def source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.audit(table(spark, sf, "documents"))


@query("op12_lexical_search", rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_DOWN}'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS MATERIALIZED (
  SELECT DISTINCT item_id, i, unnest(regexp_extract_all(translate(text, '{_UP}', '{_DOWN}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT item_id, text, row_number() OVER () AS i FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL))),
s AS (SELECT count(*) FILTER (WHERE len(ws) > 0) AS n, sum(len(ws))::HUGEINT AS l FROM d),
t AS MATERIALIZED (
  SELECT r, doc_id, len, term, count(*)::BIGINT AS tf FROM (SELECT r, doc_id, len(ws) AS len, unnest(ws) AS term FROM d)
  WHERE term IN (SELECT term FROM b) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
      FROM (SELECT term, count(*) AS df FROM t GROUP BY term), s),
x AS (SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90::HUGEINT * len * n) // l))) AS v FROM t JOIN w USING (term), s),
score AS (SELECT i, any_value(item_id) AS item_id, r, any_value(doc_id) AS doc_id, sum(v)::BIGINT AS score FROM x JOIN b USING (term) GROUP BY i, r),
o AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM score WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM o WHERE rank <= 10
""")
def lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    return lexical.rank(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op11_warc_archives", """
WITH p AS MATERIALIZED (
  SELECT page_id, url, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest, coalesce(html, '') AS html FROM pages),
o AS (SELECT html, max(page_id) AS owner FROM p WHERE payload_bytes >= 1000 GROUP BY html)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN owner IS NOT NULL AND owner <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN owner <> page_id THEN owner END AS refers_to
FROM p LEFT JOIN o ON o.html = p.html AND payload_bytes >= 1000
""")
def warc_archives(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    kind = pages.schema["page_id"].dataType
    found = warc.round_trip(pages)
    return found.select(F.col("page").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
                        F.col("refers_to").cast(kind).alias("refers_to"))
