"""The registered queries of the training-data operators, and the SQL that DuckDB can check them by."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, line_dedup, mixing, ngram_join, ogg, token_files, toxicity, url_filter, warc
from .shared import table

#: The rules of op4 (fixed values of its contract).
URL_RULES = [
    url_filter.Rule("com", "/en/", "block"),
    url_filter.Rule("example.com", "/en/7", "allow"),
    url_filter.Rule("net", "/de/", "allow"),
    url_filter.Rule("example.net", "/de/8", "block"),
    url_filter.Rule("org", "/es/", "block"),
]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, "url", URL_RULES).select("page_id", "host", "path", "rule", "verdict")


OP4_SQL = r"""
WITH p AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '^[\s\S]*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^[\s\S]*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
r(h, q, v) AS (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'),
                      ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
m AS (
  SELECT p.*, r.*, row_number() OVER (PARTITION BY page_id ORDER BY length(h) - length(replace(h, '.', '')) DESC NULLS LAST, length(q) DESC) AS k
  FROM p LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q))
SELECT page_id, host, path, h || q AS rule, coalesce(v, 'allow') AS verdict FROM m WHERE k = 1
"""


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM d GROUP BY source),
w AS (SELECT *, CASE i % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::HUGEINT AS weight, 2 * source_size::HUGEINT AS lim FROM s),
l AS (
  SELECT *, row_number() OVER o AS pos, coalesce(sum(lim) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS full_,
         (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::HUGEINT AS ws, (3 * sum(source_size) OVER ())::HUGEINT AS al
  FROM w WINDOW o AS (ORDER BY lim::DOUBLE / weight::DOUBLE, i)),
f AS (SELECT *, al - 2 * full_ AS lft, lim * 2 * ws <= (al - 2 * full_) * weight AS is_full FROM l),
t AS (
  SELECT source, source_size,
         CASE WHEN is_full THEN lim::DOUBLE
              ELSE (weight * (SELECT lft FROM f WHERE NOT is_full ORDER BY pos LIMIT 1))::DOUBLE
                   / (2 * (SELECT ws FROM f WHERE NOT is_full ORDER BY pos LIMIT 1))::DOUBLE END AS target
  FROM f),
b AS (SELECT *, floor(target)::BIGINT AS budget, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS rounds FROM t),
x AS (
  SELECT d.*, b.source_size, b.target, b.rounds, b.budget - b.rounds * b.source_size AS rest,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before_
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target, (rounds * size + greatest(0, least(size, rest - before_)))::BIGINT AS taken FROM x
"""

def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = ngram_join.ngram_join(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return joined.result.withColumnRenamed("id", "doc_id")


OP7_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce((SELECT min(b) FROM r WHERE r.a = doc_id), doc_id)) AS component_id FROM d LEFT JOIN n USING (doc_id)
"""


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", F.col("_lines").cast("long").alias("n_lines"), F.col("_removed").cast("long").alias("n_removed"),
                       F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("kept_chars"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = decontaminate.find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return leaks.withColumnsRenamed({"id": "doc_id", "item": "item_id"})


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.is_held_out(F.col("doc_id")).alias("held_out"), F.col("_score").alias("score"),
        F.when(F.col("_score") >= 0.7, 1).otherwise(0).alias("predicted"), F.size("_passages").alias("n_passages"))


def op2_ogg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ogg.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


OP3_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
q AS (SELECT page_id, octet_length(encode(t))::BIGINT AS n, sha1(t) AS d FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY d) AS last_ FROM q)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM last_ AND last_ IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM last_ THEN last_ END AS refers_to
FROM g
"""

#: The conversation that the contract of op8 adds.
EXTRA_TURNS = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(EXTRA_TURNS, turns.schema)
    return chat.read_back(chat.expand(turns.unionByName(extra)))


OP8_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length(role) + 8 + length(regexp_replace(regexp_replace(text, '(\\*)(<\|[^|]*\|>|</?s>|\[/?INST\])', '\1\1\\\2', 'g'), '(\\+)\z', '\1\1')) AS n,
         row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS m
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
s AS (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY k) AS upto FROM e)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       coalesce(sum(upto) FILTER (role = 'assistant' OR k = m), 0)::BIGINT AS formatted_chars,
       (count(*) FILTER (role = 'assistant' OR k = m))::BIGINT AS n_examples
FROM s GROUP BY conv_id
"""


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_files.token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return counts.select(F.col("id").alias("doc_id"), "n_tokens")


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_ogg": op2_ogg,
    "op3_warc": op3_warc,
    "op4_url_filter": op4_url_filter,
    "op5_mixing": op5_mixing,
    "op6_toxicity": op6_toxicity,
    "op7_ngram_join": op7_ngram_join,
    "op8_chat": op8_chat,
    "op9_token_counts": op9_token_counts,
    "op10_line_dedup": op10_line_dedup,
}
SQL = {"op7_ngram_join": OP7_SQL, "op3_warc": OP3_SQL, "op4_url_filter": OP4_SQL, "op5_mixing": OP5_SQL, "op8_chat": OP8_SQL}
