"""Registered queries of the operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (chat, language_id, line_dedup, lm_score, minhash, mixing, packing, quality, repair, simhash,
                         topk, url_filter, whitening)
from tessera.llm.common import id_bucket
from tessera.sources.tables import read_table

# verdict, host, path: fixed values of the query
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]
EXTRA_CONVERSATION = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]

_SQL: dict[str, str] = {}


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
                        "source", "copies")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return language_id.identify_language(docs, id_bucket(F.col("doc_id"), 5) == 0)


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenize_pieces(read_table(spark, sf_dir, "documents"))
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(EXTRA_CONVERSATION, "conv_id long, turn long, role string, text string")
    return chat.digest(chat.format_conversations(turns.unionByName(extra)))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def quality_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("good"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(read_table(spark, sf_dir, "documents"), quality_labels(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "score")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    return url_filter.filter_urls(read_table(spark, sf_dir, "pages"), labels, URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return lm_score.score_documents(docs, id_bucket(F.col("doc_id"), 7) == 2)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(read_table(spark, sf_dir, "embeddings"))
    return white.withColumn("deviation", F.col("deviation").cast("long"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations")
    return repair.digest(repair.damage(turns), turns)


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_mix_sources, op2_language_id, op3_top_k, op4_pack, op5_chat_format, op6_simhash, op7_quality_rules,
        op8_line_dedup, op9_url_filter, op10_lm_score, op11_whitening, op12_repair, op13_minhash)}


_SQL["op3_top_k"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
           FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""

_SQL["op5_chat_format"] = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, replace(replace(text, '<', '<\'), '[', '[\') AS et,
             replace(replace(role, '<', '<\'), '[', '[\') AS er FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), ''))
           AS loss_sha256,
       CAST(sum(length(et) + length(er) + length('<|turn|><|text|></s>') + 1) AS BIGINT) AS formatted_chars,
       false AS rewrites_history
FROM e GROUP BY conv_id"""

LINES = r"list_filter(string_split(replace(replace(replace(replace(text, chr(10), chr(10) || chr(30)), " \
        r"'. ', '. ' || chr(30)), '! ', '! ' || chr(30)), '? ', '? ' || chr(30)), chr(30)), lambda x: x <> '')"
_SQL["op8_line_dedup"] = f"""
WITH d AS (SELECT doc_id, text, {LINES} AS l, ' ' || chr(13) || chr(10) AS e FROM documents),
w AS (SELECT doc_id, pos, rtrim(l[pos + 1], e) || chr(10) || rtrim(l[pos + 2], e) || chr(10) || rtrim(l[pos + 3], e) AS w
      FROM d, unnest(range(0, greatest(len(l) - 2, 0))) AS u(pos)),
r AS (SELECT w, min(struct_pack(doc_id := doc_id, pos := pos)) AS f FROM w WHERE length(w) >= 42
      GROUP BY w HAVING count(*) > 1),
c AS (SELECT w.doc_id, unnest(range(CASE WHEN w.doc_id = r.f.doc_id THEN greatest(w.pos, r.f.pos + 3) ELSE w.pos END,
                                    w.pos + 3)) AS p
      FROM w JOIN r USING (w) WHERE NOT (w.doc_id = r.f.doc_id AND w.pos = r.f.pos)),
k AS (SELECT doc_id, list(DISTINCT p) AS covered FROM c GROUP BY doc_id)
SELECT doc_id, CASE WHEN covered IS NULL THEN text ELSE array_to_string(
         list_transform(list_filter(range(0, len(l)), lambda i: NOT list_contains(covered, i)), lambda i: l[i + 1]), '')
       END AS text, CAST(coalesce(len(covered), 0) AS BIGINT) AS n_removed
FROM d LEFT JOIN k USING (doc_id)"""

_SQL["op9_url_filter"] = r"""
WITH p AS (SELECT page_id,
             translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz') AS host,
             coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
h AS (SELECT host, coalesce(sum(CAST(quality AS DOUBLE)), 0) AS good, CAST(count(quality) AS DOUBLE) AS n,
             regexp_extract(host, '[^.]*([.][^.]*)?$') AS domain, regexp_extract(host, '[^.]*$') AS suffix
      FROM p LEFT JOIN labels ON doc_id = page_id GROUP BY host),
r AS (SELECT (sum(good) + 1) / (sum(n) + 2) AS up FROM h),
s0 AS (SELECT suffix, sum(good) AS good, sum(n) AS n, any_value(up) AS up FROM h, r GROUP BY suffix),
sk AS (SELECT 1 / least(greatest(coalesce((sum(n * (good / n - up) * (good / n - up)) - sum(up * (1 - up)))
              / nullif(sum((n - 1) * up * (1 - up)), 0), 0.5), 0.001), 0.5) - 1 AS k FROM s0 WHERE n > 0),
s AS (SELECT suffix, (k * up + good) / (k + n) AS mean FROM s0, sk),
d0 AS (SELECT domain, suffix, sum(good) AS good, sum(n) AS n, any_value(mean) AS up FROM h JOIN s USING (suffix)
       GROUP BY domain, suffix),
dk AS (SELECT 1 / least(greatest(coalesce((sum(n * (good / n - up) * (good / n - up)) - sum(up * (1 - up)))
              / nullif(sum((n - 1) * up * (1 - up)), 0), 0.5), 0.001), 0.5) - 1 AS k FROM d0 WHERE n > 0),
dm AS (SELECT domain, (k * up + good) / (k + n) AS mean FROM d0, dk),
h0 AS (SELECT host, good, n, mean AS up FROM h JOIN dm USING (domain)),
hk AS (SELECT 1 / least(greatest(coalesce((sum(n * (good / n - up) * (good / n - up)) - sum(up * (1 - up)))
              / nullif(sum((n - 1) * up * (1 - up)), 0), 0.5), 0.001), 0.5) - 1 AS k FROM h0 WHERE n > 0),
b AS (SELECT host, (k * up + good) / (k + n) AS mean, k + n + 1 AS strength FROM h0, hk),
v AS (SELECT host, CASE WHEN mean + 1.645 * sqrt(mean * (1 - mean) / strength) < 0.6 THEN 'block' ELSE 'allow' END
             AS verdict FROM b),
m AS (SELECT p.*, CASE
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule FROM p)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' ELSE verdict END AS verdict
FROM m JOIN v USING (host)"""


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
