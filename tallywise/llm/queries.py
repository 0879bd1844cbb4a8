"""The corpus operators as queries over whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywise.llm import language_id, quality_cnn, quality_rules, warc
from tallywise.llm.decontamination import find_leaks
from tallywise.llm.filter_audit import audit_filters
from tallywise.llm.hard_negatives import mine_negatives
from tallywise.llm.jaccard_join import jaccard_join
from tallywise.llm.main_text import extract_main_text
from tallywise.llm.near_dedup import near_duplicates
from tallywise.llm.packing import pack
from tallywise.llm.samples import remainder
from tallywise.llm.secret_scan import scan_secrets
from tallywise.llm.token_files import read_token_files, write_token_files

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(_table(spark, folder, "documents"), VOCABULARY, end_id=0, capacity=1024)


def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return read_token_files(write_token_files(_table(spark, folder, "documents"), VOCABULARY, end_id=2))


def op3_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract_main_text(_table(spark, folder, "pages"))


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_secrets(_table(spark, folder, "documents"))


def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join(_table(spark, folder, "documents"), k=5, percent=80)


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = remainder("doc_id", language_id.HELD_OUT) == 0
    found = language_id.identify_languages(docs.select("doc_id", "text"), language_id.fit_languages(docs))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents").select("doc_id", "text"), _table(spark, folder, "labels")
    held_out = remainder("doc_id", quality_cnn.HELD_OUT) == quality_cnn.HELD_OUT_REST
    scored = quality_cnn.score_quality(docs, quality_cnn.fit_quality(docs, labels))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    read = warc.read_warc(warc.write_warc(_table(spark, folder, "pages")), with_payload=False)
    return read.where("kind = 'record'").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    field = quality_rules.fit_field(docs, _table(spark, folder, "labels"))
    return quality_rules.apply_rules(docs, field).drop("labels")


def op11_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_table(spark, folder, "documents"), k=4, percent=80)


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit_filters(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine_negatives(_table(spark, folder, "embeddings").withColumn("label", moved))


QUERIES = {
    "op1_packing": op1_packing, "op2_token_files": op2_token_files, "op3_main_text": op3_main_text,
    "op4_secret_scan": op4_secret_scan, "op5_jaccard_join": op5_jaccard_join, "op6_language_id": op6_language_id,
    "op7_quality_classifier": op7_quality_classifier, "op8_warc": op8_warc,
    "op9_decontamination": op9_decontamination, "op10_quality_rules": op10_quality_rules,
    "op11_near_dedup": op11_near_dedup, "op12_filter_audit": op12_filter_audit, "op13_hard_negatives": op13_hard_negatives,
}
#: Exact sets, their links and the smallest id reachable, with ``K`` words a shingle.
_LINKED = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
g AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < K THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - K + 2), lambda i: array_to_string(w[i : i + K - 1], ' ')) END) AS gram
  FROM w),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
l AS MATERIALIZED (
  SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
"""
ORACLE_SQL: dict[str, str] = {
    "op5_jaccard_join": _LINKED.replace("K", "5")
    + "SELECT w.doc_id, coalesce(n, 0) AS n_shingles, component_id FROM w LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)",
    "op11_near_dedup": _LINKED.replace("K", "4")
    + "SELECT w.doc_id, coalesce(n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept "
    + "FROM w LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)",
    "op8_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, h, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(x, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
""",
    "op12_filter_audit": r"""
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
  FROM documents),
m AS (
  SELECT doc_id, part,
    CAST(len(words) < 50 AS INT) + 2 * CAST(100 * len(list_distinct(words)) < 65 * len(words) AS INT)
    + 4 * CAST(100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) AS INT)
    + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(doc_id > first, false) AS INT) AS mask
  FROM w),
g AS (
  SELECT doc_id, max(CAST(coalesce(quality = 1, false) AS INT)) AS good, max(CAST(coalesce(toxic = 1, false) AS INT)) AS toxic
  FROM labels GROUP BY doc_id),
c AS (
  SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM m LEFT JOIN g USING (doc_id) GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
s AS (SELECT filter_order, bits, unnest([1, 2, 3, 4, 5]) AS step FROM o),
x AS (
  SELECT part, filter_order, step, bits[step] AS bit, mask, n, good, toxic, (mask & bits[step]) <> 0 AS fails,
    (mask & list_sum(bits[1:step - 1])::BIGINT) <> 0 AS gone
  FROM s, c),
r AS (
  SELECT part, filter_order, step, bit, sum(CASE WHEN NOT coalesce(gone, false) AND NOT fails THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN NOT coalesce(gone, false) AND fails THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN coalesce(gone, false) AND fails THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN NOT coalesce(gone, false) AND fails THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN NOT coalesce(gone, false) AND fails THEN toxic ELSE 0 END) AS toxic_lost
  FROM x GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r
""",
    "op13_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
""",
}
