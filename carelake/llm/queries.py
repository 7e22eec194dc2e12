"""Registered queries of the pipeline operators, each over its whole table, and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carelake.llm import counts, fingerprints, jaccard, licenses, mixing, neighbours, packing, quality, repair, spelling, toxicity, turns, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(_table(spark, sf_dir, "pages"), revisit_bytes=0)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(_table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("times")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(_table(spark, sf_dir, "documents"))


def op10_repair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.roundtrip(_table(spark, sf_dir, "documents"))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.damaged_and_repaired(_table(spark, sf_dir, "conversations"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.document_variants(_table(spark, sf_dir, "documents"))


def op13_vector_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.table_neighbours(_table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_packing, op3_jaccard_join, op4_warc, op5_quality_rules, op6_license_scan, op7_token_counts, op8_mixing, op9_fingerprints, op10_repair_ids, op11_turn_repair, op12_spelling_variants, op13_vector_neighbours)}

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

ORACLES: dict[str, str] = {
    "op3_jaccard_join": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))
                               WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE []::VARCHAR[] END) AS s
    FROM w)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM documents d JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) m ON m.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
""",
    "op4_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
), k AS (SELECT h, max(page_id) AS keeper FROM p GROUP BY h)
SELECT page_id, strlen(html) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
    1 + ((('0x' || substr(p.h, 1 + 5 * CAST(floor(i / 4) AS INT), 5))::INT >> (15 - 5 * CAST(i % 4 AS INT))) & 31)]), '') AS payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM p JOIN k USING (h)
""",
    "op8_mixing": f"""
WITH d AS (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS queue, coalesce(len({_WORDS.format("text")}), 0) AS size FROM documents
), s AS (SELECT queue, any_value(source) AS source, sum(size)::BIGINT AS source_size FROM d GROUP BY queue),
w AS (
  SELECT *, 2 * source_size AS cap, [5.0::DOUBLE, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM s
), v AS (
  SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS budget,
    coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after
  FROM w
), t AS (
  SELECT queue, source_size, least(cap::DOUBLE, max((budget - before::DOUBLE) / after) OVER () * weight) AS target FROM v
), q AS (
  SELECT d.*, source_size, target, md5(concat_ws('/', doc_id::VARCHAR, size::VARCHAR, queue)) AS place FROM d JOIN t USING (queue)
), u AS (SELECT *, sum(size) OVER (PARTITION BY queue ORDER BY place ROWS UNBOUNDED PRECEDING)::BIGINT AS upto FROM q),
c AS (
  SELECT doc_id, queue, place, size, turn, (upto + turn * source_size) / target AS finish
  FROM u, (VALUES (0), (1)) z(turn) WHERE size > 0 AND target > 0 AND upto - size + turn * source_size < target
), r AS (SELECT *, sum(size) OVER (ORDER BY finish, queue, place, turn ROWS UNBOUNDED PRECEDING) AS total FROM c),
k AS (SELECT doc_id, queue, place, count(*) AS times FROM r WHERE total <= (SELECT sum(target) FROM t) GROUP BY ALL)
SELECT u.doc_id, u.size, u.source_size, u.target, coalesce(k.times, 0) * u.size AS taken
FROM u LEFT JOIN k ON k.doc_id = u.doc_id AND k.queue = u.queue AND k.place = u.place
""",
}
