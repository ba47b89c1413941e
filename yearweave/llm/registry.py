"""Driver queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@_query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .sentencepiece_codec import encode_decode, token_digest

    model = public_tokenizers.path("piece_bpe_32k.model")
    return token_digest(encode_decode(table(spark, sf_dir, "documents"), model))


@_query
def op10_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .kd_shards import document_shards

    return document_shards(table(spark, sf_dir, "documents"), leaves=16)


@_query
def op3_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc_bundles import read_bundles, with_roles, write_bundles

    bundles = write_bundles(with_roles(table(spark, sf_dir, "pages"), min_payload=0))
    return read_bundles(bundles, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: The digest in base 32, five hex digits (four base-32 digits) at a time.
ORACLE_SQL["op3_warc_bundles"] = """
WITH p AS (
  SELECT page_id, sha1(coalesce(html, '')) AS h, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), g AS (SELECT h, n, max(page_id) AS newest FROM p GROUP BY h, n),
d AS (
  SELECT h, list_aggregate(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + ((CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31)::INT, 1)),
    'string_agg', '') AS digest
  FROM (SELECT DISTINCT h FROM p)
)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> newest THEN newest END AS refers_to
FROM p JOIN g USING (h, n) JOIN d USING (h)
"""


@_query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash_groups import simhash_groups

    return simhash_groups(table(spark, sf_dir, "documents"))


@_query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import decontamination_report

    return decontamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query
def op8_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .hnsw_search import nearest

    return nearest(table(spark, sf_dir, "embeddings"), 20, lambda vec_id: vec_id % 20 == 0)


@_query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import removal_digest, without_repeats

    return removal_digest(without_repeats(table(spark, sf_dir, "documents")))


@_query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import line_report

    return line_report(table(spark, sf_dir, "documents"))


@_query
def op5_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .tool_chat import linked_chat

    return linked_chat(table(spark, sf_dir, "conversations")).select(
        "conv_id", "call_id", "turn", "level", "name", "n_results", F.array_join("errors", "; ").alias("errors"), "message")


ORACLE_SQL["op5_tool_calls"] = """
WITH RECURSIVE u AS (SELECT DISTINCT conv_id, turn, text FROM conversations WHERE role = 'user'),
t AS (SELECT DISTINCT conv_id, turn FROM u),
lv AS (
  SELECT conv_id, turn, 0 AS level FROM t WHERE NOT EXISTS (SELECT 1 FROM t p WHERE p.conv_id = t.conv_id AND p.turn = t.turn - 2)
  UNION ALL SELECT t.conv_id, t.turn, lv.level + 1 FROM lv JOIN t ON t.conv_id = lv.conv_id AND t.turn = lv.turn + 2
),
c AS (
  SELECT u.conv_id, 'turn-' || u.turn AS call_id, u.turn, u.text, p.turn IS NOT NULL AS follows,
    count(*) OVER (PARTITION BY u.conv_id, u.turn) AS n_calls
  FROM u LEFT JOIN (SELECT DISTINCT conv_id, turn FROM u) p ON p.conv_id = u.conv_id AND p.turn = u.turn - 2
), r AS (
  SELECT conv_id, 'turn-' || (turn - 1) AS call_id, min(turn) AS turn, count(*) AS n_results, min(text) AS content
  FROM conversations WHERE role = 'assistant' GROUP BY ALL
)
SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id,
  coalesce(c.turn, r.turn) AS turn, lv.level::INTEGER AS level,
  CASE WHEN c.turn IS NOT NULL THEN 'reply' END AS name, coalesce(n_results, 0) AS n_results,
  CASE WHEN c.turn IS NULL THEN 'result without a call' ELSE concat_ws('; ',
    CASE WHEN text IS NULL THEN 'missing text' END, CASE WHEN n_calls > 1 THEN 'identifier used twice' END,
    CASE WHEN r.turn IS NULL THEN 'no result' END) END AS errors,
  '{"arguments":' || CASE WHEN c.turn IS NULL THEN 'null' ELSE '{'
      || CASE WHEN follows THEN '"after":"${turn-' || (c.turn - 2) || '}",' ELSE '' END
      || CASE WHEN text IS NOT NULL THEN '"text":' || to_json(text)::VARCHAR || ',' ELSE '' END || '"turn":' || c.turn || '}' END
    || ',"id":' || to_json(coalesce(c.call_id, r.call_id))::VARCHAR
    || ',"name":' || CASE WHEN c.turn IS NULL THEN 'null' ELSE '"reply"' END
    || ',"result":' || coalesce(to_json(content)::VARCHAR, 'null') || '}' AS message
FROM c FULL JOIN r ON c.conv_id = r.conv_id AND c.call_id = r.call_id LEFT JOIN lv ON lv.conv_id = c.conv_id AND lv.turn = c.turn
"""


ORACLE_SQL["op2_suffix_dedup"] = """
WITH n AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), w AS (
  SELECT r, i, md5(substr(h, 2 * i + 1, 400)) AS k FROM n, unnest(range(0, greatest(n - 199, 0))) AS t(i)
), s AS (SELECT r, i FROM w SEMI JOIN (SELECT k FROM w GROUP BY k HAVING count(*) > 1) USING (k)),
g AS (SELECT r, i, coalesce(i - lag(i) OVER (PARTITION BY r ORDER BY i) > 200, TRUE)::INT AS fresh FROM s),
runs AS (
  SELECT r, min(i) AS low, max(i) + 200 AS high
  FROM (SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS run FROM g) GROUP BY r, run
), gaps AS (SELECT r, low, high, lag(high, 1, 0) OVER (PARTITION BY r ORDER BY low) AS before FROM runs),
kept AS (
  SELECT r, sum(high - low) AS n_removed, count(*) AS n_spans,
    string_agg(substr(h, 2 * before + 1, 2 * (low - before)), '' ORDER BY low) || substr(any_value(h), 2 * max(high) + 1) AS rest
  FROM gaps JOIN n USING (r) GROUP BY r
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM n LEFT JOIN kept USING (r)
"""


@_query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .periodic_runs import collapse_runs, run_digest, with_planted_runs

    return run_digest(collapse_runs(with_planted_runs(table(spark, sf_dir, "documents"))))


@_query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"), components=32, scale=64, offset=1_000_000)


@_query
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import quality_verdicts

    return quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
