"""Query of the importance resampling and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm.common import table
from geoloom.llm.importance import importance
from geoloom.llm.registry import query
from geoloom.llm.sqlparts import crc32, lower_ascii_sql

_WORDS = f"regexp_extract_all({lower_ascii_sql('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS words FROM documents),
raw AS (SELECT w, count(*) AS n FROM (SELECT unnest(words) AS w FROM d) GROUP BY w),
wanted AS (SELECT w, count(*) AS n FROM (SELECT unnest({_WORDS}) AS w FROM benchmark) GROUP BY w),
bucket AS MATERIALIZED (SELECT w, {crc32("w")} % 10000 AS b FROM (SELECT w FROM raw UNION SELECT w FROM wanted)),
s AS (SELECT b, sum(n) AS s FROM raw JOIN bucket USING (w) GROUP BY b),
t AS (SELECT b, sum(n) AS t FROM wanted JOIN bucket USING (w) GROUP BY b),
gain AS (
  SELECT w, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM raw), 0) + 10000)::DOUBLE
    / ((coalesce(s, 0) + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM wanted), 0) + 10000)::DOUBLE)))::BIGINT AS g
  FROM bucket LEFT JOIN s USING (b) LEFT JOIN t USING (b)
),
weights AS (SELECT r, sum(g)::BIGINT AS weight FROM (SELECT r, unnest(words) AS w FROM d) JOIN gain USING (w) GROUP BY r),
scored AS (
  SELECT doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
    (('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM d LEFT JOIN weights USING (r)
),
placed AS (
  SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) END AS place
  FROM scored
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN place <= 10 * (SELECT count(*) FROM scored WHERE n_features >= 20) // 100 THEN place END AS rank
FROM placed
"""


@query("op12_importance_resampling", ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, noisy score and rank of every document, drawn towards the benchmark's distribution."""
    out = importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_features", "weight", "score", "rank")
