"""Query of the SuperMinHash near-duplicates and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from geoloom.llm.common import table
from geoloom.llm.registry import query
from geoloom.llm.sqlparts import lower_ascii_sql
from geoloom.llm.superminhash import near_duplicates

ORACLE = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({lower_ascii_sql("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
),
sets AS (
  SELECT r, doc_id, CASE WHEN len(w) < 2 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM d
),
nodes AS MATERIALIZED (SELECT row_number() OVER () AS n, list_sort(s) AS s, len(s) AS size FROM sets WHERE len(s) > 0 GROUP BY list_sort(s), len(s)),
items AS MATERIALIZED (SELECT n, size, unnest(s) AS x FROM nodes),
links AS MATERIALIZED (
  SELECT a.n AS u, b.n AS v FROM items a JOIN items b ON a.x = b.x AND a.n <> b.n
    AND 100 * least(a.size, b.size) >= 80 * greatest(a.size, b.size)
  GROUP BY a.n, b.n, a.size, b.size HAVING 100 * count(*) >= 80 * (a.size + b.size - count(*))
),
reached AS (SELECT n AS u, n AS v FROM nodes UNION SELECT r.u, l.v FROM reached r JOIN links l ON r.v = l.u),
named AS (SELECT r, doc_id, len(sets.s) AS n_shingles, n FROM sets LEFT JOIN nodes ON list_sort(sets.s) = nodes.s),
first AS (SELECT u AS n, min(doc_id) AS component_id FROM reached JOIN named ON reached.v = named.n GROUP BY u)
SELECT doc_id, n_shingles, CASE WHEN n IS NULL THEN doc_id ELSE component_id END AS component_id,
  doc_id IS NOT DISTINCT FROM CASE WHEN n IS NULL THEN doc_id ELSE component_id END AS kept
FROM named LEFT JOIN first USING (n)
"""


@query("op13_superminhash_near_dedup", ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and near-duplicate class of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))
