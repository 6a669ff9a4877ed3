"""Query of the Merkle manifest and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm.common import table
from geoloom.llm.merkle import FAN, FIELDS, folded, leaf_digest, lower_ascii, manifest, proofs, siblings
from geoloom.llm.registry import query
from geoloom.llm.sqlparts import crc32, lower_ascii_sql

#: Levels that the SQL spells out: 16^6 leaves of a source.
_LEVELS = 6


def _field(name: str, value: str | None = None) -> str:
    text = f"({value or name})::VARCHAR"
    return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"


def _leaf(text: str | None = None) -> str:
    return "sha256(" + " || ".join(_field(f, text if f == "text" else None) for f in FIELDS) + ")"


def _levels(prefix: str, start: str, group: str) -> str:
    """SQL that folds ``start`` (group columns, idx, digest) level by level; a group of one node stays as it is."""
    out, by = [f"{prefix}0 AS ({start})"], f"PARTITION BY {group}" if group else ""
    cols = f"{group}, " if group else ""
    for k in range(1, _LEVELS + 1):
        out.append(f"""{prefix}{k} AS (
  SELECT {cols}idx // {FAN} AS idx,
    CASE WHEN any_value(n) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY idx)) END AS digest
  FROM (SELECT *, count(*) OVER ({by}) AS n FROM {prefix}{k - 1}) GROUP BY {cols}idx // {FAN})""")
    return ",\n".join(out)


def _climb(prefix: str, group: str, place: str, before: str, after: str) -> str:
    """SQL that adds siblings and tampered digest of each level to the rows of ``before``."""
    out = [f"{after}0 AS (SELECT * FROM {before})"]
    match = f"c.{group} IS NOT DISTINCT FROM w.{group} AND " if group else ""
    for k in range(_LEVELS):
        out.append(f"""{after}{k + 1} AS (
  SELECT w.* REPLACE (w.proof || coalesce(s.others, '') AS proof,
    CASE WHEN s.total > 1 THEN sha256(coalesce(s.lefts, '') || w.now || coalesce(s.rights, '')) ELSE w.now END AS now)
  FROM {after}{k} w JOIN (
    SELECT {f"a.{group}," if group else ""} a.idx, any_value(a.total) AS total,
      string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx <> a.idx) AS others,
      string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx) AS lefts,
      string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx) AS rights
    FROM (SELECT *, count(*) OVER ({f"PARTITION BY {group}" if group else ""}) AS total FROM {prefix}{k}) a
    JOIN {prefix}{k} b ON {f"a.{group} IS NOT DISTINCT FROM b.{group} AND " if group else ""} a.idx // {FAN} = b.idx // {FAN}
    GROUP BY {f"a.{group}," if group else ""} a.idx) s
  ON {match.replace("c.", "s.")} s.idx = w.{place} // {FAN ** k})""")
    return ",\n".join(out)


ORACLE = f"""
WITH
leaves AS (
  SELECT doc_id, source, {_leaf()} AS leaf, {_leaf(lower_ascii_sql("text"))} AS tampered FROM documents
),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank FROM leaves),
{_levels("g", "SELECT source, rank AS idx, leaf AS digest FROM placed", "source")},
subroots AS (SELECT source, digest AS subroot, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS place FROM g{_LEVELS}),
{_levels("t", "SELECT place AS idx, subroot AS digest FROM subroots", "")},
asked AS (
  SELECT p.doc_id, p.source, p.leaf, p.rank, s.place, s.subroot, '' AS proof,
    CASE WHEN {crc32("p.doc_id::VARCHAR")} % 5 = 0 THEN p.tampered ELSE p.leaf END AS now
  FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source
),
{_climb("g", "source", "rank", "asked", "v")},
{_climb("t", "", "place", f"v{_LEVELS}", "u")}
SELECT doc_id, leaf, subroot, (SELECT digest FROM t{_LEVELS}) AS root, sha256(proof) AS proof_sha256,
  now AS folded_root, now = (SELECT digest FROM t{_LEVELS}) AS verified
FROM u{_LEVELS}
"""


@query("op11_merkle_manifest", ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Membership proof of every document against the manifest of all; a fifth of them tampered with."""
    text = {"text": lower_ascii(F.col("text"))}
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, leaf_digest(*[text.get(f, F.col(f)) for f in FIELDS]))
    made = manifest(table(spark, sf_dir, "documents"), extra={"tampered": tampered})
    found = proofs(made, made.leaves)
    root = folded(F.coalesce("tampered", "leaf"), F.col("path"))
    proof = F.sha2(siblings(F.col("path")), 256)
    out = found.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", proof.alias("proof_sha256"), root.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
