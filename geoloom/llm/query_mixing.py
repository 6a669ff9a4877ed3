"""Query of the mixing operator and its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm.common import table
from geoloom.llm.mixing import mixed
from geoloom.llm.registry import query

#: Domain of the sources, and target weights at each level of the tree; what is not listed weighs 1.
DOMAINS = {
    "web": ("src0", "src1", "src2", "src3", "src4"),
    "reference": ("src5", "src6", "src7", "src8", "src9"),
    "forum": ("src10", "src11", "src12", "src13", "src14"),
    "books": ("src15", "src16", "src17", "src18", "src19"),
}
WEIGHTS = (
    ("domain", {"web": 4, "reference": 3, "forum": 2, "books": 1}),
    ("lang", {"en": 5, "de": 2, "fr": 2, "es": 1}),
    ("source", {}),
)


def domain(source: Column) -> Column:
    name = F.lit("other")
    for d, sources in DOMAINS.items():
        name = F.when(source.isin(*sources), F.lit(d)).otherwise(name)
    return name


_CASE = "CASE " + " ".join(f"WHEN source IN ({', '.join(repr(s) for s in v)}) THEN '{d}'" for d, v in DOMAINS.items()) + " ELSE 'other' END"
_DOMAIN_WEIGHT = "CASE domain WHEN 'web' THEN 4 WHEN 'reference' THEN 3 WHEN 'forum' THEN 2 ELSE 1 END"
_LANG_WEIGHT = "CASE lang WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END"


def _level(name: str, keys: str, parent: str, weight: str, given: str) -> str:
    """SQL of one level: capacity-bounded shares of each parent's budget."""
    by = f"PARTITION BY {parent}" if parent else ""
    order = f"{by} ORDER BY CAST(capacity AS DOUBLE) / weight, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return f"""
{name}_nodes AS (
  SELECT {keys}, sum(capacity)::BIGINT AS capacity, ({weight})::BIGINT AS weight FROM leaves GROUP BY {keys}
),
{name}_given AS ({given}),
{name}_left AS (
  SELECT *, sum(weight) OVER ({by}) - coalesce(sum(weight) OVER ({order}), 0) AS w_left,
    given - coalesce(sum(capacity) OVER ({order}), 0) AS b_left
  FROM {name}_given
),
{name}_full AS (SELECT *, capacity::HUGEINT * w_left <= weight * b_left AS filled FROM {name}_left),
{name}_open AS (
  SELECT *, sum(CASE WHEN filled THEN 0 ELSE weight END) OVER ({by}) AS w_open,
    given - sum(CASE WHEN filled THEN capacity ELSE 0 END) OVER ({by}) AS b_open
  FROM {name}_full
),
{name}_budget AS (
  SELECT {keys}, CASE WHEN filled THEN capacity ELSE coalesce((weight * b_open) // nullif(w_open, 0), 0) END::BIGINT AS budget
  FROM {name}_open
),"""


def oracle(share: str = "1.0", max_epochs: int = 2) -> str:
    return (
        f"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, {_CASE} AS domain,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS tokens,
    coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, ''))) AS own
  FROM documents
),
leaves AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens, sum(tokens)::BIGINT * {max_epochs} AS capacity FROM docs GROUP BY ALL),
total AS (SELECT CAST(trunc(sum(tokens) * {share}) AS BIGINT) AS given FROM leaves),"""
        + _level("domain", "domain", "", _DOMAIN_WEIGHT, "SELECT n.*, t.given FROM domain_nodes n, total t")
        + _level(
            "lang", "domain, lang", "domain", _LANG_WEIGHT,
            "SELECT n.*, b.budget AS given FROM lang_nodes n JOIN domain_budget b USING (domain)",
        )
        + _level(
            "source", "domain, lang, source", "domain, lang", "1",
            "SELECT n.*, b.budget AS given FROM source_nodes n JOIN lang_budget b USING (domain, lang)",
        )
        + f"""
plan AS (
  SELECT domain, lang, source, budget // tokens AS epochs, budget % tokens AS rest
  FROM leaves JOIN source_budget USING (domain, lang, source) WHERE tokens > 0
),
placed AS (SELECT d.*, epochs, rest, md5('42:' || epochs || ':' || own) AS place FROM docs d JOIN plan USING (domain, lang, source)),
upto AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY place) AS upto FROM placed),
times AS (SELECT *, epochs + CASE WHEN epochs < {max_epochs} AND upto <= rest THEN 1 ELSE 0 END AS times FROM upto)
SELECT doc_id, domain, lang, source, tokens, CAST(e AS INTEGER) AS epoch
FROM times, unnest(range(times)) AS u(e)
"""
    )


@query("op6_hierarchical_mixing", oracle())
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a mixture with as many tokens as the corpus, at most two epochs of each source."""
    docs = table(spark, sf_dir, "documents").withColumn("domain", domain(F.col("source")))
    taken = mixed(docs, WEIGHTS)
    text = {c: F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")}
    return taken.select("doc_id", "domain", text["lang"], text["source"], "tokens", "epoch")
