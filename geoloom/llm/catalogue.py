"""All queries of this subpackage."""

from __future__ import annotations

from geoloom.llm import query_chat, query_importance, query_linecrf, query_linededup, query_merkle, query_mixing, query_ngram_rules, query_packing, query_sharding, query_simhash, query_superminhash, query_urlfilter, query_winnowing  # noqa: F401
from geoloom.llm.registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
