"""Query catalogue: name -> (spark, sf_dir) callable, and name -> DuckDB oracle."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}


def register(name: str, oracle: str | None = None):
    """Add a query, and its oracle where SQL can express it."""

    def add(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return add


from webloom.plans import assembly_queries, case_queries, dedup_queries, link_queries, page_queries, site_queries, stream_queries, text_queries, vector_queries  # noqa: E402, F401
