"""Every operator as a query over the given tables."""

from __future__ import annotations

from tallywise.catalog.registry import REGISTERED, Query


def registered() -> dict[str, Query]:
    """All queries by name."""
    from tallywise.catalog import (  # noqa: F401
        compare_queries, enrich_queries, generate_queries, grid_tree_queries, run_queries, table_queries, vocabulary_queries,
    )

    return REGISTERED
