"""Plans: compositions of operators, and the queries registered over the standard tables."""

from __future__ import annotations


def load_queries():
    """All registered queries and their SQL."""
    from exprspark.plans import check_queries, matrix_queries, model_queries, record_queries, run_queries, source_queries  # noqa: F401
    from exprspark.plans.registry import QUERIES, SQL

    return QUERIES, SQL
