"""Queries over the given tables that show and check every operator."""

from corpusflow.checks import (  # noqa: F401
    chunk_queries,
    embed_queries,
    file_queries,
    landing_queries,
    post_queries,
    run_queries,
    table_queries,
    update_queries,
    url_queries,
)
from corpusflow.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
