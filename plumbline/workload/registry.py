"""Collects the queries: name, Spark form, and SQL to check it against where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name."""
    def register(run: Query) -> Query:
        if run.__name__ in QUERIES:
            raise ValueError(f"query {run.__name__!r} exists twice")
        QUERIES[run.__name__] = run
        if oracle:
            ORACLES[run.__name__] = oracle
        return run
    return register
