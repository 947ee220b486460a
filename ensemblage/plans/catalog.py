"""All registered queries: each reads whole given tables and comes, where SQL can say it, with the same question in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = query
        if oracle is not None:
            ORACLES[name] = oracle
        return query

    return keep


def load() -> None:
    from ensemblage.plans import (  # noqa: F401
        audit_queries, geometry_queries, nmr_queries, scalar_queries, screen_queries, source_queries, structure_queries, thermo_queries,
    )
