"""Registry of queries and of the SQL fragments their counterparts are made of."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}
# name -> (names it builds on, SQL text)
PARTS: dict[str, tuple[tuple[str, ...], str]] = {}


def part(name: str, sql: str, *needs: str) -> None:
    """Define a named common table expression."""
    PARTS[name] = (needs, sql)


def oracle(select: str, *needs: str) -> str:
    """SQL text: the common table expressions needed, in order, before ``select``."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for other in PARTS[name][0]:
                add(other)
            ordered.append(name)

    for name in needs:
        add(name)
    ctes = ",\n".join(f"{name} AS ({PARTS[name][1]})" for name in ordered)
    return f"WITH RECURSIVE {ctes}\n{select}" if ctes else select


def query(name: str, sql: str | None = None):
    """Register a builder ``(spark, sf_dir) -> DataFrame`` under ``name``."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = Query(build, sql)
        return build

    return register
