"""Query and SQL registries.

A registered function takes (spark, sf_dir). Its SQL may name shared building blocks; the
needed ones are prepended as CTEs in dependency order.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
BLOCKS: dict[str, str] = {}
RECURSIVE: set[str] = set()


def block(name: str, sql: str, recursive: bool = False) -> None:
    if recursive:
        RECURSIVE.add(name)
    if name in BLOCKS:
        raise ValueError(f"SQL block {name} is defined twice")
    BLOCKS[name] = sql.strip()


def _needs(sql: str) -> list[str]:
    words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", sql))
    return [b for b in BLOCKS if b in words]


def with_blocks(sql: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in _needs(BLOCKS[name]):
            if dep != name:
                visit(dep)
        order.append(name)

    for name in _needs(sql):
        visit(name)
    sql = sql.strip()
    if not order:
        return sql
    once = lambda n: "" if n in RECURSIVE else "MATERIALIZED "
    parts = ",\n".join(f"{n} AS {once(n)}(\n{BLOCKS[n]}\n)" for n in order)
    if sql[:5].upper() == "WITH ":
        return f"WITH RECURSIVE {parts},\n{sql[5:]}"
    return f"WITH RECURSIVE {parts}\n{sql}"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def r6(expr: str) -> str:
    """Round to six decimals without a negative zero, as the engine side does."""
    return f"(CASE WHEN abs({expr}) < 5e-7 THEN 0.0 ELSE round({expr}, 6) END)"
