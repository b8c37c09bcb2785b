"""Queries over the chain view by name, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.plans.chain_view import Chain, chain_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None, address_column: str = "l_suppkey", recursive: bool = False):
    """Registers a function of a Chain under its own name."""

    def add(f: Callable[[Chain], DataFrame]) -> Callable[[Chain], DataFrame]:
        name = f.__name__
        QUERIES[name] = lambda spark, sf_dir: f(Chain(spark, sf_dir, address_column))
        if sql:
            SQL[name] = chain_sql(sql, address_column, recursive)
        return f

    return add
