"""Registered queries and their SQL, gathered from the query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketloom.plans import queries_catalog, queries_files, queries_io, queries_listing, queries_live, queries_market, queries_series

MODULES: list = [queries_market, queries_catalog, queries_io, queries_files, queries_listing, queries_live, queries_series]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: build for module in MODULES for name, build in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
