"""Named queries over the parquet tables, and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import board, catalog, contests, evidence, forecasting, history, nested, prices, proofs, reports, sheets, tournaments

_MODULES = (contests, prices, history, nested, board, sheets, catalog, tournaments, evidence, proofs, reports, forecasting)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE_SQL: dict[str, str] = {name: sql for module in _MODULES for name, sql in module.ORACLE_SQL.items()}
