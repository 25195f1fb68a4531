"""Registry of named queries: Spark callable + optional DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixtures import with_fixtures

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

# Digits kept for averages, square roots and transcendental results, in both
# engines, so that summation order does not change the compared value.
DIGITS = 6


def query(name: str, sql: str | None = None, uses: tuple[str, ...] = ()):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``sql`` is the DuckDB oracle over the base tables; ``uses`` names the
    fixtures it needs as CTEs.  ``sql=None`` marks a rows-only query.
    """
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_fixtures(sql, *uses)
        return fn
    return deco


def r(c: Column | str, digits: int = DIGITS) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def rounded(df: DataFrame, cols, digits: int = DIGITS) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})
