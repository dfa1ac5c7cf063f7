"""Registry of checked queries: a Spark callable and, where it exists, the equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double; adding 0 turns −0.0 into 0.0."""
    return df.select(*[(F.round(n, digits) + F.lit(0.0)).alias(n) if t == "double" else F.col(n) for n, t in df.dtypes])


def pick(exact: str, rounded: str = "", digits: int = 6) -> str:
    """SQL select list: names as they are, then names rounded like ``tidy``."""
    return ", ".join([*exact.split(), *[f"round({n}, {digits}) + 0.0 AS {n}" for n in rounded.split()]])
