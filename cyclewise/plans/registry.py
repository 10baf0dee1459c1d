"""Query registry: name -> Spark builder, name -> oracle SQL (DuckDB dialect)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, Callable[[], str]] = {}

DIGITS = 6


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn

    return deco


def oracle(name: str):
    def deco(fn: Callable[[], str]) -> Callable[[], str]:
        ORACLES[name] = fn
        return fn

    return deco


def rnd(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Rounds every top-level double column (results are compared across engines)."""
    return df.select(
        *[
            F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def sql_round(inner: str, double_cols: list[str], digits: int = DIGITS) -> str:
    """Wraps ``inner`` so the listed double columns are rounded like :func:`rnd`."""
    if not double_cols:
        return inner
    rep = ", ".join(f"round({c}, {digits}) AS {c}" for c in double_cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{inner}\n) q"
