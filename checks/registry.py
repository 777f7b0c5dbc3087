"""Named queries and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


# Averages are compared at six digits. Engines add in different orders, so a value that lies exactly
# between two of them could go either way; a shift far below the last digit settles it.
NUDGE = 1e-9


def rounded(df: DataFrame) -> DataFrame:
    """Round the double columns for comparison."""
    return df.select([F.round(F.col(c) + NUDGE, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def r6(expression: str) -> str:
    """The SQL counterpart of :func:`rounded`."""
    return f"ROUND({expression} + 1e-9, 6)"
