"""Named queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``oracle`` only its rows can be checked."""

    def add(function: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"query {key!r} is registered twice")
        QUERIES[key] = function
        if oracle is not None:
            ORACLES[key] = oracle
        return function

    return add


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the way reports show them."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema
        ]
    )
