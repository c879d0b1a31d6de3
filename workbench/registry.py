"""Where queries and their reference SQL are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def rounded(df: DataFrame, places: int = 4, skip: tuple[str, ...] = ()) -> DataFrame:
    """Round every double column; adding zero turns a negative zero into zero."""
    out: list[Column] = []
    for name, kind in df.dtypes:
        col = F.col(f"`{name}`")
        out.append((F.round(col, places) + F.lit(0.0)).alias(name) if kind == "double" and name not in skip else col)
    return df.select(*out)
