"""Stacking tables by name and tagging their source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.functions.columns import composite_key


def stack(tables: Sequence[DataFrame]) -> DataFrame:
    """Union by name, absent columns NULL, duplicates kept. No shuffle."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def tag(df: DataFrame, value: str, name: str = "cycle") -> DataFrame:
    """Constant source column."""
    return df.withColumn(name, F.lit(value))


def stack_tagged(tables: Mapping[str, DataFrame], name: str = "cycle") -> DataFrame:
    """U1 with P7: each table's key becomes its tag."""
    return stack([tag(df, key, name) for key, df in tables.items()])


def stack_long(
    tables: Sequence[tuple[str, DataFrame]], id_col: str, cycle_col: str = "CYCLE", key_col: str = "SEQN_UNIQUE"
) -> DataFrame:
    """Stack unjoined (cycle, module table) pairs with a source tag and an `<id>_<cycle>` key."""
    stacked = stack([tag(df, cycle, cycle_col) for cycle, df in tables])
    return stacked.withColumn(key_col, composite_key(id_col, cycle_col))


def union_names(a: DataFrame, b: DataFrame) -> DataFrame:
    """U4: set union of two one-column tables."""
    return a.union(b).distinct()


def sets_by_key(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """The sorted set of values per key; `value` must have few distinct values."""
    distinct = df.select(key, value).where(F.col(value).isNotNull()).distinct()
    return distinct.groupBy(key).agg(F.sort_array(F.collect_list(value)).alias(out))
