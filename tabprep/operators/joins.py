"""Full outer joins of module tables and dictionary lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.functions.columns import any_of
from tabprep.operators.stacking import stack
from tabprep.session import materialise
from tabprep.sizing import hinted


def rename_overlap(tables: Mapping[str, DataFrame], keys: Sequence[str]) -> dict[str, DataFrame]:
    """Q4: a non-key column that an earlier table already has gets its module's name as suffix."""
    seen = set(keys)
    out = {}
    for module, df in tables.items():
        names = {c: f"{c}_{module}" for c in df.columns if c not in keys and c in seen}
        renamed = df.withColumnsRenamed(names)
        taken = [c for c in renamed.columns if c not in keys and c in seen]
        if taken:
            raise ValueError(f"columns {taken} of {module} still collide")
        seen.update(renamed.columns)
        out[module] = renamed
    return out


def join_modules(
    tables: Mapping[str, DataFrame],
    keys: Sequence[str],
    unique: bool | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Full outer join of all module tables on the key columns.

    The tables are stacked and grouped by key once, one exchange for any number of modules, and the same grouping counts
    each key per module. `unique=True` says that no module repeats a key, and fails if one does. Otherwise the grouped
    rows are written once; the keys that repeat, if any, are taken out and joined module by module, as matching repeats
    multiply rows. A NULL key matches nothing unless `null_safe`.
    """
    tables = rename_overlap(tables, list(keys))
    if len(tables) == 1:
        return next(iter(tables.values()))
    return join_groups([list(tables.values())], keys, unique, null_safe)


def join_groups(
    groups: Sequence[Sequence[DataFrame]], keys: Sequence[str], unique: bool | None = None, null_safe: bool = False
) -> DataFrame:
    """The join of each group of tables, stacked. No key may be in two groups; they still share one grouping."""
    keys = list(keys)
    flat = [t for group in groups for t in group]
    values = list(dict.fromkeys(c for t in flat for c in t.columns if c not in keys))
    grouped = _grouped(flat, keys, values, null_safe)
    most = F.greatest(*[F.col(_count(i)) for i in range(len(flat))], F.lit(1))
    if unique:
        repeated = F.raise_error(F.lit("a module repeats a key")).cast("boolean")
        return grouped.where(F.when(most > 1, repeated).otherwise(True)).select(*keys, *values)
    fixed = materialise(grouped)
    several = fixed.where(most > 1)
    once = fixed.where(most <= 1).select(*keys, *values)
    if several.isEmpty():
        return once
    counts = materialise(several.select(*keys, *[_count(i) for i in range(len(flat))]))
    parts, first = [once], 0
    for group in groups:
        numbers = range(first, first + len(group))
        first += len(group)
        mine = counts.where(F.greatest(*[F.col(_count(i)) for i in numbers], F.lit(0)) > 0)
        parts.append(_multiplied(mine, group, numbers, keys))
    return stack(parts).select(*keys, *values)


def _count(i: int) -> str:
    return f"join__n{i}"


def _grouped(tables: Sequence[DataFrame], keys: list[str], values: list[str], null_safe: bool) -> DataFrame:
    """One row per key: the first value of every column, and how often each table holds the key."""
    stacked = stack([t.withColumn("join__table", F.lit(i)) for i, t in enumerate(tables)])
    group = list(keys)
    if not null_safe:
        # A row with a missing key is a group of its own, which also spreads such rows evenly.
        missing = any_of([F.col(k).isNull() for k in keys])
        stacked = stacked.withColumn("join__alone", F.when(missing, F.monotonically_increasing_id()))
        group.append("join__alone")
    counts = [F.count_if(F.col("join__table") == i).alias(_count(i)) for i in range(len(tables))]
    return stacked.groupBy(*group).agg(*[F.first(F.col(c), ignorenulls=True).alias(c) for c in values], *counts)


def _multiplied(counts: DataFrame, tables: Sequence[DataFrame], numbers: Sequence[int], keys: list[str]) -> DataFrame:
    """The full join for the keys in `counts`. A table that lacks a key gets an empty row for it, so that all joins are
    inner ones, in which adaptive execution can split a hot key of either side; each table is read once."""
    names = {k: f"right__{k}" for k in keys}
    on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    out = counts.select(*keys)
    for i, table in zip(numbers, tables):
        absent = counts.where(F.col(_count(i)) == 0).select(*keys)
        filled = table.unionByName(absent, allowMissingColumns=True).withColumnsRenamed(names)
        out = out.join(filled, on).drop(*names.values())
    return out


def lookup(
    df: DataFrame, table: DataFrame, key: str, value: str, out: str, default, small: bool = False, table_key: str = "level"
) -> DataFrame:
    """Map a column through a (level, value) table with unique levels; no match gives `default`.

    `small` says the table's row count was checked. Other tables join by shuffle, where adaptive execution splits
    a hot level.
    """
    right = hinted(table.select(F.col(table_key).alias("lookup__key"), F.col(value).alias("lookup__value")), small)
    filler = F.lit(default) if default is None or isinstance(default, (int, float, str)) else default
    found = df.join(right, F.col(key) == F.col("lookup__key"), "left")
    result = F.coalesce(F.col("lookup__value"), filler)
    if out in df.columns:
        return found.select(*[result.alias(out) if c == out else F.col(f"`{c}`") for c in df.columns])
    return found.select(*[F.col(f"`{c}`") for c in df.columns], result.alias(out))
