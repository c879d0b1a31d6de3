"""One-pass aggregates over many columns, returned as one row per column."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Metric = Callable[[str], Column]


def wide_to_rows(
    wide: DataFrame, by: Sequence[str], cols: Sequence[str], metrics: Sequence[str], label: str = "variable"
) -> DataFrame:
    """Turn columns `metric__i` of a small aggregate into one row per measured column."""
    if not cols:
        raise ValueError("no columns to report on")
    entries = [
        F.struct(F.lit(c).alias(label), *[F.col(f"{m}__{i}").alias(m) for m in metrics]) for i, c in enumerate(cols)
    ]
    return wide.select(*by, F.inline(F.array(*entries)))


def summarise(
    df: DataFrame, cols: Sequence[str], metrics: Mapping[str, Metric], by: Sequence[str] = (), label: str = "variable"
) -> DataFrame:
    """All metrics of all columns from a single scan and one partially aggregated exchange."""
    if not cols:
        raise ValueError("no columns to report on")
    aggs = [fn(c).alias(f"{m}__{i}") for i, c in enumerate(cols) for m, fn in metrics.items()]
    wide = df.groupBy(*by).agg(*aggs)
    return wide_to_rows(wide, by, cols, list(metrics), label)


def as_double(name: str) -> Column:
    return F.col(name).cast("double")


# A value of any type as one sortable struct; exactly one field is set, or none for NULL. Every decimal type among the
# columns has a field of its own, so that no digit is lost.
VALUE_FIELDS = {"whole": "bigint", "number": "double", "flag": "boolean", "moment": "timestamp", "text": "string"}


def value_field(kind: T.DataType) -> str:
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "whole"
    if isinstance(kind, T.DecimalType):
        return f"decimal_{kind.precision}_{kind.scale}"
    if isinstance(kind, T.NumericType):
        return "number"
    if isinstance(kind, T.BooleanType):
        return "flag"
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "moment"
    return "text"


def _value_fields(df: DataFrame, cols: Sequence[str]) -> dict[str, str]:
    kinds = [df.schema[c].dataType for c in cols]
    return VALUE_FIELDS | {value_field(k): k.simpleString() for k in kinds if isinstance(k, T.DecimalType)}


def _as_value(df: DataFrame, name: str, fields: Mapping[str, str]) -> Column:
    own = value_field(df.schema[name].dataType)
    return F.struct(*[
        (F.col(name) if field == own else F.lit(None)).cast(kind).alias(field) for field, kind in fields.items()
    ])


def plain(value) -> object:
    """The Python value held by a collected value struct."""
    return next((v for v in value if v is not None), None)


def value_text(df: DataFrame, value: str) -> Column:
    """The value struct as text."""
    return F.coalesce(*[F.col(value)[f.name].cast("string") for f in df.schema[value].dataType.fields])


def long_values(df: DataFrame, cols: Sequence[str], *keep: Column) -> DataFrame:
    """One row per row and column: (keep..., variable, value, known); `value` is a value struct."""
    fields = _value_fields(df, cols)
    entries = F.array(*[
        F.struct(F.lit(c).alias("variable"), _as_value(df, c, fields).alias("value"), F.col(c).isNotNull().alias("known"))
        for c in cols
    ])
    return df.select(*keep, F.inline(entries))


def value_frequencies(df: DataFrame, cols: Sequence[str], with_nulls: bool = False) -> DataFrame:
    """(variable, value, n) for all columns in one scan; `value` is a value struct.

    Counting is partially aggregated before the shuffle, so a value held by a third of the rows costs one row per
    task, and the table is spread by (variable, value) however many distinct values there are.
    """
    long = long_values(df, cols)
    if not with_nulls:
        long = long.where("known")
    return long.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))


def modes(frequencies: DataFrame) -> DataFrame:
    """(variable, value, n): the most frequent value, the smallest one on a tie."""
    best = F.min(F.struct((-F.col("n")).alias("neg"), F.col("value").alias("value")))
    return (
        frequencies.groupBy("variable").agg(best.alias("b"))
        .select("variable", F.col("b.value").alias("value"), (-F.col("b.neg")).alias("n"))
    )
