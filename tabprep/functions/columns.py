"""Column expressions and schema helpers. Everything here is row-local, so it also works on a stream."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text that counts as a number. Spark's own cast also takes "5d" and "5f", which are not numbers here.
NUMBER_PATTERN = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"


def present(df: DataFrame, cols: Iterable[str], on_missing: str = "ignore") -> list[str]:
    """The requested columns that exist, in request order."""
    cols = list(cols)
    missing = [c for c in cols if c not in df.columns]
    if missing and on_missing == "error":
        raise ValueError(f"columns not found: {missing}")
    return [c for c in cols if c in df.columns]


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns in schema order, minus the excluded ones and those marked as categories."""
    skip = set(exclude)
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip and not f.metadata.get("category")
    ]


def is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def nan_to_null(col: Column) -> Column:
    return F.nanvl(col, F.lit(None).cast("double"))


def normalise_nan(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Turn NaN into NULL in floating columns, once, at ingest."""
    names = [c for c in (cols if cols is not None else df.columns) if is_floating(df, c)]
    return df.withColumns({c: nan_to_null(F.col(c)) for c in names})


def infinite_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Infinities and NaN become NULL in floating columns."""
    names = [c for c in (cols if cols is not None else df.columns) if is_floating(df, c)]
    infinity = F.lit(float("inf"))
    return df.withColumns(
        {c: F.when(F.abs(nan_to_null(F.col(c))) < infinity, F.col(c)) for c in names}
    )


def number_or_null(df: DataFrame, name: str) -> Column:
    """The column as a double; anything that is not a number becomes NULL."""
    kind = df.schema[name].dataType
    col = F.col(name)
    if isinstance(kind, T.StringType):
        return F.when(col.rlike(NUMBER_PATTERN), F.trim(col).try_cast("double"))
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return nan_to_null(col.cast("double"))
    return F.lit(None).cast("double")


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: number_or_null(df, c).alias(c) for c in present(df, cols)})


def cycle_year(cycle: Column, default: int = 2020) -> Column:
    """first year of a cycle label such as `2011-2012`."""
    return F.coalesce(F.split(cycle, "-")[0].try_cast("int"), F.lit(default))


def safe_filename(name: Column) -> Column:
    """F1: characters that are illegal in file names become underscores."""
    return F.regexp_replace(name, r'[<>:"/\\|?*]', "_")


def base_name(path: Column) -> Column:
    """the part after the last slash."""
    return F.regexp_extract(path, r"([^/]*)$", 1)


def file_stem(path: Column) -> Column:
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")


def parent_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)/[^/]*$", 1)


def table_path(path: Column) -> Column:
    """The table a data file belongs to: the folder of a file that Spark wrote as a part, else the file itself."""
    return F.regexp_replace(path, r"/part-[^/]*$", "")


def composite_key(id_col: str, cycle_col: str) -> Column:
    """`<id>_<cycle>`, NULL when either part is missing."""
    return F.concat(F.col(id_col).try_cast("bigint").cast("string"), F.lit("_"), F.col(cycle_col))


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part * F.lit(100.0), whole)


def significance(p_value: Column) -> Column:
    """Stars for a p-value."""
    return (
        F.when(p_value < 0.001, "***").when(p_value < 0.01, "**").when(p_value < 0.05, "*")
        .when(p_value.isNotNull(), "ns")
    )


def interval_label(
    col: Column, edges: Sequence[float], labels: Sequence[str], closed: str = "right"
) -> Column:
    """Label of the interval that holds the value; NULL outside all intervals."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per interval")
    out = None
    for low, high, label in zip(edges[:-1], edges[1:], labels):
        inside = (col > low) & (col <= high) if closed == "right" else (col >= low) & (col < high)
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out


def any_of(predicates: Sequence[Column]) -> Column:
    """Row predicate: at least one holds, and an unknown one does not count."""
    out = F.lit(False)
    for p in predicates:
        out = out | F.coalesce(p, F.lit(False))
    return out


def missing_count(cols: Sequence[str]) -> Column:
    """Number of NULL cells of the row among `cols`."""
    out = F.lit(0)
    for c in cols:
        out = out + F.col(c).isNull().cast("int")
    return out
