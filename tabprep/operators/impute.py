"""Imputation by a fitted constant per column. Fitting is one report query; applying is row-local."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.functions.columns import present
from tabprep.functions.quantiles import median_of
from tabprep.functions.summaries import as_double, modes, plain, summarise, value_frequencies
from tabprep.sizing import local_table


@dataclass(frozen=True)
class ConstantImputer:
    """Fill value per column. A column without a fill value is left alone."""

    method: str
    values: dict[str, object] = field(default_factory=dict)

    def fill(self, df: DataFrame, name: str) -> Column:
        """A whole number column keeps its type when the value fits it, and widens to double when it does not."""
        kind = df.schema[name].dataType
        value = self.values[name]
        col = F.col(name)
        if isinstance(kind, T.IntegralType) and isinstance(value, float):
            if value.is_integer():
                return F.coalesce(col, F.lit(int(value)).cast(kind))
            return F.coalesce(col.cast("double"), F.lit(value))
        return F.coalesce(col, F.lit(value).cast(kind))

    def transform(self, df: DataFrame) -> DataFrame:
        names = [c for c in self.values if c in df.columns]
        return df.withColumns({c: self.fill(df, c).alias(c, metadata=df.schema[c].metadata) for c in names})

    def to_table(self, spark: SparkSession) -> DataFrame:
        """The fitted values as a table."""
        rows = [(c, self.method, None if v is None else str(v)) for c, v in self.values.items()]
        return local_table(spark, rows, "variable string, method string, value string")


def _chosen(df: DataFrame, cols: Sequence[str], skip: Sequence[str]) -> list[str]:
    return [c for c in present(df, cols) if c not in set(skip)]


def fit_median(df: DataFrame, cols: Sequence[str], skip: Sequence[str] = (), **quantile_options) -> ConstantImputer:
    """Exact medians; a column without values is filled with 0."""
    cols = _chosen(df, cols, skip)
    if not cols:
        return ConstantImputer("median")
    rows = median_of(df, cols, **quantile_options).collect()  # one row per column
    found = {r["variable"]: r["median"] for r in rows}
    return ConstantImputer("median", {c: 0.0 if found.get(c) is None else found[c] for c in cols})


def fit_mean(df: DataFrame, cols: Sequence[str], skip: Sequence[str] = ()) -> ConstantImputer:
    """Means; a column without values is filled with 0."""
    cols = _chosen(df, cols, skip)
    if not cols:
        return ConstantImputer("mean")
    row = df.agg(*[F.avg(as_double(c)).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return ConstantImputer("mean", {c: 0.0 if row[i] is None else row[i] for i, c in enumerate(cols)})


def fit_mode(df: DataFrame, cols: Sequence[str]) -> ConstantImputer:
    """I4: smallest most frequent value; a column without values stays as it is."""
    cols = present(df, cols)
    if not cols:
        return ConstantImputer("mode")
    rows = modes(value_frequencies(df, cols)).collect()  # one row per column
    found = {r["variable"]: plain(r["value"]) for r in rows}
    return ConstantImputer("mode", {c: found[c] for c in cols if c in found})


def imputation_report(before: DataFrame, after: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing cells before and after, per column."""
    def missing(df: DataFrame, out: str) -> DataFrame:
        return summarise(df, cols, {out: lambda c: F.count_if(F.col(c).isNull())})

    joined = missing(before, "missing_before").join(missing(after, "missing_after"), "variable")
    return joined.withColumn("imputed", F.col("missing_before") - F.col("missing_after"))
