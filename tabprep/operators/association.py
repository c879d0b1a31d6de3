"""Relations between columns: t-tests, correlation with the target, crosstabs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.functions.columns import percent, significance
from tabprep.functions.student import t_test_p
from tabprep.functions.summaries import as_double, summarise
from tabprep.sizing import collect_bounded


def t_statistics(df: DataFrame, target: str, cols: Sequence[str], classes: tuple = (0, 1)) -> DataFrame:
    """Pooled-variance two-sample t and degrees of freedom per feature, one scan.

    Class figures are conditional aggregates, so the two classes are never separated into tables.
    """
    def side(c: str, k) -> Column:
        return F.when(F.col(target) == F.lit(k), as_double(c))

    a, b = classes
    rows = summarise(df, cols, {
        "n0": lambda c: F.count(side(c, a)), "n1": lambda c: F.count(side(c, b)),
        "mean0": lambda c: F.avg(side(c, a)), "mean1": lambda c: F.avg(side(c, b)),
        "var0": lambda c: F.var_samp(side(c, a)), "var1": lambda c: F.var_samp(side(c, b)),
    })
    dof = F.col("n0") + F.col("n1") - 2
    pooled = F.try_divide((F.col("n0") - 1) * F.col("var0") + (F.col("n1") - 1) * F.col("var1"), dof)
    error = F.sqrt(pooled * (F.try_divide(F.lit(1.0), F.col("n0")) + F.try_divide(F.lit(1.0), F.col("n1"))))
    return rows.withColumns({"dof": dof, "t": F.try_divide(F.col("mean0") - F.col("mean1"), error)})


def t_test(df: DataFrame, target: str, cols: Sequence[str], classes: tuple = (0, 1)) -> DataFrame:
    """T statistics with the two-sided p-value and its stars."""
    rows = t_statistics(df, target, cols, classes)
    return rows.withColumn("p", t_test_p(F.col("t"), F.col("dof"))).withColumn(
        "significance", significance(F.col("p"))
    )


def target_correlation(df: DataFrame, target: str, cols: Sequence[str], top: int | None = None) -> DataFrame:
    """Pearson correlation with the target on pairwise complete rows, highest first, NULL for constants."""
    cols = [c for c in cols if c != target]
    t = as_double(target)

    def both(c: str, v: Column) -> Column:
        return F.when(F.col(c).isNotNull() & F.col(target).isNotNull(), v)

    rows = summarise(df, cols, {
        "covariance": lambda c: F.covar_samp(as_double(c), t),
        "sx": lambda c: F.stddev_samp(both(c, as_double(c))),
        "sy": lambda c: F.stddev_samp(both(c, t)),
    })
    ranked = rows.select(
        "variable", F.try_divide(F.col("covariance"), F.col("sx") * F.col("sy")).alias("correlation")
    ).orderBy(F.col("correlation").desc_nulls_last(), "variable")
    return ranked.limit(top) if top is not None else ranked


MAX_LEVELS = 1_000  # a pivoted crosstab has one column per level


def _levels(df: DataFrame, col: str, levels: Sequence | None) -> Sequence:
    """The given levels, else the sorted distinct ones."""
    if levels is not None:
        return levels
    rows = collect_bounded(df.select(col).where(F.col(col).isNotNull()).distinct(), MAX_LEVELS)
    if rows is None:
        raise ValueError(f"{col} has more than {MAX_LEVELS} levels: swap rows and columns, or use crosstab_long")
    return sorted(r[0] for r in rows)


def crosstab_long(df: DataFrame, row: str, col: str, margins: bool = True) -> DataFrame:
    """A16 for any number of levels: (row, col, all_rows, all_columns, n). NULL excluded.

    A margin has NULL in the column it sums over and its flag set, so no level's name can be taken for a margin.
    """
    known = df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
    grouped = known.cube(row, col) if margins else known.groupBy(row, col)
    flags = [F.grouping(c) == 1 if margins else F.lit(False) for c in (row, col)]
    return grouped.agg(
        F.max(flags[0]).alias("all_rows") if not margins else flags[0].alias("all_rows"),
        F.max(flags[1]).alias("all_columns") if not margins else flags[1].alias("all_columns"),
        F.count(F.lit(1)).alias("n"))


def crosstab(
    df: DataFrame, row: str, col: str, levels: Sequence | None = None, margins: bool = True, total: str = "All"
) -> DataFrame:
    """Counts by (row, column) with an `All` row and column. NULL excluded. Given levels save a query.

    Levels are compared in their own type and only labelled afterwards.
    """
    levels = _levels(df, col, levels)
    kind = df.schema[col].dataType
    cells = crosstab_long(df, row, col, margins)

    def cell(v) -> Column:
        return ~F.col("all_columns") & F.col(col).eqNullSafe(F.lit(v).cast(kind))

    def summed(where: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col("n"))), F.lit(0)).alias(name)

    columns = [summed(cell(v), str(v)) for v in levels] + ([summed(F.col("all_columns"), total)] if margins else [])
    counted = cells.groupBy(row, "all_rows").agg(*columns)
    label = F.when(F.col("all_rows"), F.lit(total)).otherwise(F.col(row).cast("string"))
    return counted.select(label.alias(row), *[F.col(f"`{c}`") for c in counted.columns if c not in (row, "all_rows")])


def crosstab_row_percent(
    df: DataFrame, row: str, col: str, levels: Sequence | None = None, places: int = 2
) -> DataFrame:
    """Percent of each column level within its row."""
    levels = _levels(df, col, levels)
    known = df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
    return known.groupBy(row).agg(*[
        F.round(percent(F.count_if(F.col(col).eqNullSafe(F.lit(v).cast(df.schema[col].dataType))), F.count(F.lit(1))), places).alias(str(v)) for v in levels
    ])
