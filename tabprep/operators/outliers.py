"""Outlier reports and bounds: interquartile fences, z-scores, box-plot figures."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.functions.columns import present, percent
from tabprep.functions.quantiles import exact_quantiles
from tabprep.functions.summaries import as_double, summarise, wide_to_rows
from tabprep.sizing import hinted, lookup_table

FENCE = 1.5
Z_LIMIT = 3.0


def _wide_row(rows: DataFrame, cols: Sequence[str], by: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Turn (by..., variable, metrics...) into one row per group with columns `metric__i`."""
    return rows.groupBy(*by).agg(*[
        F.max(F.when(F.col("variable") == c, F.col(m))).alias(f"{m}__{i}") for i, c in enumerate(cols) for m in metrics
    ])


def iqr_bounds(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), fence: float = FENCE, **options) -> DataFrame:
    """(by..., variable, q1, q2, q3, iqr, lower_bound, upper_bound)."""
    quartiles = exact_quantiles(df, cols, [0.25, 0.5, 0.75], by, **options)
    q1, q3 = F.col("q")[0], F.col("q")[2]
    return quartiles.select(
        *by, "variable", q1.alias("q1"), F.col("q")[1].alias("q2"), q3.alias("q3"), (q3 - q1).alias("iqr"),
        (q1 - fence * (q3 - q1)).alias("lower_bound"), (q3 + fence * (q3 - q1)).alias("upper_bound"),
    )


def _with_group_row(df: DataFrame, wide: DataFrame, by: Sequence[str]) -> DataFrame:
    """Attach the per-group figures: as one scalar row, or by a null-safe join on the group columns."""
    if not by:
        return df.withColumn("fit", wide.select(F.struct("*")).scalar())
    fitted, small = lookup_table(wide.select(
        *[F.col(k).alias(f"fit__{k}") for k in by], F.struct(*[c for c in wide.columns if c not in by]).alias("fit")
    ))
    on = [F.col(k).eqNullSafe(F.col(f"fit__{k}")) for k in by]
    return df.join(hinted(fitted, small), on).drop(*[f"fit__{k}" for k in by])


def _figures(df: DataFrame, cols: Sequence[str], by: Sequence[str], fitted: DataFrame, fit_cols: Sequence[str],
             counted) -> DataFrame:
    """Second pass: conditional aggregates against the fitted figures, all columns in one scan."""
    wide = _wide_row(fitted, cols, by, fit_cols)
    slim = df.select(*by, *[as_double(c).alias(c) for c in cols])
    marked = _with_group_row(slim, wide, by)
    aggs, names = [], []
    for i, c in enumerate(cols):
        per_column = counted(F.col(c), {m: F.col("fit").getField(f"{m}__{i}") for m in fit_cols})
        names = list(per_column)
        aggs += [agg.alias(f"{n}__{i}") for n, agg in per_column.items()]
        aggs += [F.first(F.col("fit").getField(f"{m}__{i}")).alias(f"{m}__{i}") for m in fit_cols]
    return wide_to_rows(marked.groupBy(*by).agg(*aggs), by, cols, [*fit_cols, *names])


def iqr_outliers(
    df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), fence: float = FENCE, all_columns: bool = False, **options
) -> DataFrame:
    """Quartiles, fences and outlier counts. Columns without outliers are left out unless `all_columns`."""
    cols = present(df, cols)
    fit_cols = ["q1", "q3", "iqr", "lower_bound", "upper_bound"]

    def counted(v: Column, fit: dict[str, Column]) -> dict[str, Column]:
        outside = (v < fit["lower_bound"]) | (v > fit["upper_bound"])
        return {
            "n": F.count(v), "outliers": F.count_if(outside), "data_min": F.min(v), "data_max": F.max(v),
            "outlier_min": F.min(F.when(outside, v)), "outlier_max": F.max(F.when(outside, v)),
        }

    rows = _figures(df, cols, by, iqr_bounds(df, cols, by, fence, **options), fit_cols, counted)
    rows = rows.where("n > 0").withColumn("pct", percent(F.col("outliers"), F.col("n")))
    return rows if all_columns else rows.where("outliers > 0")


def zscore_outliers(
    df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), limit: float = Z_LIMIT, all_columns: bool = False
) -> DataFrame:
    """Values more than `limit` population standard deviations from the mean; a constant column has none."""
    cols = present(df, cols)
    fitted = summarise(df, cols, {
        "mean": lambda c: F.avg(as_double(c)), "std": lambda c: F.stddev_pop(as_double(c)),
    }, by)

    def counted(v: Column, fit: dict[str, Column]) -> dict[str, Column]:
        extreme = F.abs(F.try_divide(v - fit["mean"], fit["std"])) > limit
        return {
            "n": F.count(v), "outliers": F.count_if(extreme),
            "outlier_min": F.min(F.when(extreme, v)), "outlier_max": F.max(F.when(extreme, v)),
        }

    rows = _figures(df, cols, by, fitted, ["mean", "std"], counted)
    rows = rows.where("n > 0").withColumn("pct", percent(F.col("outliers"), F.col("n")))
    return rows if all_columns else rows.where("outliers > 0")


def box_plot_figures(
    df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), fence: float = FENCE, **options
) -> DataFrame:
    """Quartiles, whiskers at the most extreme values inside the fences, and the number of points beyond."""
    cols = present(df, cols)

    def counted(v: Column, fit: dict[str, Column]) -> dict[str, Column]:
        low, high = fit["lower_bound"], fit["upper_bound"]
        return {
            "n": F.count(v),
            "whisker_low": F.min(F.when(v >= low, v)), "whisker_high": F.max(F.when(v <= high, v)),
            "fliers": F.count_if((v < low) | (v > high)),
        }

    fit_cols = ["q1", "q2", "q3", "lower_bound", "upper_bound"]
    rows = _figures(df, cols, by, iqr_bounds(df, cols, by, fence, **options), fit_cols, counted)
    return rows.where("n > 0").drop("lower_bound", "upper_bound")


def outlier_summary(iqr: DataFrame, zscore: DataFrame) -> DataFrame:
    """Variables flagged by either method, with each method's count and percent."""
    left = iqr.select("variable", F.col("outliers").alias("iqr_outliers"), F.col("pct").alias("iqr_pct"))
    right = zscore.select("variable", F.col("outliers").alias("z_outliers"), F.col("pct").alias("z_pct"))
    return left.join(right, "variable", "full")


def limit_outliers(
    df: DataFrame, cols: Sequence[str], action: str = "drop", fence: float = FENCE, **options
) -> DataFrame:
    """Drop rows outside the fences of any column, or clip the values to the fences. NULL stays."""
    cols = present(df, cols)
    bounds = iqr_bounds(df, cols, (), fence, **options).collect()  # one row per column
    by_name = {r["variable"]: r for r in bounds if r["q1"] is not None}
    if action == "clip":
        return df.withColumns({
            c: F.when(F.col(c).isNotNull(), F.greatest(F.lit(r["lower_bound"]), F.least(F.lit(r["upper_bound"]), F.col(c))))
            for c, r in by_name.items()
        })
    if action != "drop":
        raise ValueError("action must be 'drop' or 'clip'")
    inside = [F.col(c).isNull() | F.col(c).between(r["lower_bound"], r["upper_bound"]) for c, r in by_name.items()]
    return df.where(reduce(lambda a, b: a & b, inside)) if inside else df


def range_violations(df: DataFrame, bounds: Sequence[tuple[str, float | None, float | None]]) -> DataFrame:
    """Per `(column, low, high)` bound, the number of known and of out-of-range values, one scan."""
    bounds = [b for b in bounds if b[0] in df.columns]
    limits = {c: (low, high) for c, low, high in bounds}
    return summarise(df, list(limits), {
        "n": lambda c: F.count(F.col(c)),
        "low": lambda c: F.max(F.lit(limits[c][0]).cast("double")),
        "high": lambda c: F.max(F.lit(limits[c][1]).cast("double")),
        "out_of_range": lambda c: F.count_if(_outside(c, *limits[c])),
    })


def _outside(c: str, low: float | None, high: float | None) -> Column:
    tests = []
    if low is not None:
        tests.append(F.col(c) < F.lit(low))
    if high is not None:
        tests.append(F.col(c) > F.lit(high))
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def enforce_ranges(
    df: DataFrame, bounds: Sequence[tuple[str, float | None, float | None]], action: str = "null"
) -> DataFrame:
    """Out-of-range values become NULL, or their rows are dropped."""
    bounds = [b for b in bounds if b[0] in df.columns]
    if action == "null":
        return df.withColumns({c: F.when(~_outside(c, lo, hi), F.col(c)) for c, lo, hi in bounds})
    if action != "drop":
        raise ValueError("action must be 'null' or 'drop'")
    for c, lo, hi in bounds:
        df = df.where(F.col(c).isNull() | ~_outside(c, lo, hi))
    return df
