"""Data profiling. Every report is a small DataFrame from column-pruned, partially aggregated scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabprep.functions.columns import any_of, missing_count, numeric_columns, percent, present
from tabprep.functions.quantiles import exact_quantiles, median_of
from tabprep.functions.summaries import as_double, modes, summarise, value_frequencies, value_text
from tabprep.sizing import local_table


def column_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A1: min, max, mean, sample deviation and missing count per column."""
    return summarise(df, cols, {
        "min": lambda c: F.min(as_double(c)),
        "max": lambda c: F.max(as_double(c)),
        "mean": lambda c: F.avg(as_double(c)),
        "std": lambda c: F.stddev_samp(as_double(c)),
        "missing": lambda c: F.count_if(F.col(c).isNull()),
    })


def range_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A5: min, max and mean per column."""
    return column_summary(df, cols).select("variable", "min", "max", "mean")


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    """A2: count and percent of the known classes, ordered by class."""
    counts = df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # over one row per class
    return counts.withColumn("pct", percent(F.col("n"), total)).orderBy(target)


def imbalance_ratio(df: DataFrame, target: str, positive=1, negative=0) -> DataFrame:
    """Positives per negative."""
    return df.agg(
        F.count_if(F.col(target) == positive).alias("positive"), F.count_if(F.col(target) == negative).alias("negative")
    ).withColumn("ratio", F.try_divide(F.col("positive").cast("double"), F.col("negative").cast("double")))


def value_counts(df: DataFrame, col: str, top: int | None = None) -> DataFrame:
    """Frequency of each known value, most frequent first, ties by value; `top` limits the report."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    ordered = counts.orderBy(F.col("n").desc(), F.col(col))
    return ordered.limit(top) if top is not None else ordered


def distinct_counts(df: DataFrame, cols: Sequence[str], approximate: bool = False) -> DataFrame:
    """A4: number of distinct known values per column, spread by (column, value); a sketch in one scan on request."""
    if approximate:
        return summarise(df, cols, {"distinct": lambda c: F.approx_count_distinct(F.col(c))})
    counted = value_frequencies(df, cols).groupBy("variable").agg(F.count(F.lit(1)).alias("distinct"))
    names = local_table(df.sparkSession, [(c,) for c in cols], "variable string")
    return names.join(counted, "variable", "left").select("variable", F.coalesce("distinct", F.lit(0)).alias("distinct"))


def levels(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct known values."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def column_modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(variable, value as text, n), smallest value on ties."""
    found = modes(value_frequencies(df, cols))
    return found.select("variable", value_text(found, "value").alias("value"), "n")


def medians(df: DataFrame, cols: Sequence[str], **options) -> DataFrame:
    """A10."""
    return median_of(df, cols, **options)


def missing_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing cells and rows per column, zeros included."""
    return summarise(df, list(cols if cols is not None else df.columns), {
        "missing": lambda c: F.count_if(F.col(c).isNull()), "rows": lambda c: F.count(F.lit(1)),
    })


def missing_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Columns with missing cells, count and percent (2 places), worst first."""
    counts = missing_counts(df, cols).where("missing > 0")
    return counts.select(
        "variable", "missing", F.round(percent(F.col("missing"), F.col("rows")), 2).alias("missing_pct")
    ).orderBy(F.col("missing").desc(), "variable")


def missing_totals(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Total missing cells, total cells, percent."""
    cols = list(cols if cols is not None else df.columns)
    sums = df.agg(
        F.coalesce(F.sum(missing_count(cols).cast("bigint")), F.lit(0)).alias("total_missing"),
        (F.count(F.lit(1)) * len(cols)).alias("total_cells"),
    )
    return sums.withColumn("missing_pct", percent(F.col("total_missing"), F.col("total_cells")))


def zero_missing_check(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Total missing cells and a verdict."""
    return missing_totals(df, cols).select("total_missing", (F.col("total_missing") == 0).alias("passed"))


def check_missing(df: DataFrame, cols: Sequence[str] | None = None) -> dict:
    """I6 as a dictionary: totals and the counts of the columns that have missing cells, worst first."""
    rows = missing_counts(df, cols).collect()  # one row per column
    total = sum(r["missing"] for r in rows)
    cells = sum(r["rows"] for r in rows)
    worst = sorted((r for r in rows if r["missing"]), key=lambda r: (-r["missing"], r["variable"]))
    return {
        "total_missing": total,
        "total_cells": cells,
        "missing_pct": total * 100.0 / cells if cells else None,
        "cols_with_missing": {r["variable"]: r["missing"] for r in worst},
    }


def class_descriptives(df: DataFrame, target: str, cols: Sequence[str], **options) -> DataFrame:
    """N, mean, sample deviation, min, median, max per known class and feature."""
    known = df.where(F.col(target).isNotNull())
    basic = summarise(known, cols, {
        "n": lambda c: F.count(F.col(c)),
        "mean": lambda c: F.avg(as_double(c)),
        "std": lambda c: F.stddev_samp(as_double(c)),
        "min": lambda c: F.min(as_double(c)),
        "max": lambda c: F.max(as_double(c)),
    }, [target])
    return basic.join(median_of(known, cols, [target], **options), [target, "variable"])


def describe_all(df: DataFrame, cols: Sequence[str] | None = None, **options) -> DataFrame:
    """Count, unique, top, freq for text; count, mean, std, min, quartiles, max for numbers; NULL elsewhere."""
    cols = list(cols if cols is not None else df.columns)
    numbers = numeric_columns(df.select(*cols))
    others = [c for c in cols if c not in numbers]
    blank = {"unique": "bigint", "top": "string", "freq": "bigint", "mean": "double", "std": "double", "min": "double",
             "q25": "double", "q50": "double", "q75": "double", "max": "double"}

    def shaped(rows: DataFrame) -> DataFrame:
        return rows.select("variable", "count", *[
            (F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in blank.items()
        ])

    parts = []
    if numbers:
        basic = summarise(df, numbers, {
            "count": lambda c: F.count(F.col(c)),
            "mean": lambda c: F.avg(as_double(c)),
            "std": lambda c: F.stddev_samp(as_double(c)),
            "min": lambda c: F.min(as_double(c)),
            "max": lambda c: F.max(as_double(c)),
        })
        quartiles = exact_quantiles(df, numbers, [0.25, 0.5, 0.75], **options).select(
            "variable", F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75")
        )
        parts.append(shaped(basic.join(quartiles, "variable")))
    if others:
        best = F.min(F.struct((-F.col("n")).alias("neg"), F.col("value").alias("value")))
        tops = value_frequencies(df, others).groupBy("variable").agg(
            F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), best.alias("b")
        ).select("variable", "count", "unique", F.col("b.value").alias("value"), (-F.col("b.neg")).alias("freq"))
        tops = tops.withColumn("top", value_text(tops, "value"))
        listed = local_table(df.sparkSession, [(c,) for c in others], "variable string")
        filled = listed.join(tops, "variable", "left").withColumn("count", F.coalesce("count", F.lit(0)))
        parts.append(shaped(filled.withColumn("unique", F.coalesce("unique", F.lit(0)))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def row_reduction(df: DataFrame, kept: Column) -> DataFrame:
    """Rows before and after a filter, removed, percent removed; one scan."""
    counts = df.agg(
        F.count(F.lit(1)).alias("before"), F.count_if(F.coalesce(kept, F.lit(False))).alias("after")
    ).withColumn("removed", F.col("before") - F.col("after"))
    return counts.withColumn("removed_pct", percent(F.col("removed"), F.col("before")))


def type_census(df: DataFrame) -> DataFrame:
    """Number of columns per type, from the schema; categories count as their own type."""
    rows = [
        (f.name, "category" if f.metadata.get("category") else f.dataType.simpleString()) for f in df.schema.fields
    ]
    table = local_table(df.sparkSession, rows, "variable string, type string")
    return table.groupBy("type").agg(F.count(F.lit(1)).alias("columns")).orderBy(F.col("columns").desc(), "type")


def column_types(df: DataFrame) -> DataFrame:
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return local_table(df.sparkSession, rows, "position int, variable string, type string")


def quality_summary(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows, columns, numeric columns, complete and incomplete rows, missing cells; one scan."""
    cols = list(cols if cols is not None else df.columns)
    has_gap = any_of([F.col(c).isNull() for c in cols])
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(F.lit(len(cols))).cast("bigint").alias("columns"),
        F.max(F.lit(len(numeric_columns(df.select(*cols))))).cast("bigint").alias("numeric_columns"),
        F.count_if(~has_gap).alias("complete_rows"),
        F.count_if(has_gap).alias("incomplete_rows"),
        F.coalesce(F.sum(missing_count(cols).cast("bigint")), F.lit(0)).alias("missing_cells"),
    )


def variable_availability(files: DataFrame) -> DataFrame:
    """From (cycle, module, variable, rows), total rows and the sorted cycles per variable."""
    return files.groupBy("variable").agg(
        F.sum("rows").alias("rows"), F.array_join(F.sort_array(F.collect_set("cycle")), ", ").alias("cycles")
    )


def file_variables(spark: SparkSession, tables: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """Input of `variable_availability`: one row per (cycle, module, column), row counts from one stacked count."""
    counts = None
    for (cycle, module), df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(cycle).alias("cycle"), F.lit(module).alias("module"),
            F.explode(F.array(*[F.lit(c) for c in df.columns])).alias("variable"), "rows",
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts


def sparse_columns(df: DataFrame, max_missing_share: float = 0.5) -> list[str]:
    """Columns with more than the given share missing."""
    rows = missing_counts(df).collect()  # one row per column
    return [r["variable"] for r in rows if r["rows"] and r["missing"] > max_missing_share * r["rows"]]


def drop_sparse(df: DataFrame, max_missing_share: float = 0.5) -> DataFrame:
    return df.drop(*sparse_columns(df, max_missing_share))
