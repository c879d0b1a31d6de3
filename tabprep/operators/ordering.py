"""Working in a global row order without one task holding the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabprep.session import materialise

SLICE = "order__slice"


def order_slices(df: DataFrame, order_by: Sequence[str], slices: int | None = None) -> DataFrame:
    """Range-partition by the order columns and fix each row's slice number in a checkpoint.

    Slice numbers ascend with the order. The checkpoint makes them stable, so later steps can agree on them. Without
    `slices` the session's shuffle partitions set the number, and adaptive execution merges small ones.
    """
    ranged = (
        df.repartitionByRange(slices, *order_by) if slices is not None else df.repartitionByRange(*order_by)
    )
    return materialise(ranged.withColumn(SLICE, F.spark_partition_id()))


def with_row_index(df: DataFrame, order_by: Sequence[str], out: str = "row_index", slices: int | None = None) -> DataFrame:
    """0-based position of each row in the given order. The order columns must identify rows."""
    sliced = order_slices(df, order_by, slices)
    # One row per slice: a handful of numbers, whatever the table's size.
    starts = (
        sliced.groupBy(SLICE).agg(F.count(F.lit(1)).alias("rows"))
        .select(F.col(SLICE).alias("slice"),
                (F.sum("rows").over(Window.orderBy(SLICE)) - F.col("rows")).alias("start"))
    )
    local = F.row_number().over(Window.partitionBy(SLICE).orderBy(*order_by)) - 1
    return (
        sliced.withColumn("local", local)
        .join(F.broadcast(starts), F.col(SLICE) == F.col("slice"))
        .withColumn(out, (F.col("start") + F.col("local")).cast("bigint"))
        .drop(SLICE, "slice", "start", "local")
    )


def first_rows(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """The first rows in the order."""
    return df.orderBy(*order_by).limit(n)


def last_rows(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """The last rows, shown in ascending order."""
    return df.orderBy(*[F.col(c).desc() for c in order_by]).limit(n).orderBy(*order_by)
