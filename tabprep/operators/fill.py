"""Ordered fill: last known value before, else first known value after."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabprep.functions.columns import present
from tabprep.operators.ordering import SLICE, order_slices

# Up to this many rows of one key are filled inside one window.
GROUP_ROWS = 2_000_000


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the most frequent key: a partially aggregated count over the key columns."""
    row = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()
    return row[0] or 0


def fill_in_order(
    df: DataFrame,
    cols: Sequence[str],
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    strategy: str = "auto",
    group_rows: int = GROUP_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """Forward fill, then backward fill for the start of each series.

    `strategy='window'` keeps each series in one window. `'slices'` cuts the whole order into ranges, fills inside
    each range, and carries known values across ranges, so a single long series is spread too. `'auto'` measures
    the longest series and chooses.
    """
    cols = present(df, cols)
    if not cols:
        return df
    if strategy == "auto":
        short = bool(partition_by) and largest_group(df, partition_by) <= group_rows
        strategy = "window" if short else "slices"
    if strategy == "window":
        return _fill_window(df, cols, list(order_by), list(partition_by))
    if strategy == "slices":
        return _fill_slices(df, cols, list(order_by), list(partition_by), slices)
    raise ValueError("strategy must be 'auto', 'window' or 'slices'")


def _spans(keys: Sequence[str], order_by: Sequence[str]):
    """Rows up to this one, and the whole series.

    Only rows before the first known value need a later one, and for all of them it is the first of the series. So the
    backward fill reads the whole series once instead of the rest of it per row, which would be quadratic.
    """
    ordered = Window.partitionBy(*keys).orderBy(*order_by)
    return (
        ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow),
        ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing),
    )


def _fill_window(df: DataFrame, cols: list[str], order_by: list[str], keys: list[str]) -> DataFrame:
    before, series = _spans(keys, order_by)
    return df.withColumns({
        c: F.coalesce(F.last(c, ignorenulls=True).over(before), F.first(c, ignorenulls=True).over(series)) for c in cols
    })


def _fill_slices(
    df: DataFrame, cols: list[str], order_by: list[str], keys: list[str], slices: int | None
) -> DataFrame:
    sliced = order_slices(df, [*keys, *order_by], slices)
    position = F.struct(*order_by)
    group = [SLICE, *keys]

    def known(c: str):
        return F.when(F.col(c).isNotNull(), position)

    edges = sliced.groupBy(*group).agg(
        *[F.max_by(F.col(c), known(c)).alias(f"last__{i}") for i, c in enumerate(cols)],
        *[F.min_by(F.col(c), known(c)).alias(f"first__{i}") for i, c in enumerate(cols)],
    )
    if keys:
        # Only the first and the last series of a slice can reach into another slice.
        ends = sliced.groupBy(SLICE).agg(F.min(F.struct(*keys)).alias("low"), F.max(F.struct(*keys)).alias("high"))
        ends = ends.select(F.col(SLICE).alias("end__slice"), "low", "high")
        edges = edges.join(F.broadcast(ends), F.col(SLICE) == F.col("end__slice")).where(
            F.struct(*keys).eqNullSafe(F.col("low")) | F.struct(*keys).eqNullSafe(F.col("high"))
        ).drop("end__slice", "low", "high")
    # At most two rows per slice from here on.
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*keys).orderBy(F.col(SLICE).desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(
        *[F.col(k).alias(f"carry__{k}") for k in group],
        *[F.last(f"last__{i}", ignorenulls=True).over(earlier).alias(f"prev__{i}") for i in range(len(cols))],
        *[F.last(f"first__{i}", ignorenulls=True).over(later).alias(f"next__{i}") for i in range(len(cols))],
    )
    on = [F.col(k).eqNullSafe(F.col(f"carry__{k}")) for k in group]
    before, series = _spans(group, order_by)
    filled = sliced.withColumns({
        f"fwd__{i}": F.last(c, ignorenulls=True).over(before) for i, c in enumerate(cols)
    } | {
        f"bwd__{i}": F.first(c, ignorenulls=True).over(series) for i, c in enumerate(cols)
    }).join(F.broadcast(carried), on, "left")
    values = {
        c: F.coalesce(F.col(f"fwd__{i}"), F.col(f"prev__{i}"), F.col(f"bwd__{i}"), F.col(f"next__{i}"))
        for i, c in enumerate(cols)
    }
    return filled.select(*[values[c].alias(c) if c in values else F.col(f"`{c}`") for c in df.columns])
