"""Operator 6, sharding: global prefix sums of byte sizes, cut at equal targets.

Rows are range-partitioned by the order columns and fixed in a table with their slice number. Slice totals (one row per
slice) give each slice its first byte and first row; a running sum inside the slice does the rest. A row goes to the
shard that holds the middle byte of the row, so shards are contiguous in the order and differ from the equal target by
at most one row at either end. Full rows never meet in one task, and only the columns given in `df` are shuffled.

Defined cases: a null text has no bytes, null keys come first, rows that tie in all order columns are told apart by the
hash of all their columns (fully equal rows are interchangeable), an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.llm.text import quoted, with_outputs
from tabprep.session import materialise


def byte_size(text_col: str, overhead: int = 8) -> Column:
    return (F.coalesce(F.octet_length(quoted(text_col).cast("string")), F.lit(0)) + overhead).cast("bigint")


def shard_by_bytes(
    df: DataFrame, size_col: str, order_by: Sequence[str], n_shards: int, shard: str = "shard", slot: str = "slot"
) -> DataFrame:
    """Add the shard number (0 to `n_shards` - 1) and the gapless position in the shard, from 0.

    `size_col` must be a bigint without nulls or negative values.
    """
    kept = [c for c in df.columns if c.lower() not in (shard.lower(), slot.lower())]
    keyed = with_outputs(df, shard__tie=F.xxhash64(*[quoted(c) for c in df.columns]))
    order = [*[quoted(c) for c in order_by], F.col("shard__tie")]
    placed = materialise(keyed.repartitionByRange(*order).withColumn("shard__slice", F.spark_partition_id()))

    size = quoted(size_col)
    totals = placed.groupBy("shard__slice").agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("rows"))
    # One row per slice of the range partitioning: a few thousand numbers at any size.
    before, every = Window.orderBy("shard__slice"), Window.partitionBy()
    starts = totals.select(
        F.col("shard__slice").alias("shard__of"),
        (F.sum("bytes").over(before) - F.col("bytes")).alias("shard__bytes_before"),
        (F.sum("rows").over(before) - F.col("rows")).alias("shard__rows_before"),
        F.sum("bytes").over(every).alias("shard__total"),
    )
    inside = Window.partitionBy("shard__slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    located = placed.select(
        "*", F.sum(size).over(inside).alias("shard__sum"), F.row_number().over(inside).alias("shard__row")
    ).join(F.broadcast(starts), F.col("shard__slice") == F.col("shard__of"))
    # Twice the middle byte, so that all is whole numbers.
    middle = 2 * (F.col("shard__bytes_before") + F.col("shard__sum")) - size
    numbered = with_outputs(
        located,
        shard__middle=middle,
        shard__index=F.col("shard__rows_before") + F.col("shard__row") - 1,
    )
    numbered = with_outputs(numbered, shard__no=F.expr(
        f"cast(if(shard__total = 0, 0, least({n_shards - 1}, shard__middle * {n_shards} div (2 * shard__total))) as int)"))
    first = numbered.groupBy("shard__no").agg(F.min("shard__index").alias("shard__first"))  # n_shards rows
    return numbered.join(F.broadcast(first), "shard__no").select(
        *[quoted(c) for c in kept],
        F.col("shard__no").alias(shard),
        (F.col("shard__index") - F.col("shard__first")).cast("bigint").alias(slot),
    )
