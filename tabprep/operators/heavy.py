"""The most frequent values of a column in bounded memory, exactly.

Every partition keeps `counters` Misra-Gries counters: a value that finds no free counter takes one off all of them. What a value
may have lost that way is known per partition, so the sum over partitions bounds the true count of every value, kept or not. The
survivors, a bounded number, are counted exactly in a second pass with partial sums; no other value enters a shuffle. If the k-th
exact count does not exceed what a value that is no survivor may have, counters grow, and at last all values are counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.session import materialise

COUNTERS = 10_000
GROW = 16  # counters grow by this factor, once
SURVIVORS = 100_000  # sent to every executor


def _summaries(values: DataFrame, counters: int) -> DataFrame:
    """(value, n, lost): what each partition's counters hold; one row without a value tells what any value may have lost."""
    kind = values.schema.fields[0].dataType
    schema = T.StructType([T.StructField("value", kind), T.StructField("n", T.LongType()), T.StructField("lost", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        lost = 0
        for batch in batches:
            counted = pc.value_counts(batch.column(0))
            rows = pa.table({"value": counted.field("values"), "n": counted.field("counts")})
            held = rows if held is None else pa.concat_tables([held, rows]).group_by("value").aggregate([("n", "sum")]).rename_columns(["value", "n"])
            if held.num_rows > counters:
                # As many single takings as bring the number of counters back: the count behind the last one that stays.
                n = held.column("n").to_numpy()
                cut = int(np.partition(n, held.num_rows - counters - 1)[held.num_rows - counters - 1])
                lost += cut
                keep = n > cut
                held = held.filter(pa.array(keep))
                held = held.set_column(1, "n", pa.array(held.column("n").to_numpy() - cut, pa.int64()))
        if held is not None:
            n = held.num_rows
            yield from pa.table([held.column("value"), held.column("n"), pa.nulls(n, pa.int64())], names=schema.names).to_batches()
            yield pa.RecordBatch.from_arrays([pa.nulls(1, held.schema.field(0).type), pa.nulls(1, pa.int64()), pa.array([lost], pa.int64())], names=schema.names)

    return values.mapInArrow(run, schema)


def heavy_hitters(df: DataFrame, col: str, k: int = 10, counters: int = COUNTERS) -> DataFrame:
    """(value, n) of the k most frequent known values, most frequent first, ties by value; always exact."""
    values = df.select(F.col(f"`{col}`").alias("value")).where("value IS NOT NULL")
    for _ in range(2):
        summary = materialise(_summaries(values, counters))
        merged = summary.where("lost IS NULL").groupBy("value").agg(F.sum("n").alias("least"))
        lost = summary.agg(F.coalesce(F.sum("lost"), F.lit(0))).first()[0]
        # A value's count is at least `least` and at most `least` + `lost`; the k-th largest lower bound is a floor.
        floors = [r["least"] for r in merged.orderBy(F.desc("least")).limit(k).collect()]
        if not floors and not lost:
            return merged.select("value", F.col("least").alias("n"))
        floor = floors[-1] if len(floors) == k else 0
        survivors = merged.where(F.col("least") + lost >= floor).select(F.col("value").alias("survivor"))
        if survivors.limit(SURVIVORS + 1).count() <= SURVIVORS:
            counted = values.join(F.broadcast(survivors), F.col("value") == F.col("survivor"), "left_semi").groupBy("value").agg(
                F.count(F.lit(1)).alias("n"))
            best = materialise(counted.orderBy(F.desc("n"), "value").limit(k))
            last = best.agg(F.count(F.lit(1)), F.min("n")).first()
            # Nothing was lost: all values are survivors. Else the k-th must exceed whatever was left out.
            if not lost or (last[0] == k and last[1] > lost):
                return best.orderBy(F.desc("n"), "value")
        counters *= GROW
    return values.groupBy("value").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value").limit(k)
