"""Size checks that decide between a one-task plan and a distributed plan."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tabprep.session import materialise

# Below this planned input size one task may hold every distinct value of a column.
ONE_TASK_BYTES = 32 * 1024 * 1024
# A table with at most this many rows may be sent to every executor.
SMALL_ROWS = 100_000


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate for `df`; no job runs. Unknown sources come out as very large."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def fits_one_task(df: DataFrame, limit: int = ONE_TASK_BYTES) -> bool:
    return plan_bytes(df) <= limit


def collect_bounded(df: DataFrame, limit: int) -> list[Row] | None:
    """All rows when there are at most `limit` of them, else None. Never pulls more than `limit + 1` rows."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def local_table(spark: SparkSession, rows: Sequence[tuple | Row], schema: str | T.StructType) -> DataFrame:
    """A table of a few rows that the planner sees whole: its size is known, and scanning it needs no job."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = schema.names
    records = [r.asDict(recursive=True) if isinstance(r, Row) else dict(zip(names, r)) for r in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=to_arrow_schema(schema)), schema)


def lookup_table(df: DataFrame, limit: int = SMALL_ROWS) -> tuple[DataFrame, bool]:
    """Fix a fitted table: (local rows, True) when it has at most `limit` rows, else (checkpointed table, False)."""
    rows = collect_bounded(df, limit)
    if rows is None:
        return materialise(df), False
    return local_table(df.sparkSession, rows, df.schema), True


def hinted(table: DataFrame, small: bool) -> DataFrame:
    """Broadcast a table proven small; leave any other to the planner and its skew handling."""
    return F.broadcast(table) if small else table
