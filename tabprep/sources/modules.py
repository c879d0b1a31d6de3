"""Reading and writing module files laid out as `<root>/<cycle>/<module>.parquet`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.functions.columns import file_stem, parent_name, table_path
from tabprep.session import run_together
from tabprep.sizing import local_table

TOGETHER = 16  # tables whose footers are read at once


def read_table(spark: SparkSession, path: str, cols: Sequence[str] | None = None) -> DataFrame:
    """A Parquet table; asking for columns keeps the scan to those."""
    df = spark.read.parquet(path)
    return df.select(*[c for c in cols if c in df.columns]) if cols is not None else df


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Snappy Parquet, optionally one folder per partition value."""
    writer = df.write.mode(mode).option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def discover_files(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """S3: (path, cycle, module, bytes) of every module table below `root`; contents are not read.

    A module is a file `<cycle>/<module>.parquet`, or a folder of that name that Spark wrote.
    """
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    )
    tables = listed.groupBy(table_path(F.col("path")).alias("path")).agg(F.sum("length").alias("bytes"))
    return tables.select(
        "path", parent_name(F.col("path")).alias("cycle"), file_stem(F.col("path")).alias("module"), "bytes"
    )


def open_tables(spark: SparkSession, root: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """{path: table} of the readable tables below `root`, and (path, cycle, module, status, error) of all of them.

    The listing has one row per module table; each footer is read once, several at a time. A bad table does not stop the run.
    """
    listed = discover_files(spark, root).select("path", "cycle", "module").orderBy("cycle", "module").collect()

    def opened(path: str):
        try:
            return spark.read.parquet(path), None
        except Exception as failure:
            return None, str(failure)

    found: list = []
    for begin in range(0, len(listed), TOGETHER):
        found += run_together(spark, *[lambda f=f: opened(f["path"]) for f in listed[begin:begin + TOGETHER]])
    good = {f["path"]: df for f, (df, _) in zip(listed, found) if df is not None}
    outcomes = [(f["path"], f["cycle"], f["module"], "failed" if df is None else "processed", error) for f, (df, error) in zip(listed, found)]
    schema = "path string, cycle string, module string, status string, error string"
    return good, local_table(spark, outcomes, schema)


def probe_tables(spark: SparkSession, root: str) -> tuple[list[str], DataFrame]:
    """The paths of the readable tables, and the outcome of every table."""
    good, outcomes = open_tables(spark, root)
    return list(good), outcomes


def read_tolerant(spark: SparkSession, root: str, merge_schema: bool = True) -> tuple[DataFrame | None, DataFrame]:
    """All readable module tables of a tree in one scan, stacked by name, and the outcome of every table.

    Unreadable tables are left out and listed with their errors; damage that only shows while rows are read fails the
    query, so that no total is quietly short. Adds `cycle` and `module` from each file's place.
    """
    good, outcomes = probe_tables(spark, root)
    if not good:
        return None, outcomes
    df = spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(*good)
    path = table_path(F.col("_metadata.file_path"))
    return df.select("*", parent_name(path).alias("cycle"), file_stem(path).alias("module")), outcomes


def load_summary(outcomes: DataFrame, cycle_col: str = "cycle", status_col: str = "status") -> DataFrame:
    """Files per (cycle, status), with per-cycle totals and one grand total; totals carry NULL names."""
    return (
        outcomes.rollup(cycle_col, status_col)
        .agg(F.count(F.lit(1)).alias("files"), F.grouping_id().alias("level"))
        .select(cycle_col, status_col, F.col("level").cast("int").alias("level"), "files")
    )
