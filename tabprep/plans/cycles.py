"""A consolidated table whose cycles are rewritten one by one.

The table has one folder per cycle. Rewriting a cycle replaces its folder only (dynamic partition overwrite), in one job that
reads that cycle's modules and nothing else. A manifest beside the table says for each cycle what was written, and is itself
kept by cycle in the same way. Columns that only some cycles have are NULL in the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.operators.ledger import Ledger
from tabprep.plans.consolidate import consolidate_modules, read_modules
from tabprep.sizing import local_table

# Readers skip folders whose names start with an underscore.
MANIFEST = "_manifest"


def _replace(df: DataFrame, path: str) -> None:
    """Write the partitions that `df` has; the others stay as they are."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("cycle").parquet(path)


def _drop_folder(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def write_cycles(wide: DataFrame, out: str, cycles: Sequence[str]) -> DataFrame:
    """Replace the given cycles of the table at `out` by the rows of `wide`; returns their new manifest rows.

    `wide` must hold no other cycle, and come from a session that may observe (see the ledger). A cycle without rows loses its folder, which a dynamic overwrite would leave.
    """
    spark, ledger = wide.sparkSession, Ledger()
    named = {c: F.col("cycle") == c for c in cycles}
    counted = ledger.rules(ledger.rows(wide, "all"), "cycle", named)
    _replace(counted, out)
    report = {(r["step"], r["name"]): r["value"] for r in ledger.report(spark).collect()}
    rows = {c: report["cycle", c] or 0 for c in cycles}
    if sum(rows.values()) != (report["all", "rows"] or 0):
        raise ValueError("the table holds rows of a cycle that is not rewritten")
    for c, n in rows.items():
        if not n:
            _drop_folder(spark, f"{out}/cycle={c}")
    columns = len(wide.columns)
    written = local_table(spark, [(c, n, columns) for c, n in rows.items()], "cycle string, rows bigint, columns int").withColumn(
        "written_at", F.current_timestamp())
    _replace(written.coalesce(1), f"{out}/{MANIFEST}")
    return written


def manifest(spark: SparkSession, out: str) -> DataFrame:
    """(cycle, rows, columns, written_at): what the last write of each cycle left."""
    return spark.read.parquet(f"{out}/{MANIFEST}").select("cycle", "rows", "columns", "written_at")


def read_cycles(spark: SparkSession, out: str) -> DataFrame:
    """The whole table, with the columns of all cycles."""
    return spark.read.option("mergeSchema", "true").parquet(out)


def rewrite_cycles(
    spark: SparkSession, root: str, out: str, cycles: Sequence[str] | None = None, null_label: int | None = None
) -> DataFrame:
    """L4 for some cycles (all of them by default): read their modules, consolidate, replace their folders; the new manifest."""
    spark = spark.newSession()  # see the ledger
    if cycles is None:
        modules = read_modules(spark, root)
        cycles = sorted({c for c, _ in modules})
    else:
        modules = {k: df for c in cycles for k, df in read_modules(spark, f"{root}/{c}").items()}
    if not modules:
        raise ValueError("no readable module of these cycles")
    return write_cycles(consolidate_modules(modules, null_label=null_label), out, cycles)
