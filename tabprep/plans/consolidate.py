"""All cycles' module tables to one labelled table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.functions.columns import normalise_nan
from tabprep.operators.clean import threshold_label
from tabprep.operators.joins import join_groups, rename_overlap
from tabprep.operators.profile import file_variables, variable_availability
from tabprep.operators.stacking import stack, stack_long
from tabprep.sources.dictionary import ID_COLUMN, readable_names
from tabprep.sources.modules import open_tables, write_table

SUBJECT = "subject_id"
GLUCOSE = "glucose_value"
LABEL = "diabetes_risk"
# Fixed value: HbA1c percent from which the label is 1.
LABEL_THRESHOLD = 5.7

Modules = Mapping[tuple[str, str], DataFrame]


def try_modules(spark: SparkSession, root: str) -> tuple[dict[tuple[str, str], DataFrame], DataFrame]:
    """The readable tables below `root` by (cycle, module), and the outcome of every table."""
    good, outcomes = open_tables(spark, root)
    read = outcomes.where("status = 'processed'").orderBy("cycle", "module").collect()  # one row per module table
    return {(f["cycle"], f["module"]): good[f["path"]] for f in read}, outcomes


def read_modules(spark: SparkSession, root: str) -> dict[tuple[str, str], DataFrame]:
    """S3: {(cycle, module): table} for `<root>/<cycle>/<module>.parquet`, in name order; bad tables are left out."""
    return try_modules(spark, root)[0]


def consolidate_modules(modules: Modules, unique: bool | None = None, null_label: int | None = None) -> DataFrame:
    """L4 without I/O: readable names, full outer join per (cycle, subject), stacked cycles, label.

    With unique subjects per file one exchange serves all modules of all cycles. Overlapping names are resolved
    inside a cycle, because file names of one module differ from cycle to cycle.
    """
    cycles: dict[str, dict[str, DataFrame]] = {}
    for (cycle, module), df in modules.items():
        table = normalise_nan(readable_names(df)).withColumn("cycle", F.lit(cycle))
        cycles.setdefault(cycle, {})[module] = table
    keys = ["cycle", SUBJECT]
    cycles = {cycle: rename_overlap(tables, keys) for cycle, tables in cycles.items()}
    wide = join_groups([list(tables.values()) for tables in cycles.values()], keys, unique)
    if GLUCOSE in wide.columns:
        wide = threshold_label(wide, GLUCOSE, LABEL_THRESHOLD, LABEL, null_label)
    return wide


def consolidate(
    spark: SparkSession, root: str, out: str | None = None, null_label: int | None = None
) -> DataFrame:
    """L4: read the tree, consolidate, write one folder per cycle when `out` is given."""
    wide = consolidate_modules(read_modules(spark, root), null_label=null_label)
    if out is None:
        return wide
    write_table(wide, out, partition_by=["cycle"])
    return spark.read.parquet(out)


def stack_modules(modules: Modules, id_col: str = ID_COLUMN) -> DataFrame:
    """Unjoined module tables with `CYCLE` and `SEQN_UNIQUE`."""
    return stack_long([(cycle, df) for (cycle, _), df in modules.items()], id_col)


def availability_report(spark: SparkSession, modules: Modules) -> DataFrame:
    """A22."""
    return variable_availability(file_variables(spark, modules))
