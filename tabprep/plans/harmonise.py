"""One raw module table to its harmonised form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tabprep.functions.columns import coerce_numeric
from tabprep.sizing import local_table
from tabprep.sources.dictionary import ALIASES, ID_COLUMN, VARIABLES, coalesce_aliases, flat_variables_for_cycle
from tabprep.sources.modules import write_table


@dataclass(frozen=True)
class Verdict:
    """May the table be used, and if not why."""

    ok: bool
    reason: str | None = None

    def to_table(self, spark: SparkSession) -> DataFrame:
        return local_table(spark, [(self.ok, self.reason)], "ok boolean, reason string")


def gate_module(
    df: DataFrame, cycle: str | None, rows: Sequence[tuple] = tuple(VARIABLES), id_col: str = ID_COLUMN,
    check_rows: bool = True,
) -> Verdict:
    """Empty table, missing id column, missing cycle, no wanted variable. Only the first needs a (one-row) job."""
    if check_rows and df.isEmpty():
        return Verdict(False, "no rows")
    if id_col not in df.columns:
        return Verdict(False, f"{id_col} not found")
    if not cycle:
        return Verdict(False, "cycle not given")
    if not any(v in df.columns for v in flat_variables_for_cycle(cycle, rows)):
        return Verdict(False, "no target variables")
    return Verdict(True)


def harmonise_module(
    df: DataFrame,
    cycle: str,
    rows: Sequence[tuple] = tuple(VARIABLES),
    id_col: str = ID_COLUMN,
    aliases: Mapping[str, Sequence[str]] = ALIASES,
) -> DataFrame:
    """L3 without I/O: P1 valid variables, P2 pruning, P4 numeric coercion, P5 canonical names. One projection."""
    wanted = [v for v in flat_variables_for_cycle(cycle, rows) if v in df.columns]
    return coalesce_aliases(coerce_numeric(df.select(id_col, *wanted), wanted), aliases)


def clean_module(
    df: DataFrame, cycle: str | None, path: str, rows: Sequence[tuple] = tuple(VARIABLES), id_col: str = ID_COLUMN
) -> Verdict:
    """L3: gate, harmonise, write."""
    verdict = gate_module(df, cycle, rows, id_col)
    if verdict.ok:
        write_table(harmonise_module(df, cycle, rows, id_col), path)
    return verdict
