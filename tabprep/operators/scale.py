"""Standard scaling: fit on one table, apply to any."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.functions.columns import present
from tabprep.functions.summaries import as_double, summarise
from tabprep.sizing import local_table


@dataclass(frozen=True)
class Scaler:
    """`(x - mean) / std` with the population deviation; a constant column is only centred."""

    figures: dict[str, tuple[float | None, float | None]]

    def transform(self, df: DataFrame) -> DataFrame:
        made = {}
        for c in present(df, self.figures):
            mean, std = self.figures[c]
            if mean is not None:
                made[c] = (as_double(c) - F.lit(mean)) / F.lit(std or 1.0)
        return df.withColumns(made)

    def to_table(self, spark: SparkSession) -> DataFrame:
        """The fitted figures as a table."""
        rows = [(c, m, s) for c, (m, s) in self.figures.items()]
        return local_table(spark, rows, "variable string, mean double, std double")


def fit_scaler(df: DataFrame, cols: Sequence[str]) -> Scaler:
    rows = summarise(df, present(df, cols), {
        "mean": lambda c: F.avg(as_double(c)), "std": lambda c: F.stddev_pop(as_double(c)),
    }).collect()  # one row per column
    return Scaler({r["variable"]: (r["mean"], r["std"]) for r in rows})
