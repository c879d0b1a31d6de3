"""Row accounting that rides on the job which does the work (A24, A26, A27, S7), by Spark's observed metrics.

A ledger hangs counters on the plan at any point. They are filled by whichever action runs the plan, so rows before and after a
filter, rule hits, imputed cells and rows per file cost no scan of their own.

Give a ledger tables of a session of its own (`spark.newSession()`): a session that has observed can no longer be sent to tasks,
which Spark's evaluators of classifiers do.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tabprep.sizing import local_table


class Ledger:
    """Counters of one run: hang them on a plan, run the plan, then ask for the report."""

    def __init__(self) -> None:
        self._kept: list[tuple[str, list[str], Observation]] = []

    def _observe(self, df: DataFrame, step: str, counts: Mapping[str, Column]) -> DataFrame:
        if not counts:
            return df
        observation = Observation(f"ledger-{len(self._kept)}-{step}")
        self._kept.append((step, list(counts), observation))
        # Short names: a rule's or a column's name may hold anything.
        return df.observe(observation, *[c.alias(f"m{n}") for n, c in enumerate(counts.values())])

    def rows(self, df: DataFrame, step: str) -> DataFrame:
        """Count the rows that pass here."""
        return self._observe(df, step, {"rows": F.count(F.lit(1))})

    def keep(self, df: DataFrame, step: str, kept: Column) -> DataFrame:
        """Filter, and count rows before and after in passing. NULL conditions do not keep."""
        kept = F.coalesce(kept, F.lit(False))
        return self._observe(df, step, {"before": F.count(F.lit(1)), "after": F.count_if(kept)}).where(kept)

    def rules(self, df: DataFrame, step: str, rules: Mapping[str, Column]) -> DataFrame:
        """Rows each named predicate hits."""
        return self._observe(df, step, {n: F.count_if(F.coalesce(p, F.lit(False))) for n, p in rules.items()})

    def missing(self, df: DataFrame, step: str, cols: Sequence[str]) -> DataFrame:
        """Missing cells per column; call it before and after an imputation."""
        return self._observe(df, step, {c: F.count_if(F.col(f"`{c}`").isNull()) for c in cols})

    def report(self, spark: SparkSession) -> DataFrame:
        """(step, name, value) in the order the counters were hung; run the plan first. No job runs here.

        Counters below an action that never reads them (an empty cached branch, say) are reported as NULL.
        """
        rows = []
        for step, names, observation in self._kept:
            got = observation.get
            rows += [(step, name, got.get(f"m{n}")) for n, name in enumerate(names)]
        return local_table(spark, rows, "step string, name string, value bigint")


def imputed_cells(report: DataFrame, before: str, after: str) -> DataFrame:
    """A26 from a ledger's report: (variable, missing_before, missing_after, imputed)."""
    def part(step: str, out: str) -> DataFrame:
        return report.where(F.col("step") == step).select(F.col("name").alias("variable"), F.col("value").alias(out))

    both = part(before, "missing_before").join(part(after, "missing_after"), "variable")
    return both.withColumn("imputed", F.col("missing_before") - F.col("missing_after"))
