"""Row-local cleaning: filters, recodes, labels, rules and bins. Nothing here shuffles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.functions.columns import any_of, interval_label, number_or_null, present


def require_value(df: DataFrame, target: str) -> DataFrame:
    """P10: keep rows whose target is known; unchanged when the column is absent."""
    return df.where(F.col(target).isNotNull()) if target in df.columns else df


def sentinel_to_null(df: DataFrame, cols: Sequence[str], sentinel: float = 0) -> DataFrame:
    """A code that stands for 'not measured' becomes NULL."""
    return df.withColumns({c: F.when(F.col(c) != F.lit(sentinel), F.col(c)) for c in present(df, cols)})


def drop_ids(df: DataFrame, id_cols: Sequence[str] = ("subject_id",)) -> DataFrame:
    """P12."""
    return df.drop(*id_cols)


def recode_yes_no(df: DataFrame, cols: Sequence[str], yes: float = 1, null_as: int | None = 0) -> DataFrame:
    """The yes code becomes 1 and any other answer, text included, 0; a missing answer becomes `null_as`."""
    def flag(c: str) -> Column:
        return (
            F.when(number_or_null(df, c) == F.lit(float(yes)), F.lit(1)).when(F.col(c).isNotNull(), F.lit(0))
            .otherwise(F.lit(null_as)).cast("bigint")
        )

    return df.withColumns({c: flag(c) for c in present(df, cols)})


def to_integer(df: DataFrame, cols: Sequence[str], strict: bool = False) -> DataFrame:
    """Truncate to bigint. Missing stays NULL, or fails the job when `strict`."""
    def cast(c: str) -> Column:
        whole = F.col(c).try_cast("bigint")
        if not strict:
            return whole
        return F.when(whole.isNull(), F.raise_error(F.lit(f"{c} has a value that is not an integer"))).otherwise(whole)

    return df.withColumns({c: cast(c) for c in present(df, cols)})


def mark_category(df: DataFrame, cols: Sequence[str], levels: Mapping[str, Sequence] | None = None) -> DataFrame:
    """Keep the type, record in the column metadata that the values are categories."""
    for c in present(df, cols):
        metadata = {"category": True}
        if levels and c in levels:
            metadata["levels"] = list(levels[c])
        df = df.withMetadata(c, metadata)
    return df


def category_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.metadata.get("category")]


def threshold_label(
    df: DataFrame, source: str, threshold: float, label: str, null_label: int | None = None
) -> DataFrame:
    """1 at or above the threshold, else 0; an unknown value gets `null_label`."""
    above = (F.col(source) >= F.lit(threshold)).cast("bigint")
    if null_label is not None:
        above = F.coalesce(above, F.lit(null_label).cast("bigint"))
    return df.withColumn(label, above)


def fill_derived(df: DataFrame, target: str, formula: Column, needs: Sequence[str]) -> DataFrame:
    """Compute a missing target from other columns; unchanged unless all columns exist."""
    if len(present(df, [target, *needs])) < 1 + len(needs):
        return df
    return df.withColumn(target, F.coalesce(F.col(target), formula))


def body_mass_index(weight_kg: str, height_cm: str) -> Column:
    metres = F.col(height_cm) / F.lit(100.0)
    return F.try_divide(F.col(weight_kg), metres * metres)


def fill_bmi(df: DataFrame, bmi: str = "bmi", weight: str = "weight_kg", height: str = "height_cm") -> DataFrame:
    return fill_derived(df, bmi, body_mass_index(weight, height), [weight, height])


def apply_rules(df: DataFrame, rules: Sequence[tuple[Column, str, object]]) -> DataFrame:
    """`(predicate, column, value)` rules in order; a later rule sees what an earlier one wrote."""
    for predicate, column, value in rules:
        if column in df.columns:
            kept = F.col(column)
            df = df.withColumn(
                column, F.when(predicate, F.lit(value).cast(df.schema[column].dataType)).otherwise(kept)
            )
    return df


def blood_pressure_rules(
    df: DataFrame,
    flag: str = "hypertension",
    systolic: str = "BPX_SYS",
    diastolic: str = "BPX_DIA",
    age: str = "age_years",
) -> list[tuple[Column, str, object]]:
    """The two domain rules; a rule whose columns are absent is left out."""
    rules = []
    if len(present(df, [flag, systolic, diastolic])) == 3:
        rules.append((any_of([F.col(systolic) > 140, F.col(diastolic) > 90]), flag, 1))
    if len(present(df, [flag, age])) == 2:
        rules.append((F.col(flag).isNull() & (F.col(age) > 60), flag, 1))
    return rules


def rule_hits(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows hit by each named predicate, one scan."""
    counts = df.agg(*[F.count_if(F.coalesce(p, F.lit(False))).alias(f"hits__{i}") for i, p in enumerate(rules.values())])
    entries = [F.struct(F.lit(n).alias("rule"), F.col(f"hits__{i}").alias("hits")) for i, n in enumerate(rules)]
    return counts.select(F.inline(F.array(*entries)))


def extreme_rows(df: DataFrame, limits: Sequence[tuple[str, str, float]]) -> DataFrame:
    """Rows where any `(column, '>' or '<', bound)` test holds; absent columns are skipped."""
    tests = []
    for c, op, bound in limits:
        if c in df.columns:
            tests.append(F.col(c) > F.lit(bound) if op == ">" else F.col(c) < F.lit(bound))
    return df.where(any_of(tests))


# Clinically suspicious bounds, with and without the diastolic test.
EXTREME_LIMITS = [
    ("bmi", ">", 90),
    ("total_cholesterol", ">", 800),
    ("TRIGLY", ">", 4000),
    ("BPX_SYS", "<", 60),
    ("BPX_DIA", "<", 40),
]
EXTREME_LIMITS_WITHOUT_DIASTOLIC = EXTREME_LIMITS[:4]

# Age bands, right-closed.
AGE_EDGES = [0, 18, 35, 50, 65, 100]
AGE_LABELS = ["< 18", "18-34", "35-49", "50-64", "65+"]


def bin_column(
    df: DataFrame, source: str, out: str, edges: Sequence[float], labels: Sequence[str], closed: str = "right"
) -> DataFrame:
    """P22."""
    return df.withColumn(out, interval_label(F.col(source), edges, labels, closed))


def complete_cases(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows without a NULL."""
    return df.na.drop("any", subset=list(cols) if cols is not None else None)


def incomplete_cases(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows with at least one NULL."""
    return df.where(any_of([F.col(c).isNull() for c in (cols if cols is not None else df.columns)]))
