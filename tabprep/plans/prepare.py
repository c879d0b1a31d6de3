"""The full preparation: clean, type, impute, apply rules, encode. Fitted once, applicable to any batch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.functions.columns import normalise_nan, present
from tabprep.operators.clean import (
    apply_rules, blood_pressure_rules, drop_ids, fill_bmi, require_value, sentinel_to_null,
)
from tabprep.operators.encode import EncodingModel, EncodingPlan
from tabprep.operators.impute import ConstantImputer, fit_median, fit_mode
from tabprep.operators.knn import KnnModel, fit_knn
from tabprep.operators.profile import missing_totals, row_reduction
from tabprep.session import materialise, run_together
from tabprep.plans.typing import CATEGORIES, FLAGS, INTEGERS, define_types

# The column lists of the preparation.
ID_COLUMNS = ["SEQN", "subject_id", "ID"]
KNN_COLUMNS = ["waist_cm", "weight_kg", "height_cm", "bmi"]
MEDIAN_COLUMNS = [
    "creatinine", "bmi", "waist_cm", "weight_kg", "height_cm", "BPX_SYS", "BPX_DIA", "glucose_value",
    "hdl_cholesterol", "total_cholesterol", "TRIGLY", "SLQ",
]
MODE_COLUMNS = [
    "gender", "ethnicity", "smoker", "hypertension", "liver_disease", "heart_disease", "income_poverty_ratio",
]


@dataclass(frozen=True)
class PreparePlan:
    """L2. `keys` identify rows until the nearest-neighbour step; they are dropped from the result with the ids."""

    target: str = "glucose_value"
    sentinels: Mapping[str, float] = field(default_factory=lambda: {"BPX_DIA": 0})
    keys: Sequence[str] = ("cycle", "subject_id")
    id_columns: Sequence[str] = tuple(ID_COLUMNS)
    flags: Sequence[str] = tuple(FLAGS)
    integers: Sequence[str] = tuple(INTEGERS)
    categories: Sequence[str] = tuple(CATEGORIES)
    null_flag: int | None = 0
    knn_columns: Sequence[str] = tuple(KNN_COLUMNS)
    neighbours: int = 5
    median_columns: Sequence[str] = tuple(MEDIAN_COLUMNS)
    mode_columns: Sequence[str] = tuple(MODE_COLUMNS)
    encoding: EncodingPlan = field(default_factory=EncodingPlan)

    def stage(self, df: DataFrame) -> DataFrame:
        """Steps 1, 2, 4 and 5: a filter and projections, no shuffle. Ids stay until the row key is not needed."""
        df = require_value(normalise_nan(df), self.target)
        for column, sentinel in self.sentinels.items():
            df = sentinel_to_null(df, [column], sentinel)
        df = define_types(df, self.flags, self.integers, self.categories, self.null_flag)
        return fill_bmi(df)

    def finish(self, df: DataFrame) -> DataFrame:
        """Step 8, on imputed values."""
        return apply_rules(df, blood_pressure_rules(df))

    def fit(self, df: DataFrame) -> PreparedModel:
        staged = materialise(self.stage(df))  # the input is read once, however many fits follow
        keys = present(staged, self.keys)
        uses_knn = bool(present(staged, self.knn_columns))
        if uses_knn and not keys:
            raise ValueError("nearest-neighbour imputation needs a row key")
        medians, modes, knn = run_together(
            df.sparkSession,
            lambda: fit_median(staged, self.median_columns, skip=self.knn_columns),
            lambda: fit_mode(staged, self.mode_columns),
            lambda: fit_knn(staged, self.knn_columns, keys, self.neighbours) if uses_knn else None,
        )
        partial = PreparedModel(self, knn, medians, modes, EncodingModel({}))
        if not self.encoding.columns():
            return partial
        # Encoders see imputed values; the neighbour join runs for them only when they use its columns.
        needed = set(self.encoding.columns()) & set(self.knn_columns)
        imputed = partial.impute(staged, with_knn=bool(needed))
        return PreparedModel(self, knn, medians, modes, self.encoding.fit(imputed))


@dataclass(frozen=True)
class PreparedModel:
    plan: PreparePlan
    knn: KnnModel | None
    medians: ConstantImputer
    modes: ConstantImputer
    encoders: EncodingModel

    def impute(self, staged: DataFrame, with_knn: bool = True) -> DataFrame:
        """Steps 6 to 8."""
        if with_knn and self.knn is not None:
            staged = self.knn.transform(staged)
        return self.plan.finish(self.modes.transform(self.medians.transform(staged)))

    def transform(self, df: DataFrame, keep_ids: bool = False, keep_keys: bool = False) -> DataFrame:
        """Steps 1 to 10. Without nearest-neighbour columns it is row-local and also takes a stream.

        Ids and keys are dropped unless kept; `keep_keys` keeps the keys that are no ids, such as the cycle.
        """
        imputed = self.impute(self.plan.stage(df))
        if not keep_ids:
            imputed = drop_ids(imputed, [*self.plan.id_columns, *([] if keep_keys else self.plan.keys)])
        return self.encoders.transform(imputed)


def prepare(df: DataFrame, encoding_config: Mapping | None = None, **options) -> tuple[DataFrame, PreparedModel]:
    """L2 in one call: fit on `df` and apply to it."""
    model = PreparePlan(encoding=EncodingPlan.from_config(encoding_config), **options).fit(df)
    return model.transform(df), model


def preparation_report(before: DataFrame, after: DataFrame, target: str = "glucose_value") -> DataFrame:
    """Rows and columns before and after, columns added and dropped, missing cells left."""
    known = F.col(target).isNotNull() if target in before.columns else F.lit(True)
    rows = row_reduction(normalise_nan(before, [target]) if target in before.columns else before, known)
    left = missing_totals(after).select("total_missing")
    added = len([c for c in after.columns if c not in before.columns])
    dropped = len([c for c in before.columns if c not in after.columns])
    return rows.withColumns({
        "columns_added": F.lit(added), "columns_dropped": F.lit(dropped), "missing_left": left.scalar(),
    }).withColumn("passed", F.col("missing_left") == 0)
