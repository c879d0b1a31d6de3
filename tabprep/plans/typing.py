"""Column types of the consolidated table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tabprep.operators.clean import mark_category, recode_yes_no, to_integer

# yes/no answers, whole numbers and categories of the consolidated table.
FLAGS = ["smoker", "liver_disease", "heart_disease", "hypertension"]
INTEGERS = ["age_years"]
CATEGORIES = ["ethnicity", "income_poverty_ratio"]


def define_types(
    df: DataFrame,
    flags: Sequence[str] = tuple(FLAGS),
    integers: Sequence[str] = tuple(INTEGERS),
    categories: Sequence[str] = tuple(CATEGORIES),
    null_flag: int | None = 0,
    strict: bool = False,
) -> DataFrame:
    """L1: P13 flags, P14 integers, P15 categories, in one projection; absent columns are skipped."""
    return mark_category(to_integer(recode_yes_no(df, flags, null_as=null_flag), integers, strict), categories)
