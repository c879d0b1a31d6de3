"""Clinical indices by published formulas. All are row-local expressions over columns the caller names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _d(c: str) -> Column:
    return F.col(c).cast("double")


def _positive(c: str) -> Column:
    """The value where a logarithm of it exists."""
    return F.when(_d(c) > 0, _d(c))


def mean_arterial_pressure(systolic: str, diastolic: str) -> Column:
    """Diastolic + (systolic - diastolic) / 3."""
    return _d(diastolic) + (_d(systolic) - _d(diastolic)) / 3.0


def pulse_pressure(systolic: str, diastolic: str) -> Column:
    """Systolic - diastolic."""
    return _d(systolic) - _d(diastolic)


def pressure_ratio(systolic: str, diastolic: str) -> Column:
    """Systolic / diastolic, the stress ratio."""
    return F.try_divide(_d(systolic), _d(diastolic))


def ratio(over: str, under: str) -> Column:
    """waist/height, BMI/waist, triglycerides/cholesterol."""
    return F.try_divide(_d(over), _d(under))


def tyg_index(triglycerides: str, glucose: str) -> Column:
    """D3: ln(triglycerides [mg/dL] * fasting glucose [mg/dL] / 2) (Simental-Mendia et al., 2008)."""
    return F.ln(_positive(triglycerides) * _positive(glucose) / 2.0)


def tyg_waist(triglycerides: str, glucose: str, waist: str) -> Column:
    """D3: TyG times waist circumference (Er et al., 2016)."""
    return tyg_index(triglycerides, glucose) * _d(waist)


def non_hdl(total: str, hdl: str) -> Column:
    """D3: total minus HDL cholesterol."""
    return _d(total) - _d(hdl)


def friedewald_ldl(total: str, hdl: str, triglycerides: str) -> Column:
    """D3: total - HDL - triglycerides / 5, defined below 400 mg/dL (Friedewald et al., 1972)."""
    return F.when(_d(triglycerides) < 400, _d(total) - _d(hdl) - _d(triglycerides) / 5.0)


def friedewald_hdl(total: str, ldl: str, triglycerides: str) -> Column:
    """D3: the same equation solved for HDL."""
    return F.when(_d(triglycerides) < 400, _d(total) - _d(ldl) - _d(triglycerides) / 5.0)


def homa_ir(glucose: str, insulin: str) -> Column:
    """Glucose [mg/dL] * insulin [uU/mL] / 405 (Matthews et al., 1985)."""
    return _d(glucose) * _d(insulin) / 405.0


def quicki(glucose: str, insulin: str) -> Column:
    """1 / (log10 insulin + log10 glucose) (Katz et al., 2000)."""
    return F.try_divide(F.lit(1.0), F.log10(_positive(insulin)) + F.log10(_positive(glucose)))


# Kilocalories per gram (Atwater factors).
KCAL_PER_GRAM = {"carb": 4.0, "fat": 9.0, "protein": 4.0}


def energy_percent(grams: str, energy_kcal: str, nutrient: str) -> Column:
    """Percent of energy from a nutrient."""
    return F.try_divide(_d(grams) * F.lit(KCAL_PER_GRAM[nutrient] * 100.0), _d(energy_kcal))


def criteria_score(criteria: Sequence[Column]) -> Column:
    """Number of criteria that hold; an unknown one counts 0. Five criteria give the 0-5 syndrome score."""
    out = F.lit(0).cast("bigint")
    for c in criteria:
        out = out + F.coalesce(c.cast("bigint"), F.lit(0))
    return out


def metabolic_syndrome_criteria(
    waist: str, triglycerides: str, hdl: str, systolic: str, diastolic: str, glucose: str, male: Column
) -> list[Column]:
    """The five NCEP ATP III criteria (JAMA 2001; glucose cut-off as revised in 2005)."""
    return [
        F.when(male, _d(waist) > 102).otherwise(_d(waist) > 88),
        _d(triglycerides) >= 150,
        F.when(male, _d(hdl) < 40).otherwise(_d(hdl) < 50),
        (_d(systolic) >= 130) | (_d(diastolic) >= 85),
        _d(glucose) >= 100,
    ]


def add_features(df: DataFrame, features: Mapping[str, Column]) -> DataFrame:
    """All features in one projection."""
    return df.withColumns(dict(features))
