import pytest
from pyspark.sql import functions as F

from tabprep.operators import clean
from tabprep.plans.typing import define_types
from tests.conftest import rows


def test_threshold_label_edge_and_missing(make):
    df = make([(5.7,), (5.69,), (None,)], "g double")
    assert [r["y"] for r in clean.threshold_label(df, "g", 5.7, "y").collect()] == [1, 0, None]
    assert [r["y"] for r in clean.threshold_label(df, "g", 5.7, "y", null_label=0).collect()] == [1, 0, 0]


def test_require_value(make):
    df = make([(1, None), (2, 1.0)], "i int, g double")
    assert rows(clean.require_value(df, "g")) == [(2, 1.0)]
    assert clean.require_value(df, "absent").count() == 2


def test_sentinel(make):
    df = make([(0.0,), (-0.0,), (80.0,), (None,)], "d double")
    assert [r[0] for r in clean.sentinel_to_null(df, ["d", "absent"]).collect()] == [None, None, 80.0, None]


def test_yes_no(make):
    df = make([(1.0,), (2.0,), (7.0,), (9.0,), (None,)], "s double")
    assert [r[0] for r in clean.recode_yes_no(df, ["s"]).collect()] == [1, 0, 0, 0, 0]
    assert [r[0] for r in clean.recode_yes_no(df, ["s"], null_as=None).collect()] == [1, 0, 0, 0, None]


def test_integer_cast(make):
    df = make([(18.9,), (-1.5,), (None,)], "a double")
    assert [r[0] for r in clean.to_integer(df, ["a"]).collect()] == [18, -1, None]
    with pytest.raises(Exception, match="not an integer"):
        clean.to_integer(df, ["a"], strict=True).collect()


def test_category_metadata(make):
    df = clean.mark_category(make([(1,)], "a int"), ["a", "absent"], {"a": [1, 2]})
    assert df.schema["a"].metadata == {"category": True, "levels": [1, 2]}
    assert clean.category_columns(df) == ["a"]


def test_bmi_only_where_missing(make):
    df = make([(20.0, 80.0, 200.0), (None, 80.0, 200.0), (None, 80.0, None), (None, 80.0, 0.0)],
              "bmi double, weight_kg double, height_cm double")
    assert [r["bmi"] for r in clean.fill_bmi(df).collect()] == [20.0, 20.0, None, None]
    assert clean.fill_bmi(df.drop("height_cm")).columns == ["bmi", "weight_kg"]


def test_rules_in_order(make):
    df = make([(140.0, 90.0, 0, 30), (141.0, None, 0, 30), (None, 91.0, None, 30), (None, None, None, 61), (None, None, None, 60)],
              "BPX_SYS double, BPX_DIA double, hypertension bigint, age_years int")
    out = clean.apply_rules(df, clean.blood_pressure_rules(df))
    assert [r["hypertension"] for r in out.collect()] == [0, 1, 1, 1, None]
    assert clean.blood_pressure_rules(df.drop("hypertension")) == []


def test_rule_hits(make):
    df = make([(1,), (5,), (None,)], "a int")
    assert {r["rule"]: r["hits"] for r in clean.rule_hits(df, {"big": F.col("a") > 2}).collect()} == {"big": 1}


def test_extremes(make):
    df = make([(1, 95.0, 100.0), (2, 20.0, 39.0), (3, None, None), (4, 20.0, 80.0)], "i int, bmi double, BPX_DIA double")
    assert [r["i"] for r in clean.extreme_rows(df, clean.EXTREME_LIMITS).orderBy("i").collect()] == [1, 2]
    assert [r["i"] for r in clean.extreme_rows(df, clean.EXTREME_LIMITS_WITHOUT_DIASTOLIC).collect()] == [1]


def test_case_filters(make):
    df = make([(1, None), (2, 3)], "a int, b int")
    assert rows(clean.complete_cases(df)) == [(2, 3)]
    assert rows(clean.incomplete_cases(df)) == [(1, None)]


def test_type_pass(make):
    df = make([(2.0, 33.0, 1.0, 0.5, "x")], "smoker double, age_years double, ethnicity double, income_poverty_ratio double, other string")
    out = define_types(df)
    assert dict(out.dtypes)["smoker"] == "bigint" and dict(out.dtypes)["age_years"] == "bigint"
    assert clean.category_columns(out) == ["ethnicity", "income_poverty_ratio"]
