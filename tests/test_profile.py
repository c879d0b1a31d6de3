import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprep.functions.student import two_sided_p
from tabprep.operators import association, clean, outliers, profile
from tests.conftest import by, rows


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [(1, 0, 10.0, "a"), (2, 0, 20.0, "b"), (3, 1, None, "a"), (4, 1, 40.0, None), (5, None, 100.0, "b")],
        "id int, y int, x double, s string")


def test_summaries(people):
    x = by(profile.column_summary(people, ["x"]), "variable")["x"]
    assert (x["min"], x["max"], x["mean"], x["missing"]) == (10.0, 100.0, 42.5, 1)
    assert x["std"] == pytest.approx(np.std([10, 20, 40, 100], ddof=1))
    assert rows(profile.class_distribution(people, "y")) == [(0, 2, 50.0), (1, 2, 50.0)]
    assert profile.imbalance_ratio(people, "y").first()["ratio"] == 1.0
    assert rows(profile.value_counts(people, "s")) == [("a", 2), ("b", 2)]
    assert rows(profile.value_counts(people, "s", top=1)) == [("a", 2)]
    assert rows(profile.levels(people, "s")) == [("a",), ("b",)]
    assert {tuple(r) for r in profile.column_modes(people, ["s", "y", "id"]).collect()} == {("s", "a", 2), ("y", "0", 2), ("id", "1", 1)}
    assert rows(profile.distinct_counts(people, ["s", "x"], approximate=True)) == [("s", 2), ("x", 4)]
    assert {tuple(r) for r in profile.distinct_counts(people.withColumn("e", F.lit(None).cast("string")), ["s", "x", "e"]).collect()} == {("s", 2), ("x", 4), ("e", 0)}


def test_missing_reports(people, make):
    assert [r["variable"] for r in profile.missing_report(people).collect()] == ["s", "x", "y"]
    assert profile.check_missing(people) == {
        "total_missing": 3, "total_cells": 20, "missing_pct": 15.0, "cols_with_missing": {"s": 1, "x": 1, "y": 1}}
    assert tuple(profile.missing_totals(people).first()) == (3, 20, 15.0)
    assert tuple(profile.zero_missing_check(people, ["id"]).first()) == (0, True)
    assert tuple(profile.quality_summary(people).first()) == (5, 4, 3, 2, 3, 3)
    empty = make([], "a int, b int")
    assert profile.check_missing(empty)["missing_pct"] is None and tuple(profile.missing_totals(empty).first()) == (0, 0, None)
    assert tuple(profile.row_reduction(people, F.col("y").isNotNull()).first()) == (5, 4, 1, 20.0)


def test_sparse_columns(make):
    df = make([(1, None, None), (2, None, 1), (3, 1, 1), (4, 1, None)], "a int, half int, also int").withColumn("gone", F.lit(None).cast("int"))
    assert profile.drop_sparse(df, 0.5).columns == ["a", "half", "also"]
    assert profile.drop_sparse(df, 0.4).columns == ["a"]


def test_class_descriptives(people):
    out = {(r["y"], r["variable"]): r for r in profile.class_descriptives(people, "y", ["x"]).collect()}
    assert (out[0, "x"]["n"], out[0, "x"]["median"], out[1, "x"]["n"], out[1, "x"]["std"]) == (2, 15.0, 1, None)


def test_describe(people):
    out = by(profile.describe_all(people.withColumn("e", F.lit(None).cast("string"))), "variable")
    assert (out["s"]["count"], out["s"]["unique"], out["s"]["top"], out["s"]["freq"], out["s"]["mean"]) == (4, 2, "a", 2, None)
    assert (out["x"]["count"], out["x"]["q25"], out["x"]["q50"], out["x"]["q75"], out["x"]["top"]) == (4, 17.5, 30.0, 55.0, None)
    assert (out["e"]["count"], out["e"]["unique"], out["e"]["top"]) == (0, 0, None)


def test_types(people):
    marked = clean.mark_category(people, ["s"])
    assert rows(profile.type_census(marked)) == [("int", 2), ("category", 1), ("double", 1)]
    assert rows(profile.column_types(people), "position")[2] == (2, "x", "double")


def test_availability(spark, make):
    tables = {("c2", "A"): make([(1, 2)], "id int, v int"), ("c1", "A"): make([(1, 2), (3, 4)], "id int, v int"), ("c1", "B"): make([(1,)], "id int")}
    out = by(profile.variable_availability(profile.file_variables(spark, tables)), "variable")
    assert tuple(out["v"]) == ("v", 3, "c1, c2") and out["id"]["rows"] == 4


@pytest.mark.parametrize("t, dof, p", [
    (2.228139, 10, 0.05), (12.7062, 1, 0.05), (1.959964, 1e6, 0.05), (3.169273, 10, 0.01), (0.0, 5, 1.0), (-2.228139, 10, 0.05), (1.0, 1, 0.5),
])
def test_student_table(t, dof, p):
    assert two_sided_p(t, dof) == pytest.approx(p, abs=2e-6)


def test_student_limits():
    assert two_sided_p(None, 3) is None and two_sided_p(1.0, 0) is None and two_sided_p(math.inf, 4) == 0.0
    normal = math.erfc(2.5 / math.sqrt(2))
    assert two_sided_p(2.5, 1e9) == pytest.approx(normal, rel=1e-6)


def test_t_test(make):
    df = make([(0, 1.0, 5.0), (0, 2.0, 5.0), (0, 3.0, 5.0), (1, 2.0, 5.0), (1, 4.0, 5.0), (1, 6.0, 5.0), (None, 99.0, 5.0), (1, None, 5.0)],
              "y int, x double, c double")
    out = by(association.t_test(df, "y", ["x", "c"]), "variable")
    # Pooled variance (1 * 2 + 4 * 2) / 4 = 2.5, so t = -2 / sqrt(2.5 * 2 / 3).
    assert out["x"]["t"] == pytest.approx(-2 / math.sqrt(2.5 * 2 / 3)) and out["x"]["dof"] == 4
    assert out["x"]["p"] == pytest.approx(0.1963, abs=1e-3) and out["x"]["significance"] == "ns"
    assert out["c"]["t"] is None and out["c"]["p"] is None and out["c"]["significance"] is None


def test_correlation(make):
    data = [(0, 1.0, 7.0, 1.0), (1, 3.0, 7.0, None), (1, 2.0, 7.0, -1.0), (0, None, 7.0, 2.0), (None, 50.0, 7.0, 9.0)]
    out = association.target_correlation(make(data, "y int, x double, const double, z double"), "y", ["x", "const", "z", "y"])
    found = {r["variable"]: r["correlation"] for r in out.collect()}
    assert found["x"] == pytest.approx(np.corrcoef([0, 1, 1], [1, 3, 2])[0, 1])
    assert found["z"] == pytest.approx(np.corrcoef([0, 1, 0], [1, -1, 2])[0, 1])
    assert found["const"] is None and [r["variable"] for r in out.collect()] == ["x", "z", "const"]


def test_crosstab(make):
    df = make([("a", 0), ("a", 1), ("b", 1), (None, 1), ("b", None)], "r string, c int")
    assert sorted(rows(association.crosstab(df, "r", "c", [0, 1]))) == [("All", 1, 2, 3), ("a", 1, 1, 2), ("b", 0, 1, 1)]
    assert association.crosstab(df, "r", "c").columns == ["r", "0", "1", "All"]
    assert sorted(rows(association.crosstab(df, "r", "c", [0, 1], margins=False))) == [("a", 1, 1), ("b", 0, 1)]
    assert sorted(rows(association.crosstab_row_percent(df, "r", "c", [0, 1]))) == [("a", 50.0, 50.0), ("b", 0.0, 100.0)]


@pytest.fixture(scope="module")
def readings(spark):
    data = [(i, "g1" if i % 2 else "g2", float(i), 5.0, None) for i in range(1, 21)] + [(21, "g1", 100.0, 5.0, None)]
    return spark.createDataFrame(data, "i int, g string, x double, const double, empty double")


@pytest.mark.parametrize("options", [{}, {"one_task_bytes": 0, "one_task_rows": 0}])
def test_iqr(readings, options):
    out = by(outliers.iqr_outliers(readings, ["x", "const", "empty", "absent"], **options), "variable")
    assert list(out) == ["x"]
    assert (out["x"]["q1"], out["x"]["q3"], out["x"]["lower_bound"], out["x"]["upper_bound"]) == (6.0, 16.0, -9.0, 31.0)
    assert (out["x"]["outliers"], out["x"]["outlier_min"], out["x"]["data_max"]) == (1, 100.0, 100.0)
    assert set(by(outliers.iqr_outliers(readings, ["x", "const", "empty"], all_columns=True, **options), "variable")) == {"x", "const"}


def test_zscore(readings):
    out = by(outliers.zscore_outliers(readings, ["x", "const", "empty"]), "variable")
    values = np.array([*range(1, 21), 100.0])
    assert list(out) == ["x"] and out["x"]["outliers"] == (np.abs((values - values.mean()) / values.std()) > 3).sum() == 1


def test_box_plot(readings):
    whole = by(outliers.box_plot_figures(readings, ["x", "empty"]), "variable")["x"]
    assert tuple(whole)[1:] == (6.0, 11.0, 16.0, 21, 1.0, 20.0, 1)
    groups = {r["g"]: r for r in outliers.box_plot_figures(readings, ["x"], by=["g"]).collect()}
    assert groups["g2"]["fliers"] == 0 and groups["g1"]["fliers"] == 1


def test_outlier_union(make):
    iqr = make([("a", 2, 1.0), ("b", 3, 2.0)], "variable string, outliers long, pct double")
    z = make([("b", 1, 0.5), ("c", 4, 3.0)], "variable string, outliers long, pct double")
    assert rows(outliers.outlier_summary(iqr, z), "variable") == [("a", 2, 1.0, None, None), ("b", 3, 2.0, 1, 0.5), ("c", None, None, 4, 3.0)]


def test_outlier_actions(readings):
    assert outliers.limit_outliers(readings, ["x", "empty"]).count() == 20
    assert outliers.limit_outliers(readings, ["x"], "clip").agg(F.max("x")).first()[0] == 31.0
    with pytest.raises(ValueError):
        outliers.limit_outliers(readings, ["x"], "other")


def test_ranges(make):
    df = make([(1.0,), (5.0,), (None,), (9.0,)], "x double")
    assert tuple(outliers.range_violations(df, [("x", 2, 8), ("absent", 0, 1)]).first()) == ("x", 3, 2.0, 8.0, 2)
    assert [r[0] for r in outliers.enforce_ranges(df, [("x", 2, None)]).collect()] == [None, 5.0, None, 9.0]
    assert [r[0] for r in outliers.enforce_ranges(df, [("x", 2, 8)], "drop").collect()] == [5.0, None]


def test_p_values_at_any_size():
    from tabprep.functions.student import two_sided_p

    # Two-sided p of the normal limit, and of small degrees of freedom from closed forms.
    assert two_sided_p(2.0, 1) == pytest.approx(1 - 2 / math.pi * math.atan(2.0), rel=1e-13)
    assert two_sided_p(2.0, 2) == pytest.approx(1 - 2 / math.sqrt(6), rel=1e-13)
    for t in (0.0, 0.01, 0.5, 2.0, 6.0, 12.0):
        for dof in (1e8, 1e10, 1e12, 1e13):
            assert two_sided_p(t, dof) == pytest.approx(math.erfc(t / math.sqrt(2)), rel=2 * (t**4 + 1) / dof + 1e-12)
        # Both sides of the change of method agree.
        assert two_sided_p(t, 0.999e7) == pytest.approx(two_sided_p(t, 1.001e7), rel=1e-5 * (t**4 + 1) / 4e3 + 1e-8)
    assert two_sided_p(None, 5) is None and two_sided_p(float("inf"), 5) == 0.0 and two_sided_p(1.0, 0) is None


def test_crosstab_levels_keep_their_type(make):
    df = make([("x", True, 1.5e7, "All"), ("x", False, 1.5e7, "b"), ("All", True, 2.0, "b"), (None, True, 2.0, "b")],
              "k string, flag boolean, num double, word string")
    assert rows(association.crosstab(df, "k", "flag"), "False", "k") == [("All", 0, 1, 1), ("All", 1, 2, 3), ("x", 1, 1, 2)]
    assert rows(association.crosstab(df, "flag", "num", margins=False), "flag") == [("false", 0, 1), ("true", 2, 1)]
    long = rows(association.crosstab_long(df, "k", "word"))
    assert ("All", "b", False, False, 1) in long and (None, None, True, True, 3) in long and len(long) == 8


def test_wide_decimals_keep_their_digits(make):
    df = make([("20000000000000000000.01",), ("20000000000000000000.02",), ("20000000000000000000.02",)], "t string").selectExpr(
        "cast(t as decimal(38,2)) AS d", "cast(1.5 as decimal(3,1)) AS e")
    assert rows(profile.distinct_counts(df, ["d", "e"]), "variable") == [("d", 2), ("e", 1)]
    assert rows(profile.column_modes(df, ["d", "e"]), "variable") == [("d", "20000000000000000000.02", 2), ("e", "1.5", 3)]


def test_category_marks_are_not_numbers(make):
    from tabprep.operators.clean import mark_category

    df = mark_category(make([(1, 2.0), (1, 3.0)], "code int, v double"), ["code"])
    found = {r["variable"]: r for r in profile.describe_all(df).collect()}
    assert found["code"]["top"] == "1" and found["code"]["mean"] is None and found["v"]["mean"] == 2.5
    assert profile.quality_summary(df).first()["numeric_columns"] == 1
