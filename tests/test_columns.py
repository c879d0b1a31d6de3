import math

import pytest
from pyspark.sql import functions as F

from tabprep.functions import columns as cx
from tabprep.sources import dictionary as dd
from tests.conftest import rows


@pytest.mark.parametrize("text, expected", [
    ("5", 5.0), (" 5.5 ", 5.5), ("-.5", -0.5), ("1e3", 1000.0), ("+2", 2.0), ("5.", 5.0),
    ("5d", None), ("5f", None), ("abc", None), ("1_0", None), ("", None), (None, None), ("inf", math.inf), ("-Infinity", -math.inf),
])
def test_numbers_in_text(make, text, expected):
    assert cx.coerce_numeric(make([(text,)], "x string"), ["x"]).first()[0] == expected


def test_coercion_of_other_types(make):
    df = make([(1, True, float("nan"))], "a int, b boolean, c double")
    assert tuple(cx.coerce_numeric(df, ["a", "b", "c", "absent"]).first()) == (1.0, 1.0, None)


def test_nan_and_infinity_become_null(make):
    df = make([(float("nan"), 1), (float("inf"), 2), (1.5, 3), (None, 4)], "x double, i int")
    assert rows(cx.normalise_nan(df), "i") == [(None, 1), (math.inf, 2), (1.5, 3), (None, 4)]
    assert rows(cx.infinite_to_null(df), "i") == [(None, 1), (None, 2), (1.5, 3), (None, 4)]


def test_present_keeps_request_order(make):
    df = make([(1, 2)], "a int, b int")
    assert cx.present(df, ["b", "x", "a"]) == ["b", "a"]
    with pytest.raises(ValueError):
        cx.present(df, ["x"], on_missing="error")


def test_cycle_year(make):
    df = make([("2011-2012",), ("oops",), ("2021",), (None,)], "c string").select(cx.cycle_year(F.col("c")))
    assert [r[0] for r in df.collect()] == [2011, 2020, 2021, 2020]


def test_paths_and_file_names(make):
    df = make([("/raw/2011-2012/DEMO_G.xpt",), ("DEMO",)], "p string")
    out = df.select(cx.base_name(F.col("p")), cx.file_stem(F.col("p")), cx.parent_name(F.col("p")))
    assert rows(out) == [("DEMO_G.xpt", "DEMO_G", "2011-2012"), ("DEMO", "DEMO", "")]
    assert make([('a<b>:"/\\|?*c',)], "p string").select(cx.safe_filename(F.col("p"))).first()[0] == "a_b________c"


def test_composite_key(make):
    df = make([(12345.0, "2011-2012"), (1e7, "x"), (None, "x"), (1.0, None)], "i double, c string")
    assert [r[0] for r in df.select(cx.composite_key("i", "c")).collect()] == ["12345_2011-2012", "10000000_x", None, None]


@pytest.mark.parametrize("age, right, left", [
    (0, None, "< 18"), (18, "< 18", "18-34"), (35, "18-34", "35-49"), (65, "50-64", "65+"), (100, "65+", None), (101, None, None), (None, None, None),
])
def test_interval_ends(make, age, right, left):
    from tabprep.operators.clean import AGE_EDGES, AGE_LABELS

    df = make([(age,)], "a int")
    out = df.select(*[cx.interval_label(F.col("a"), AGE_EDGES, AGE_LABELS, c) for c in ("right", "left")]).first()
    assert tuple(out) == (right, left)


def test_significance_bands(make):
    df = make([(0.0005,), (0.001,), (0.01,), (0.05,), (None,)], "p double").select(cx.significance(F.col("p")))
    assert [r[0] for r in df.collect()] == ["***", "**", "*", "ns", None]


def test_any_of_ignores_unknown(make):
    df = make([(None, 5), (None, 0), (9, None)], "a int, b int")
    assert [r[0] for r in df.select(cx.any_of([F.col("a") > 1, F.col("b") > 1])).collect()] == [True, False, True]


@pytest.mark.parametrize("cycle, variables", [
    ("2011-2012", {"LBXTR", "SLD010H", "BPXSY1", "BPXDI1"}), ("2015-2016", {"LBXTR", "SLD012", "BPXSY1", "BPXDI1"}),
    ("2017-2020", {"LBXTR", "SLD012", "BPXOSY1", "BPXODI1"}), ("2021-2023", {"LBXTLG", "SLD012", "BPXOSY1", "BPXODI1"}),
    ("unknown", {"LBXTR", "SLD012", "BPXOSY1", "BPXODI1"}),
])
def test_variables_of_a_cycle(spark, make, cycle, variables):
    named = dd.variables_for_cycle(cycle)
    assert set(named["TRIGLY"] + named["SLQ"] + named["BPX"]) == variables
    assert len(dd.flat_variables_for_cycle(cycle)) == 21
    joined = dd.valid_variables(make([(cycle,)], "cycle string"), dd.dictionary_table(spark))
    assert {r["variable"] for r in joined.collect()} == set(dd.flat_variables_for_cycle(cycle))


def test_aliases_fold_into_one_column(make):
    df = make([(1.0, 2.0, None, 7), (1.0, None, 3.0, 8)], "SEQN double, LBXTR double, LBXTLG double, keep int")
    out = dd.coalesce_aliases(df)
    assert out.columns == ["SEQN", "TRIGLY", "keep"]
    assert [r["TRIGLY"] for r in out.collect()] == [2.0, 3.0]


def test_readable_names(make):
    df = make([(1.0, 2.0, 3.0, 4.0)], "SEQN double, RIDAGEYR double, BPXOSY1 double, TRIGLY double")
    assert dd.readable_names(df).columns == ["subject_id", "age_years", "systolic_bp", "TRIGLY"]
