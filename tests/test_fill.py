import random

import pytest
from pyspark.sql import functions as F

from tabprep.operators.fill import fill_in_order
from tabprep.operators.ordering import first_rows, last_rows, with_row_index
from tests.conftest import rows


def filled(values):
    out, known = [], None
    for v in values:
        known = v if v is not None else known
        out.append(known)
    first = next((v for v in values if v is not None), None)
    return [first if v is None else v for v in out]


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(3)
    data = []
    # One key holds two thirds of the rows; one key is never known; one starts late.
    for key, n in (("hot", 400), ("a", 60), ("never", 30), ("late", 50), ("one", 1)):
        for t in range(n):
            value = None if key == "never" or rng.random() < 0.7 or (key == "late" and t < 40) else float(rng.randrange(9))
            data.append((key, t, value, None if rng.random() < 0.9 else str(t)))
    expected = {}
    for key in {d[0] for d in data}:
        mine = [d for d in data if d[0] == key]
        for d, v, s in zip(mine, filled([d[2] for d in mine]), filled([d[3] for d in mine])):
            expected[key, d[1]] = (v, s)
    rng.shuffle(data)
    return spark.createDataFrame(data, "k string, t int, v double, s string"), expected


@pytest.mark.parametrize("options", [
    {"strategy": "window"}, {"strategy": "slices", "slices": 11}, {"strategy": "slices", "slices": 1},
    {"strategy": "auto", "group_rows": 100}, {"strategy": "auto"},
])
def test_fill_per_key(series, options):
    df, expected = series
    out = fill_in_order(df, ["v", "s", "absent"], ["t"], ["k"], **options)
    assert {(r["k"], r["t"]): (r["v"], r["s"]) for r in out.collect()} == expected


def test_fill_without_key(series):
    df, _ = series
    order = sorted(((r["k"], r["t"], r["v"]) for r in df.collect()))
    expected = dict(zip([o[:2] for o in order], filled([o[2] for o in order])))
    out = fill_in_order(df, ["v"], ["k", "t"], slices=7)
    assert {(r["k"], r["t"]): r["v"] for r in out.collect()} == expected


def test_fill_is_idempotent(series):
    df, _ = series
    once = fill_in_order(df, ["v"], ["t"], ["k"], strategy="window")
    assert sorted(rows(once), key=str) == sorted(rows(fill_in_order(once, ["v"], ["t"], ["k"], strategy="window")), key=str)


def test_null_key_is_a_series(make):
    df = make([(None, 1, 5.0), (None, 2, None), ("a", 1, None)], "k string, t int, v double")
    for options in ({"strategy": "window"}, {"strategy": "slices", "slices": 3}):
        assert sorted(rows(fill_in_order(df, ["v"], ["t"], ["k"], **options)), key=str) == sorted(
            [(None, 1, 5.0), (None, 2, 5.0), ("a", 1, None)], key=str)


def test_row_index(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("x"))
    assert rows(with_row_index(df, ["x"], slices=9).where("x <> row_index")) == []


def test_first_and_last(spark):
    df = spark.range(20)
    assert [r[0] for r in first_rows(df, ["id"], 2).collect()] == [0, 1]
    assert [r[0] for r in last_rows(df, ["id"], 2).collect()] == [18, 19]
