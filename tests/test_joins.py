import pytest

from tabprep.operators import joins, stacking
from tests.conftest import rows


@pytest.fixture
def modules(make):
    return {
        "DEMO": make([(1, 10.0), (2, 20.0), (3, None)], "id int, age double"),
        "BMX": make([(2, 60.0, 1.0), (4, 70.0, 2.0)], "id int, weight double, age double"),
        "BPX": make([(1, 120.0, 5.0), (4, 130.0, 6.0)], "id int, sys double, age double"),
    }


EXPECTED = [
    (1, 10.0, None, None, 120.0, 5.0), (2, 20.0, 60.0, 1.0, None, None), (3, None, None, None, None, None),
    (4, None, 70.0, 2.0, 130.0, 6.0),
]


@pytest.mark.parametrize("unique", [True, False, None])
def test_full_join_of_modules(modules, unique):
    out = joins.join_modules(modules, ["id"], unique=unique)
    assert out.columns == ["id", "age", "weight", "age_BMX", "sys", "age_BPX"]
    assert rows(out, "id") == EXPECTED


def test_repeated_keys_multiply(make):
    out = joins.join_modules({"a": make([(1, "x"), (1, "y"), (2, "z")], "id int, a string"),
                              "b": make([(1, "p"), (1, "q"), (3, "r")], "id int, b string")}, ["id"])
    assert rows(out, "id", "a", "b") == [
        (1, "x", "p"), (1, "x", "q"), (1, "y", "p"), (1, "y", "q"), (2, "z", None), (3, None, "r")]


def test_a_repeated_key_is_not_dropped(make):
    tables = {"a": make([(1, 10), (1, 20)], "id int, a int"), "b": make([(1, 5)], "id int, b int")}
    with pytest.raises(Exception, match="repeats a key"):
        joins.join_modules(tables, ["id"], unique=True).collect()
    assert rows(joins.join_modules(tables, ["id"]), "a") == [(1, 10, 5), (1, 20, 5)]


@pytest.mark.parametrize("repeated", [False, True])
def test_plans_grow_with_the_modules(spark, tmp_path, repeated):
    tables = {}
    for n in range(7):
        path = str(tmp_path / f"m{n}")
        spark.range(20).selectExpr("id", f"id + {n} AS v{n}").union(
            spark.range(3 if repeated else 0).selectExpr("id", f"id AS v{n}")).write.parquet(path)
        tables[f"m{n}"] = spark.read.parquet(path)
    out = joins.join_modules(tables, ["id"])
    assert out.count() == (17 + 3 * 2**7 if repeated else 20)
    # Each module once, and for each one the counts of the repeated keys twice at most; before, scans doubled per module.
    reads = out._jdf.queryExecution().executedPlan().toString().count("FileScan")
    assert reads <= (1 + 3 * 7 + 1 if repeated else 1)


def test_groups_share_a_grouping(make):
    one = [make([(1, "x"), (1, "y")], "id int, v string"), make([(1, "p"), (2, "q")], "id int, w string")]
    two = [make([(5, "a")], "id int, v string"), make([(5, "b"), (5, "c"), (6, "d")], "id int, w string")]
    assert rows(joins.join_groups([one, two], ["id"]), "id", "v", "w") == [
        (1, "x", "p"), (1, "y", "p"), (2, None, "q"), (5, "a", "b"), (5, "a", "c"), (6, None, "d")]


@pytest.mark.parametrize("unique", [True, False])
def test_null_keys(make, unique):
    tables = {"a": make([(None, "x"), (1, "y")], "id int, a string"), "b": make([(None, "p"), (1, "q")], "id int, b string")}
    apart = joins.join_modules(tables, ["id"], unique=unique)
    assert sorted(rows(apart), key=str) == sorted([(None, "x", None), (None, None, "p"), (1, "y", "q")], key=str)
    together = joins.join_modules(tables, ["id"], unique=unique, null_safe=True)
    assert sorted(rows(together), key=str) == sorted([(None, "x", "p"), (1, "y", "q")], key=str)


def test_unresolved_overlap_is_refused(make):
    tables = {"a": make([(1, 1)], "id int, v int"), "b": make([(1, 1, 2)], "id int, v int, v_b int"), "c": make([(1, 1)], "id int, v_b int")}
    with pytest.raises(Exception):
        joins.join_modules({"a": tables["a"], "b": tables["b"]}, ["id"], unique=True).select("v_b").collect()


@pytest.mark.parametrize("small", [True, False])
def test_lookup(make, small):
    df = make([("a", 1), ("b", 2), (None, 3)], "k string, i int")
    table = make([("a", 0.5)], "level string, value double")
    out = joins.lookup(df, table, "k", "value", "k", -1.0, small)
    assert out.columns == ["k", "i"] and rows(out, "i") == [(0.5, 1), (-1.0, 2), (-1.0, 3)]


def test_stack_fills_absent_columns(make):
    out = stacking.stack_tagged({"c1": make([(1, 2)], "a int, b int"), "c2": make([(3, "x"), (3, "x")], "a int, c string")})
    assert sorted(rows(out.select("a", "b", "c", "cycle")), key=str) == sorted(
        [(1, 2, None, "c1"), (3, None, "x", "c2"), (3, None, "x", "c2")], key=str)


def test_long_stack_key(make):
    out = stacking.stack_long([("2011-2012", make([(5.0,)], "SEQN double"))], "SEQN")
    assert rows(out) == [(5.0, "2011-2012", "5_2011-2012")]


def test_sets(make):
    df = make([("v", "c2"), ("v", "c1"), ("v", "c2"), ("w", None)], "k string, c string")
    assert rows(stacking.sets_by_key(df, "k", "c", "s")) == [("v", ["c1", "c2"])]
    assert stacking.union_names(df.select("k"), df.select("k")).count() == 2
