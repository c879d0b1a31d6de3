"""Bucketed module tables: the same rows as a full outer join, without moving any."""

import pytest
from pyspark.sql import functions as F

from tabprep.operators.joins import join_modules
from tabprep.sources.buckets import SPINE, join_buckets, open_buckets, write_buckets


@pytest.fixture
def modules(make):
    a = make([(1, "x", 1.0), (2, "x", 2.0), (2, "y", 3.0), (None, "x", 4.0), (7, None, 5.0)], "id int, `c y` string, v double")
    b = make([(2, "x", 10), (2, "x", 11), (3, "x", 12), (None, "x", 13)], "id int, `c y` string, v int")
    c = make([(9, "z", "only")], "id int, `c y` string, w string")
    return {"a": a, "b": b, "c": c}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_join_without_exchange(spark, modules, tmp_path, no_broadcast):
    keys = ["id", "c y"]
    layout = write_buckets(modules, keys, str(tmp_path / "m"), 8)
    wide = join_buckets(spark, layout)
    text = plan(wide)
    assert "Exchange" not in text and "SortMergeJoin" in text
    want = join_modules(modules, keys)
    columns = sorted(want.columns)
    assert sorted(wide.columns) == columns
    key = lambda r: tuple(map(repr, r))
    assert sorted(map(tuple, wide.select(*[F.col(f"`{c}`") for c in columns]).collect()), key=key) == sorted(
        map(tuple, want.select(*[F.col(f"`{c}`") for c in columns]).collect()), key=key)


def test_another_session_opens_the_layout(spark, modules, tmp_path, no_broadcast):
    layout = write_buckets(modules, ["id", "c y"], str(tmp_path / "m"), 16)
    other = open_buckets(spark.newSession(), str(tmp_path / "m"))
    assert other.keys == layout.keys and set(other.tables) == {"a", "b", "c", SPINE}
    again = join_buckets(spark, other, ["a", "c"])
    assert "Exchange" not in plan(again) and again.where("w = 'only'").count() == 1
    assert again.count() == 5 + 2  # every key of the spine, and the rows whose key is not known
