import pytest
from pyspark.sql import functions as F

from tabprep.operators import encode
from tests.conftest import rows


def test_one_hot_names_and_values(make):
    df = make([(2.0, "b", 1), (1.0, "a", 2), (3.0, "a", 3)], "g double, s string, keep int")
    out = encode.fit_one_hot(df, ["g", "s", "absent"]).transform(df)
    assert out.columns == ["keep", "g_2", "g_3", "s_b"]
    assert rows(out, "keep") == [(1, 1.0, 0.0, 1.0), (2, 0.0, 0.0, 0.0), (3, 0.0, 1.0, 0.0)]
    assert encode.fit_one_hot(df, ["g"], float_text=True).column_names() == ["g_2.0", "g_3.0"]
    assert encode.fit_one_hot(df, ["g"], drop_first=False).column_names() == ["g_1", "g_2", "g_3"]


def test_one_hot_null_is_a_level(make):
    df = make([("a",), ("b",), (None,)], "s string")
    out = encode.fit_one_hot(df, ["s"]).transform(df)
    assert out.columns == ["s_b", "s_None"] and rows(out) == [(0.0, 0.0), (1.0, 0.0), (0.0, 1.0)]


def test_one_hot_unseen_level(make):
    df, other = make([("a",), ("b",)], "s string"), make([("c",)], "s string")
    with pytest.raises(Exception, match="unseen level in s: c"):
        encode.fit_one_hot(df, ["s"]).transform(other).collect()
    with pytest.raises(Exception, match="unseen level"):
        encode.fit_one_hot(df, ["s"]).transform(make([(None,)], "s string")).collect()
    assert rows(encode.fit_one_hot(df, ["s"], unseen="ignore").transform(other)) == [(0.0,)]


def test_one_hot_many_levels(spark, monkeypatch):
    monkeypatch.setattr(encode, "WIDE_LEVELS", 5)
    df = spark.range(6).select(F.col("id").cast("string").alias("s"))
    df = df.withColumn("few", F.col("s") % 2).union(spark.createDataFrame([(None, 1.0)], "s string, few double"))
    model = encode.fit_one_hot(df, ["s", "few"])
    out = model.transform(df)
    assert out.columns == ["few_1", "s_onehot"]
    assert sorted(map(str, rows(out.select("s_onehot")))) == sorted(
        ["({},)"] + [f"({{{i}: 1.0}},)" for i in range(6)])  # the first level is dropped, NULL comes last
    everything = encode.fit_one_hot(df, ["s"], drop_first=False).transform(df.where("s is null"))
    assert rows(everything.select("s_onehot")) == [({6: 1.0},)]
    other = spark.createDataFrame([("z", 1.0)], "s string, few double")
    with pytest.raises(Exception, match="unseen level in s: z"):
        model.transform(other).collect()
    assert rows(encode.fit_one_hot(df, ["s"], unseen="ignore").transform(other).select("s_onehot")) == [({},)]
    df = df.where("s is not null")
    vectors = encode.fit_one_hot_sparse(df, ["s"]).transform(df).orderBy("s").select("s_vec").collect()
    assert [sum(v[0].toArray()) for v in vectors] == [0, 1, 1, 1, 1, 1]  # the first level is dropped


def test_ordinal(make):
    df = make([("low", "b"), ("high", "a"), ("odd", None), (None, "c")], "o string, s string")
    out = encode.fit_ordinal(df, ["o", "s"], {"o": ["low", "high"]}).transform(df)
    assert rows(out) == [(0.0, 1.0), (1.0, 0.0), (-1.0, -1.0), (-1.0, 2.0)]


@pytest.mark.parametrize("inline", [1000, 3])
def test_ordinal_of_many_levels(spark, inline):
    df = spark.range(40).select(F.format_string("k%03d", F.col("id") * 7 % 40).alias("s"), ((F.col("id") * 7) % 40).cast("double").alias("rank"))
    out = encode.fit_ordinal(df, ["s"], inline_levels=inline).transform(df)
    assert rows(out.where("s <> rank")) == []


def test_target_mean(make):
    df = make([("a", 1.0), ("a", 0.0), ("b", 1.0), (None, 1.0), ("c", None)], "k string, y double")
    overall = 3 / 4
    model = encode.fit_target(df, ["k"], "y", smoothing=2.0)
    out = [r["k"] for r in model.transform(df).orderBy("k", "y").collect()]
    a, b = (1 + 2 * overall) / 4, (1 + 2 * overall) / 3
    assert sorted(out) == pytest.approx(sorted([a, a, b, overall, overall]))
    new = make([("zzz", None)], "k string, y double")
    assert model.transform(new).first()["k"] == overall


def test_target_limits(make):
    df = make([("a", 1.0), ("a", 0.0), ("b", 1.0)], "k string, y double")
    none = encode.fit_target(df, ["k"], "y", smoothing=0.0).transform(df)
    assert sorted(r["k"] for r in none.collect()) == [0.5, 0.5, 1.0]
    much = encode.fit_target(df, ["k"], "y", smoothing=1e12).transform(df)
    assert [r["k"] for r in much.collect()] == pytest.approx([2 / 3] * 3)
    assert encode.fit_target(df, ["k"], "absent").transform(df).columns == ["k", "y"]
    large = encode.fit_target(df, ["k"], "y", smoothing=0.0, table_rows=1)
    assert not large.tables["k"][1] and sorted(r["k"] for r in large.transform(df).collect()) == [0.5, 0.5, 1.0]


def test_out_of_fold(spark):
    df = spark.range(200).select("id", (F.col("id") % 3).cast("string").alias("k"), (F.col("id") % 7 == 0).cast("double").alias("y"))
    data = [(r["id"], r["k"], r["y"], r["f"]) for r in df.withColumn("f", encode.fold_of("id", 4)).collect()]
    out = {r["id"]: r["k"] for r in encode.target_out_of_fold(df, "k", "y", "id", folds=4, smoothing=3.0).collect()}
    for i, k, _, f in data:
        rest = [d for d in data if d[3] != f]
        base, mine = sum(d[2] for d in rest) / len(rest), [d[2] for d in rest if d[1] == k]
        assert out[i] == pytest.approx((sum(mine) + 3 * base) / (len(mine) + 3))


def test_plan(make):
    df = make([("a", "x", "p", 1.0), ("b", "y", "q", 0.0)], "one string, two string, three string, y double")
    plan = encode.EncodingPlan.from_config({
        "onehot_cols": ["one"], "ordinal_cols": ["two"], "target_cols": {"columns": ["three"], "target": "y", "smoothing": 0.0}})
    model = plan.fit(df)
    assert list(model.steps) == ["onehot", "ordinal", "target"]
    assert rows(model.transform(df).select("one_b", "two", "three")) == [(0.0, 0.0, 1.0), (1.0, 1.0, 0.0)]
    assert encode.EncodingPlan.from_config(None).fit(df).transform(df).columns == df.columns
    with pytest.raises(ValueError):
        encode.EncodingPlan(one_hot=("one",), ordinal=("one",)).fit(df)
