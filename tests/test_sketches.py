"""Mergeable sketches against exact figures, and heavy hitters against full counts."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprep.functions import sketches
from tabprep.operators import heavy
from tests.conftest import rows


@pytest.fixture(scope="module")
def measured(spark):
    rng = np.random.default_rng(4)
    data = [(int(c), float(x), None if x > 3 else float(round(x)), i) for i, (c, x) in enumerate(zip(rng.integers(0, 4, 40_000), rng.normal(size=40_000)))]
    return spark.createDataFrame(data, "cycle int, x double, y double, id long").repartition(6), data


def test_merged_quantiles_stay_within_the_stated_error(measured):
    df, data = measured
    stored = sketches.quantile_sketches(df, ["x", "y"], ["cycle"])
    assert stored.count() == 8
    merged = sketches.merge_quantiles(stored)
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    found = {r["variable"]: r for r in sketches.sketch_quantiles(merged, probabilities).collect()}
    for n, name in ((1, "x"), (2, "y")):
        values = np.sort([r[n] for r in data if r[n] is not None])
        assert found[name]["n"] == len(values) and found[name]["q"][0] == values[0] and found[name]["q"][-1] == values[-1]
        for p, q in zip(probabilities, found[name]["q"]):
            low, high = np.searchsorted(values, [q], "left")[0], np.searchsorted(values, [q], "right")[0]
            assert low / len(values) - 2 * sketches.RANK_ERROR <= p <= high / len(values) + 2 * sketches.RANK_ERROR


@pytest.mark.parametrize("col, p", [("x", 0.5), ("x", 0.013), ("y", 0.25), ("y", 1.0), ("x", 0.0)])
def test_sketches_guide_the_exact_quantile(measured, col, p):
    df, data = measured
    stored = sketches.merge_quantiles(sketches.quantile_sketches(df, ["x", "y"], ["cycle"]))
    values = np.array([r[1 if col == "x" else 2] for r in data if r[1 if col == "x" else 2] is not None])
    assert sketches.bracketed_quantile(df, stored, col, p).first()[0] == pytest.approx(np.quantile(values, p), abs=1e-12)
    # A bracket that misses widens.
    assert sketches.bracketed_quantile(df, stored, col, p, error=0.0).first()[0] == pytest.approx(np.quantile(values, p), abs=1e-12)


def test_quantiles_of_nothing(make):
    df = make([(None, float("nan")), (None, None)], "x double, y double")
    stored = sketches.quantile_sketches(df, ["x", "y"])
    assert [(r["variable"], r["n"], r["q"]) for r in sketches.sketch_quantiles(stored, [0.5]).collect()] == [("x", 0, None), ("y", 0, None)]
    assert sketches.bracketed_quantile(df, stored, "x", 0.5).first()[0] is None


def test_overlaps_of_id_sketches(spark):
    members = {"A": range(0, 30_000), "B": range(20_000, 45_000), "C": range(100_000, 100_500), "D": range(100_100, 100_400)}
    data = [("c1", m, i) for m, ids in members.items() for i in ids] + [("c2", "A", 5), ("c2", "B", 5), ("c2", "B", None)]
    df = spark.createDataFrame(data, "cycle string, module string, id long")
    stored = sketches.id_sketches(df, "id", ["cycle", "module"])
    met = {(r["cycle"], r["left"], r["right"]): (r["both"], r["either"]) for r in sketches.overlaps(stored, ["cycle"], "module").collect()}
    assert len(met) == 7 and met["c2", "A", "B"] == (1, 1)
    for (cycle, a, b), (both, either) in met.items():
        if cycle == "c1":
            x, y = set(members[a]), set(members[b])
            assert abs(both - len(x & y)) <= 4 * sketches.ID_ERROR * len(x | y) and abs(either - len(x | y)) <= 4 * sketches.ID_ERROR * len(x | y)
    assert met["c1", "C", "D"] == (300, 500)  # below 4,096 ids a sketch is exact
    total = {r["cycle"]: r["ids"] for r in sketches.merge_ids(stored, ["cycle"]).collect()}
    assert total["c2"] == 1 and abs(total["c1"] - 45_500) <= 4 * sketches.ID_ERROR * 45_500


def plain(values, k):
    return sorted(Counter(v for v in values if v is not None).items(), key=lambda p: (-p[1], p[0]))[:k]


@pytest.mark.parametrize("counters", [40, 10_000])
def test_heavy_hitters_among_near_unique_values(spark, counters):
    random.seed(2)
    values = [f"hot {n}" for n in range(12) for _ in range(900 - 10 * n)] + [f"once {n}" for n in range(30_000)] + [None] * 500
    random.shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(5)
    assert rows(heavy.heavy_hitters(df, "v", 10, counters)) == plain(values, 10)


def test_survivors_are_few(spark):
    df = spark.range(200_000).select(F.when(F.col("id") % 10 == 0, F.col("id") % 7).otherwise(F.col("id") + 100).alias("v")).repartition(4)
    kept = heavy._summaries(df.select(F.col("v").alias("value")), 50)
    assert kept.where("lost IS NULL").count() <= 4 * 50
    lost = kept.agg(F.sum("lost")).first()[0]
    exact = {r["v"]: r["n"] for r in df.where("v < 7").groupBy("v").agg(F.count("v").alias("n")).collect()}
    lower = {r["value"]: r["least"] for r in kept.where("value < 7").groupBy("value").agg(F.sum("n").alias("least")).collect()}
    assert all(lower.get(v, 0) <= n <= lower.get(v, 0) + lost for v, n in exact.items())


@pytest.mark.parametrize("values", [[], [None, None], [3, 3, 1, 2, 2], list(range(5000)), [7] * 50])
def test_heavy_hitters_of_odd_columns(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    assert rows(heavy.heavy_hitters(df, "v", 4, 20)) == plain(values, 4)
