import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprep.operators import resample, scale, split
from tests.conftest import rows


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(2)
    data = [(i, int(rng.random() < 0.1), float(rng.normal()), float(rng.integers(0, 5))) for i in range(500)]
    return spark.createDataFrame(data, "id long, y int, a double, b double")


@pytest.mark.parametrize("share", [0.8, 0.5, 0.0, 1.0])
def test_split_is_exact_per_class(labelled, share):
    out = split.fit_split(labelled, "y", "id", share).transform(labelled).groupBy("y").agg(
        F.count_if(F.col("split") == "train").alias("train"), F.count("*").alias("n")).collect()
    assert [r["train"] for r in out] == [int(r["n"] * share + 0.5) for r in out]


def test_split_follows_the_hash(labelled):
    out = split.fit_split(labelled, "y", "id", 0.8, seed=7).transform(labelled).collect()
    for y in (0, 1):
        mine = sorted((hashlib.md5(f"7:{r['id']}".encode()).hexdigest(), r["id"], r["split"]) for r in out if r["y"] == y)
        assert [m[2] for m in mine] == sorted((m[2] for m in mine), reverse=True)  # train first
    model = split.fit_split(labelled, "y", "id", 0.8, seed=7)
    again = {r["id"]: r["split"] for r in model.transform(labelled.repartition(7).where("id < 50")).collect()}
    assert again == {r["id"]: r["split"] for r in out if r["id"] < 50}


def test_split_with_null_class(make):
    df = make([(i, None if i < 10 else 1) for i in range(20)], "id int, y int")
    out = split.fit_split(df, "y", "id", 0.5).transform(df)
    assert sorted(rows(out.groupBy("y", "split").count()), key=str) == sorted(
        [(None, "train", 5), (None, "test", 5), (1, "train", 5), (1, "test", 5)], key=str)


@pytest.mark.parametrize("box, chunk", [(2048, 16384), (1, 5)])
def test_oversampling(labelled, box, chunk):
    out = resample.oversample_minority(labelled, "y", ["a", "b"], "id", k=3, box_donors=box, chunk_queries=chunk)
    counts = {(r["y"], r["synthetic"]): r["n"] for r in out.groupBy("y", "synthetic").agg(F.count("*").alias("n")).collect()}
    assert counts[1, False] + counts[1, True] == counts[0, False] and (0, True) not in counts
    minority = {r["id"]: np.array([r["a"], r["b"]]) for r in labelled.where("y = 1").collect()}
    draws: dict[int, int] = {}
    for r in out.where("synthetic").collect():
        draws[r["id"]] = draws.get(r["id"], 0) + 1
        seed = minority[r["id"]]
        near = sorted((((p - seed) ** 2).sum(), i) for i, p in minority.items() if i != r["id"])[:3]
        dice = hashlib.md5(f"42:{r['id']}:{r['draw']}".encode()).hexdigest()
        pick, gap = int(dice[:8], 16) / 2 ** 32, int(dice[8:16], 16) / 2 ** 32
        target = minority[near[int(pick * 3)][1]]
        assert [r["a"], r["b"]] == pytest.approx(list(seed + gap * (target - seed)), abs=1e-9)
    assert max(draws.values()) - min(draws.values()) <= 1 and set(draws) == set(minority)


def test_oversampling_limits(make, labelled):
    done = resample.oversample_minority(labelled, "y", ["a", "b"], "id", ratio=0.01)
    assert done.where("synthetic").count() == 0
    with pytest.raises(ValueError):
        resample.oversample_minority(make([(1, 1, 1.0)], "id int, y int, a double"), "y", ["a"], "id")


def test_scaling(make, spark):
    df = make([(1.0, 5, None), (3.0, 5, None), (None, 5, None)], "x double, c int, e double")
    model = scale.fit_scaler(df, ["x", "c", "e", "absent"])
    assert rows(model.transform(df)) == [(-1.0, 0.0, None), (1.0, 0.0, None), (None, 0.0, None)]
    assert rows(model.transform(make([(5.0, 7, 1.0)], "x double, c int, e double"))) == [(3.0, 2.0, 1.0)]
    assert model.to_table(spark).count() == 3


def test_incomplete_minority_rows_are_not_seeds(make):
    data = [(i, 0, float(i), None if i % 10 == 0 else float(i % 7)) for i in range(40)] + [(100 + i, 1, 1.0, 1.0) for i in range(120)]
    df = make(data, "id int, y int, a double, b double")
    out = resample.oversample_minority(df, "y", ["a", "b"], "id")
    made = out.where("synthetic")
    assert made.count() == 80 and made.where("a is null or b is null or id % 10 = 0").isEmpty()
    with pytest.raises(ValueError, match="only 1"):
        resample.oversample_minority(df.where("y = 1 or id in (1, 10, 20)"), "y", ["a", "b"], "id")
