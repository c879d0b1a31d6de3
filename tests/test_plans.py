import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprep.operators.encode import EncodingPlan
from tabprep.plans import features as fx
from tabprep.plans import modelling
from tabprep.plans.consolidate import availability_report, consolidate, consolidate_modules, read_modules, stack_modules
from tabprep.plans.harmonise import clean_module, gate_module, harmonise_module
from tabprep.plans.prepare import PreparePlan, preparation_report, prepare
from tests.conftest import by, rows


def test_gates(make, spark):
    df = make([(1.0, "5")], "SEQN double, BMXWT string")
    assert gate_module(df, "2011-2012").ok
    assert gate_module(df.where("false"), "2011-2012").reason == "no rows"
    assert gate_module(df.drop("SEQN"), "2011-2012").reason == "SEQN not found"
    assert gate_module(df, None).reason == "cycle not given"
    verdict = gate_module(df.drop("BMXWT"), "2011-2012")
    assert rows(verdict.to_table(spark)) == [(False, "no target variables")]


def test_harmonise(make):
    df = make([(1.0, "120", "x", "7", 9), (2.0, "5d", None, "8", 9)], "SEQN double, BPXSY1 string, BPXDI1 string, BPXOSY1 string, junk int")
    assert rows(harmonise_module(df, "2011-2012")) == [(1.0, 120.0, None), (2.0, None, None)]
    assert harmonise_module(df, "2011-2012").columns == ["SEQN", "BPX_SYS", "BPX_DIA"]
    assert rows(harmonise_module(df, "2017-2020")) == [(1.0, 7.0), (2.0, 8.0)]


@pytest.fixture
def tree(make, tmp_path):
    """Two cycles; module files carry a cycle letter in their names."""
    def put(cycle, module, df):
        assert clean_module(df, cycle, str(tmp_path / cycle / f"{module}.parquet")).ok

    put("2011-2012", "DEMO_G", make([(1.0, 30.0), (2.0, 61.0)], "SEQN double, RIDAGEYR double"))
    put("2011-2012", "GHB_G", make([(1.0, 5.7), (3.0, float("nan"))], "SEQN double, LBXGH double"))
    put("2011-2012", "BPX_G", make([(2.0, 130.0, 0.0)], "SEQN double, BPXSY1 double, BPXDI1 double"))
    put("2021-2023", "DEMO_L", make([(1.0, 50.0)], "SEQN double, RIDAGEYR double"))
    put("2021-2023", "BPX_L", make([(1.0, 118.0, 70.0)], "SEQN double, BPXOSY1 double, BPXODI1 double"))
    return str(tmp_path)


def test_consolidate(spark, tree, tmp_path):
    out = consolidate(spark, tree, str(tmp_path / "out" / "wide"))
    names = ["cycle", "subject_id", "age_years", "glucose_value", "diabetes_risk", "BPX_SYS", "BPX_DIA"]
    assert rows(out.select(names), "cycle", "subject_id") == [
        ("2011-2012", 1.0, 30.0, 5.7, 1, None, None), ("2011-2012", 2.0, 61.0, None, None, 130.0, 0.0),
        ("2011-2012", 3.0, None, None, None, None, None), ("2021-2023", 1.0, 50.0, None, None, 118.0, 70.0)]


def test_consolidation_choices(spark, tree):
    modules = read_modules(spark, tree)
    assert list(modules) == [("2011-2012", "BPX_G"), ("2011-2012", "DEMO_G"), ("2011-2012", "GHB_G"), ("2021-2023", "BPX_L"), ("2021-2023", "DEMO_L")]
    one, chain = (consolidate_modules(modules, unique=u, null_label=0) for u in (True, False))
    names = sorted(one.columns)
    assert sorted(rows(one.select(names)), key=str) == sorted(rows(chain.select(names)), key=str)
    assert one.where("diabetes_risk = 0").count() == 3
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    stacked = stack_modules(modules)
    assert stacked.count() == 7 and stacked.where("SEQN_UNIQUE = '1_2021-2023'").count() == 2
    report = by(availability_report(spark, modules), "variable")
    assert tuple(report["BPX_SYS"]) == ("BPX_SYS", 2, "2011-2012, 2021-2023") and report["SEQN"]["rows"] == 7


SURVEY = ("subject_id double, age_years double, gender double, ethnicity double, smoker double, hypertension double, weight_kg double, "
          "height_cm double, waist_cm double, bmi double, BPX_SYS double, BPX_DIA double, glucose_value double, creatinine double, TRIGLY double")


@pytest.fixture(scope="module")
def survey(spark):
    nan, n = float("nan"), None
    data = [
        (1.0, 30.0, 1.0, 1.0, 1.0, 2.0, 70.0, 170.0, 80.0, 24.0, 120.0, 80.0, 5.7, 1.0, n),
        (2.0, 61.0, 2.0, 2.0, 2.0, n, 80.0, 180.0, 90.0, n, 141.0, 0.0, 5.0, n, n),
        (3.0, 18.0, n, 3.0, 7.0, 9.0, 60.0, n, 70.0, n, 140.0, 90.0, 6.0, 3.0, n),
        (4.0, 101.0, 2.0, n, 9.0, 1.0, n, n, n, n, n, 91.0, 5.5, 2.0, n),
        (5.0, 0.0, 2.0, 1.0, n, 2.0, 75.0, 172.0, nan, 25.0, 118.0, 70.0, 5.1, nan, n),
        (6.0, 40.0, 1.0, 1.0, 1.0, 1.0, 70.0, 170.0, 80.0, 24.0, 110.0, 60.0, n, 9.0, n),
        (7.0, 45.0, 1.0, 1.0, 1.0, 1.0, 70.0, 170.0, 80.0, 24.0, 110.0, 60.0, nan, 9.0, n),
    ]
    return spark.createDataFrame(data, SURVEY)


def test_prepare(survey):
    out, model = prepare(survey, {"onehot_cols": ["gender", "ethnicity"], "ordinal_cols": [], "target_cols": None}, keys=("subject_id",))
    assert out.columns == ["age_years", "smoker", "hypertension", "weight_kg", "height_cm", "waist_cm", "bmi", "BPX_SYS", "BPX_DIA",
                           "glucose_value", "creatinine", "TRIGLY", "gender_2", "ethnicity_2", "ethnicity_3"]
    got = {r["age_years"]: r for r in out.collect()}
    assert set(got) == {30, 61, 18, 101, 0}  # rows without the target are gone
    assert [got[a]["hypertension"] for a in (30, 61, 18, 101, 0)] == [0, 1, 0, 1, 0]
    assert [got[a]["smoker"] for a in (30, 61, 18, 101, 0)] == [1, 0, 0, 0, 0]
    assert got[61]["bmi"] == pytest.approx(80 / 1.8 ** 2) and got[61]["BPX_DIA"] == 85.0  # 0 is missing; median of 70, 80, 90, 91
    assert got[101]["BPX_SYS"] == 130.0 and got[61]["creatinine"] == 2.0 and got[61]["TRIGLY"] == 0.0
    assert got[18]["gender_2"] == 1.0 and got[101]["ethnicity_2"] == 0.0  # modes 2 and 1
    # No known measure at all: column means of the staged rows.
    bmis = [24.0, 80 / 1.8 ** 2, 25.0]
    assert got[101]["bmi"] == pytest.approx(np.mean(bmis)) and got[101]["weight_kg"] == pytest.approx(np.mean([70, 80, 60, 75]))
    assert out.na.drop("any").count() == 5
    report = preparation_report(survey, out).first()
    assert (report["before"], report["after"], report["removed"], report["missing_left"], report["passed"]) == (7, 5, 2, 0, True)
    assert (report["columns_added"], report["columns_dropped"]) == (3, 3)


def test_prepared_model_on_another_batch(survey, make):
    _, model = prepare(survey, {"onehot_cols": ["gender"]}, keys=("subject_id",))
    batch = make([(9.0, 20.0, None, 1.0, None, None, None, 170.0, 80.0, None, None, 0.0, 6.1, None, 3.0)], SURVEY)
    row = model.transform(batch).first()
    assert row["weight_kg"] is not None and row["BPX_DIA"] == 85.0 and row["gender_2"] == 1.0 and row["TRIGLY"] == 3.0
    assert "subject_id" in model.transform(batch, keep_ids=True).columns


def test_prepare_needs_a_key_only_for_neighbours(survey):
    with pytest.raises(ValueError):
        PreparePlan(keys=()).fit(survey)
    out = PreparePlan(keys=(), knn_columns=(), encoding=EncodingPlan()).fit(survey).transform(survey)
    assert out.where("waist_cm is null").count() == 0


def test_clinical_features(make):
    df = make([(120.0, 60.0, 150.0, 100.0, 200.0, 50.0, 90.0, 10.0, 70.0)], "s double, d double, tg double, g double, tc double, hdl double, w double, ins double, kcal double")
    out = fx.add_features(df, {
        "map": fx.mean_arterial_pressure("s", "d"), "pp": fx.pulse_pressure("s", "d"), "r": fx.pressure_ratio("s", "d"), "tyg": fx.tyg_index("tg", "g"),
        "tw": fx.tyg_waist("tg", "g", "w"), "nh": fx.non_hdl("tc", "hdl"), "ldl": fx.friedewald_ldl("tc", "hdl", "tg"), "hdl2": fx.friedewald_hdl("tc", "w", "tg"),
        "homa": fx.homa_ir("g", "ins"), "q": fx.quicki("g", "ins"), "fat": fx.energy_percent("ins", "kcal", "fat"),
        "score": fx.criteria_score(fx.metabolic_syndrome_criteria("w", "tg", "hdl", "s", "d", "g", F.lit(True))),
    }).first()
    tyg = math.log(150 * 100 / 2)
    assert [out[c] for c in ("map", "pp", "r", "nh", "ldl", "hdl2", "score")] == [80.0, 60.0, 2.0, 150.0, 120.0, 80.0, 2]
    assert [out[c] for c in ("tyg", "tw", "homa", "q", "fat")] == pytest.approx([tyg, tyg * 90, 1000 / 405, 1 / 3, 9000 / 70])


@pytest.fixture(scope="module")
def separable(spark):
    rng = np.random.default_rng(4)
    data = [(int(y), float(y * 1.5 + rng.normal()), float(rng.normal())) for y in rng.integers(0, 2, 300)]
    return spark.createDataFrame(data, "y int, a double, b double")


@pytest.mark.parametrize("name, params", [
    ("logistic_regression", {"maxIter": 10}), ("random_forest", {"numTrees": 5, "maxDepth": 3}), ("boosted_trees", {"maxIter": 3, "maxDepth": 2})])
def test_classifiers(spark, separable, name, params):
    model = modelling.train(separable, "y", ["a", "b"], name, **params)
    scored = modelling.score(model, separable, "y").cache()
    area = modelling.roc_auc(scored)
    assert area > 0.75 and modelling.roc_auc_table(scored).first()["auc"] == pytest.approx(area, abs=1e-9)
    report = by(modelling.class_report(scored), "class")
    assert report[0.0]["support"] + report[1.0]["support"] == 300
    assert sum(r["n"] for r in modelling.confusion(scored).collect()) == 300
    if name != "logistic_regression":
        assert modelling.importances(spark, model, ["a", "b"]).first()["feature"] == "a"
    with pytest.raises(ValueError):
        modelling.classifier("other")


def test_cross_validation(separable):
    model = modelling.cross_validate(separable, "y", ["a", "b"], "logistic_regression", {"regParam": [0.0, 10.0]}, folds=2, maxIter=5)
    assert len(model.avgMetrics) == 2 and max(model.avgMetrics) > 0.7


def test_cross_validation_spreads_its_rows(separable, monkeypatch):
    seen = []
    fit = modelling.CrossValidator.fit
    monkeypatch.setattr(modelling.CrossValidator, "fit", lambda self, df: seen.append(df) or fit(self, df))
    monkeypatch.setattr(modelling, "TASK_ROWS", 100, raising=False)
    modelling.cross_validate(separable.coalesce(1), "y", ["a", "b"], "logistic_regression", {"regParam": [0.0]}, folds=2, maxIter=2)
    parts = [r["n"] for r in seen[0].groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()]
    cores = separable.sparkSession.sparkContext.defaultParallelism
    assert sum(parts) == separable.where("y is not null").count() and len(parts) == min(cores, -(-sum(parts) // 100))
    assert seen[0].columns == ["a", "b", modelling.LABEL_OUT]


@pytest.fixture(scope="module")
def keyed(spark):
    rng = np.random.default_rng(9)
    data = [(n, int(y), float(y * 1.5 + rng.normal()), float(rng.normal()), float(y * 0.4 + rng.normal())) for n, y in enumerate(rng.integers(0, 2, 1500))]
    return spark.createDataFrame(data, "id long, y int, useful double, useless double, weak double").repartition(3)


@pytest.mark.parametrize("name, params", [("logistic_regression", {"maxIter": 20}), ("random_forest", {"numTrees": 10, "maxDepth": 4})])
def test_permutation_importance(keyed, name, params):
    features = ["useless", "useful", "weak"]
    model = modelling.train(keyed, "y", features, name, **params)
    found = modelling.permutation_importance(model, keyed, "y", features, "id")
    got = by(found, "feature")
    assert [r["feature"] for r in found.collect()] == ["useful", "weak", "useless"]
    assert got["useful"]["importance"] > 0.2 and abs(got["useless"]["importance"]) < 0.03
    again = by(modelling.permutation_importance(model, keyed.repartition(7), "y", features, "id"), "feature")
    assert all(again[f]["importance"] == pytest.approx(got[f]["importance"], abs=1e-9) for f in features)


def test_halving_search_finds_the_planted_setting(keyed):
    # Any other penalty is so large that no feature is left.
    space = {"regParam": [0.7, 2.0, 0.0, 3.0, 5.0, 8.0, 13.0, 21.0, 34.0], "elasticNetParam": [1.0]}
    found = modelling.halving_search(keyed, "y", ["useful", "useless"], "logistic_regression", space, "id", settings=9, factor=3, maxIter=20)
    assert found.best == {"regParam": 0.0, "elasticNetParam": 1.0} and found.area > 0.75
    trials = found.trials.collect()
    assert [sum(r["round"] == n for r in trials) for n in range(3)] == [9, 3, 1]
    sizes = [next(r["rows"] for r in trials if r["round"] == n) for n in range(3)]
    assert sizes[0] < sizes[1] < sizes[2] and abs(sizes[2] - 1200) < 100 and abs(sizes[0] - sizes[2] / 9) < 60
    assert sum(r["kept"] for r in trials if r["round"] == 0) == 3
    assert next(r["area"] for r in trials if r["round"] == 2) == pytest.approx(found.area)
    assert modelling.roc_auc(modelling.score(found.model, keyed, "y")) > 0.75


def test_halving_search_with_one_setting_or_one_class(keyed):
    one = modelling.halving_search(keyed, "y", ["useful"], "logistic_regression", {"regParam": [0.1]}, "id", maxIter=5)
    assert one.best == {"regParam": 0.1} and one.trials.count() == 1 and one.trials.first()["kept"]


def test_roc_ties(make):
    df = make([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1), (None, 0.3)], "label int, score double")
    assert modelling.roc_auc_table(df).first()["auc"] == pytest.approx((1 + 1 + 1 + 0.5) / 4)


def test_class_report_without_hits(make):
    out = by(modelling.class_report(make([(0, 1), (0, 1), (1, 1)], "label int, prediction int")), "class")
    assert tuple(out[0]) == (0, 0.0, 0.0, 0.0, 2) and out[1]["precision"] == pytest.approx(1 / 3)


def test_run_metadata(spark, make, tmp_path):
    df = make([(0, 1.0), (1, 2.0), (1, 3.0)], "y int, a double")
    out = {(r["section"], r["name"]): r["value"] for r in modelling.run_metadata(spark, df, df.limit(1), "y", ["a"]).collect()}
    assert out["rows", "train"] == 3 and out["class_train", "1"] == 2 and out["feature", "a"] == 0 and out["columns", "test"] == 2
    modelling.write_metadata(modelling.run_metadata(spark, df, df, "y", ["a"]), str(tmp_path / "meta"))
    assert spark.read.json(str(tmp_path / "meta")).count() == 9
