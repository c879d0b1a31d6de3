import datetime
import decimal

import pytest

from tabprep.operators import encode, impute, scale, split
from tabprep.operators.knn import fit_knn
from tabprep.plans.prepare import PreparePlan
from tabprep.plans.store import load_model, save_model
from tests.conftest import rows


def test_prepared_model_survives_saving(spark, make, tmp_path):
    df = make(
        [(float(i), 5.0 + i % 3, "ab"[i % 2] if i % 5 else None, 60.0 + i if i % 4 else None, 170.0 + i, 80.0 if i % 3 else None, 25.0)
         for i in range(40)],
        "subject_id double, glucose_value double, gender string, weight_kg double, height_cm double, waist_cm double, bmi double")
    plan = PreparePlan(keys=("subject_id",), encoding=encode.EncodingPlan(one_hot=("gender",)))
    model = plan.fit(df)
    save_model(model, str(tmp_path / "m"), spark)
    again = load_model(spark, str(tmp_path / "m"))
    assert again.plan == model.plan
    assert sorted(rows(again.transform(df))) == sorted(rows(model.transform(df)))
    with pytest.raises(Exception):
        save_model(model, str(tmp_path / "m"), spark)


def test_every_encoder_survives_saving(spark, make, tmp_path, monkeypatch):
    monkeypatch.setattr(encode, "WIDE_LEVELS", 3)
    df = make([(i, f"v{i % 7}", decimal.Decimal(i % 2), datetime.date(2020, 1, 1 + i % 3), float(i % 2), 1.5 * i) for i in range(30)],
              "id int, s string, d decimal(5,1), day date, y double, x double")
    models = [
        encode.fit_one_hot(df, ["s", "d", "day"]), encode.fit_ordinal(df, ["s", "day"]), encode.fit_ordinal(df, ["s"], inline_levels=2),
        encode.fit_target(df, ["s"], "y"), scale.fit_scaler(df, ["x"]), impute.fit_median(df, ["x"]), fit_knn(df, ["x", "y"], ["id"]),
        split.fit_split(df, "y", "id"),
    ]
    for n, model in enumerate(models):
        save_model(model, str(tmp_path / str(n)), spark)
        again = load_model(spark, str(tmp_path / str(n)))
        assert sorted(map(str, rows(again.transform(df)))) == sorted(map(str, rows(model.transform(df)))), type(model)
    with pytest.raises(TypeError):
        save_model(encode.OneHot({"s": [object()]}), str(tmp_path / "x"), spark)
