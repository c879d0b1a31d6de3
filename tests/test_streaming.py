import pandas as pd

from tabprep.operators.encode import EncodingPlan
from tabprep.plans.prepare import PreparePlan
from tabprep.streaming.apply import module_stream, write_prepared, write_prepared_batches
from tests.conftest import rows

SCHEMA = "subject_id double, glucose_value double, BPX_SYS double, BPX_DIA double, gender string, weight_kg double, waist_cm double"


def put(root, cycle, name, data):
    (root / cycle).mkdir(parents=True, exist_ok=True)
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    pd.DataFrame(data, columns=names).astype({n: "float64" for n in names if n != "gender"}).to_parquet(root / cycle / f"{name}.parquet")


FIT = [(1.0, 5.0, 120.0, 80.0, "f", 60.0, 70.0), (2.0, 6.0, 130.0, 0.0, "m", 80.0, 90.0), (3.0, 6.0, None, 90.0, "m", None, 88.0)]


def test_fitted_model_on_a_stream(spark, tmp_path):
    model = PreparePlan(knn_columns=(), encoding=EncodingPlan(one_hot=("gender",))).fit(spark.createDataFrame(FIT, SCHEMA))
    source, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    put(source, "c1", "A", [(10.0, 5.5, None, 0.0, "m", 1.0, 1.0), (11.0, None, 1.0, 1.0, "f", 1.0, 1.0)])

    def run():
        write_prepared(model, module_stream(spark, str(source), SCHEMA), out, mark).awaitTermination()
        return sorted(rows(spark.read.parquet(out).select("cycle", "module", "BPX_SYS", "BPX_DIA", "gender_m")))

    first = [("c1", "A", 125.0, 85.0, 1.0)]
    assert run() == first
    assert run() == first  # nothing new: files already read are skipped
    put(source, "c2", "B", [(12.0, 5.5, 100.0, 60.0, "f", 1.0, 1.0)])
    assert run() == [*first, ("c2", "B", 100.0, 60.0, 0.0)]


def test_neighbour_model_in_batches(spark, tmp_path):
    plan = PreparePlan(keys=("subject_id",), knn_columns=("weight_kg", "waist_cm"))
    model = plan.fit(spark.createDataFrame(FIT, SCHEMA))
    put(tmp_path / "in", "c1", "A", [(10.0, 5.5, 120.0, 80.0, "m", None, 90.0)])
    stream = module_stream(spark, str(tmp_path / "in"), SCHEMA, max_files=1)
    write_prepared_batches(model, stream, str(tmp_path / "out"), str(tmp_path / "mark")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("weight_kg")) == [(80.0,)]
