"""Saving fitted models below a folder, and loading them in another session.

A model is a frozen dataclass. Its plain fields are written as one JSON row, its level tables and donor tables as Parquet
tables beside it, so a path on any file system that Spark reads will do.
"""

from __future__ import annotations

import dataclasses
import datetime
import decimal
import json

from pyspark.sql import DataFrame, SparkSession

from tabprep.operators.encode import EncodingModel, EncodingPlan, OneHot, Ordinal, TargetMean
from tabprep.operators.impute import ConstantImputer
from tabprep.operators.knn import KnnModel
from tabprep.operators.scale import Scaler
from tabprep.operators.split import StratifiedSplit
from tabprep.plans.prepare import PreparedModel, PreparePlan
from tabprep.sizing import local_table

MODELS = {c.__name__: c for c in (
    ConstantImputer, EncodingModel, EncodingPlan, KnnModel, OneHot, Ordinal, PreparedModel, PreparePlan, Scaler, StratifiedSplit,
    TargetMean,
)}


def save_model(model, path: str, spark: SparkSession) -> None:
    """Write the model; an existing folder is an error."""
    tables: list[DataFrame] = []

    def plain(value):
        if isinstance(value, DataFrame):
            tables.append(value)
            return {"table": len(tables) - 1}
        if dataclasses.is_dataclass(value):
            return {"model": type(value).__name__, "fields": {f.name: plain(getattr(value, f.name)) for f in dataclasses.fields(value)}}
        if isinstance(value, dict):
            return {"dict": [[plain(k), plain(v)] for k, v in value.items()]}
        if isinstance(value, tuple):
            return {"tuple": [plain(v) for v in value]}
        if isinstance(value, (list, set)):
            return [plain(v) for v in value]
        if isinstance(value, decimal.Decimal):
            return {"decimal": str(value)}
        if isinstance(value, datetime.datetime):
            return {"moment": value.isoformat()}
        if isinstance(value, datetime.date):
            return {"day": value.isoformat()}
        if value is None or isinstance(value, (bool, int, float, str)):
            return value
        raise TypeError(f"cannot save a {type(value).__name__}")

    text = json.dumps(plain(model))
    for n, table in enumerate(tables):
        table.write.parquet(f"{path}/table-{n}")
    local_table(spark, [(text,)], "model string").write.parquet(f"{path}/model")


def load_model(spark: SparkSession, path: str):
    """The model written by `save_model`."""
    text = spark.read.parquet(f"{path}/model").first()["model"]

    def back(value):
        if isinstance(value, list):
            return [back(v) for v in value]
        if not isinstance(value, dict):
            return value
        if "model" in value:
            return MODELS[value["model"]](**{k: back(v) for k, v in value["fields"].items()})
        ((kind, held),) = value.items()
        if kind == "table":
            return spark.read.parquet(f"{path}/table-{held}")
        if kind == "dict":
            return {back(k): back(v) for k, v in held}
        if kind == "tuple":
            return tuple(back(v) for v in held)
        return {"decimal": decimal.Decimal, "moment": datetime.datetime.fromisoformat, "day": datetime.date.fromisoformat}[kind](held)

    return back(json.loads(text))
