"""Training and evaluating classifiers on a prepared table, with Spark's own estimators."""

from __future__ import annotations

import json
import logging
import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabprep.operators.ordering import SLICE, order_slices, with_row_index
from tabprep.operators.scale import Scaler
from tabprep.operators.split import row_hash, uniform
from tabprep.session import materialise, run_together
from tabprep.sizing import local_table

LABEL_OUT = "model__label"
FEATURES_OUT = "model__features"
TASK_ROWS = 10_000  # training rows that are worth a task of their own


def classifier(name: str, seed: int = 42, **params):
    """D14: 'random_forest', 'logistic_regression' or 'boosted_trees'."""
    common = {"labelCol": LABEL_OUT, "featuresCol": FEATURES_OUT}
    if name == "random_forest":
        return RandomForestClassifier(**{"numTrees": 100, "seed": seed, **common, **params})
    if name == "logistic_regression":
        return LogisticRegression(**{"maxIter": 100, **common, **params})
    if name == "boosted_trees":
        return GBTClassifier(**{"seed": seed, **common, **params})
    raise ValueError(f"unknown classifier {name}")


def labelled(df: DataFrame, target: str) -> DataFrame:
    return df.where(F.col(target).isNotNull()).withColumn(LABEL_OUT, F.col(target).cast("double"))


def pipeline(features: Sequence[str], estimator) -> Pipeline:
    assembler = VectorAssembler(inputCols=list(features), outputCol=FEATURES_OUT, handleInvalid="error")
    return Pipeline(stages=[assembler, estimator])


def train(df: DataFrame, target: str, features: Sequence[str], name: str, **params) -> PipelineModel:
    """D14."""
    return pipeline(features, classifier(name, **params)).fit(labelled(df, target))


def score(model, df: DataFrame, target: str, keep: Sequence[str] = ()) -> DataFrame:
    """Kept columns, `label`, `prediction` and `score` = probability of class 1."""
    return model.transform(labelled(df, target)).select(
        *keep, F.col(LABEL_OUT).alias("label"), "prediction",
        vector_to_array("probability")[1].alias("score"), "rawPrediction",
    )


def roc_auc(scored: DataFrame) -> float:
    """Area under the ROC curve over all distinct scores, by Spark's distributed evaluator."""
    evaluator = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", numBins=0)
    return evaluator.evaluate(scored.select("label", "score"))


def roc_auc_table(scored: DataFrame, label: str = "label", by_score: str = "score") -> DataFrame:
    """The same area as a one-row table, from counts per distinct score.

    Scores are numbered in slices of the score order, so no task holds them all: the area is the share of
    (positive, negative) pairs ranked right, ties counting half.
    """
    per_score = scored.where(F.col(label).isNotNull() & F.col(by_score).isNotNull()).groupBy(
        F.col(by_score).alias("s")
    ).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    return _area(per_score)


def _area(per_score: DataFrame) -> DataFrame:
    sliced = order_slices(per_score, ["s"])
    local = Window.partitionBy(SLICE).orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    per_slice = sliced.groupBy(SLICE).agg(F.sum("neg").alias("negs"))
    before = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    starts = per_slice.select(
        F.col(SLICE).alias("slice"), F.coalesce(F.sum("negs").over(before), F.lit(0)).alias("start")
    )
    counted = sliced.withColumn("below", F.coalesce(F.sum("neg").over(local), F.lit(0))).join(
        F.broadcast(starts), F.col(SLICE) == F.col("slice")
    )
    wins = F.col("pos").cast("double") * (F.col("start") + F.col("below") + F.col("neg") / F.lit(2.0))
    return counted.agg(
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"), F.sum(wins).alias("wins")
    ).select(
        "positives", "negatives",
        F.try_divide(F.col("wins"), F.col("positives").cast("double") * F.col("negatives")).alias("auc"),
    )


def class_report(scored: DataFrame, label: str = "label", predicted: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, from the confusion counts."""
    pairs = scored.groupBy(F.col(label).alias("t"), F.col(predicted).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    both = pairs.select(F.inline(F.array(
        F.struct(F.col("t").alias("class"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("called"),
                 F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0).alias("right")),
        F.struct(F.col("p").alias("class"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("called"),
                 F.lit(0).cast("bigint").alias("right")),
    )))
    sums = both.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("actual", "called", "right")])
    precision = F.coalesce(F.try_divide(F.col("right").cast("double"), F.col("called").cast("double")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("right").cast("double"), F.col("actual").cast("double")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    return sums.select(
        "class", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), F.col("actual").alias("support")
    )


def confusion(scored: DataFrame, label: str = "label", predicted: str = "prediction") -> DataFrame:
    return scored.groupBy(label, predicted).agg(F.count(F.lit(1)).alias("n"))


def importances(spark: SparkSession, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """(feature, importance) of a tree model, highest first."""
    values = model.stages[-1].featureImportances.toArray()
    return local_table(
        spark, [(f, float(v)) for f, v in zip(features, values)], "feature string, importance double"
    ).orderBy(F.col("importance").desc(), "feature")


def permutation_importance(
    model, df: DataFrame, target: str, features: Sequence[str], key: str, seed: int = 42,
) -> DataFrame:
    """(feature, area, importance) of any model: how much of the area is lost when a feature's values change rows.

    Rows and values are put into two random orders by hashes of `key` (which identifies rows), and meet place by place, so a
    feature keeps its values and loses its rows, in every run alike. Two orders are fixed once for all features; each feature
    then costs one join on the place and one scoring.
    """
    rows = labelled(df, target).select(F.col(key).alias("row__key"), target, *features)
    marked = rows.withColumns({"row__at": row_hash("row__key", seed), "row__from": row_hash("row__key", seed + 1)})
    placed = with_row_index(marked, ["row__at", "row__key"], "row__place")
    donors = with_row_index(placed.drop("row__place"), ["row__from", "row__key"], "row__donor").select(
        "row__donor", *[F.col(f).alias(f"new__{n}") for n, f in enumerate(features)])
    met = materialise(placed.join(donors, F.col("row__place") == F.col("row__donor")))
    whole = roc_auc(score(model, met, target))
    areas = [roc_auc(score(model, met.withColumn(f, F.col(f"new__{n}")), target)) for n, f in enumerate(features)]
    return local_table(
        df.sparkSession, [(f, whole, whole - a) for f, a in zip(features, areas)], "feature string, area double, importance double"
    ).orderBy(F.col("importance").desc(), "feature")


@dataclass(frozen=True)
class Search:
    """What a search has tried, and the best model, trained on all training rows."""

    trials: DataFrame
    best: dict
    area: float
    model: PipelineModel


def halving_search(
    df: DataFrame, target: str, features: Sequence[str], name: str, space: Mapping[str, Sequence], key: str, settings: int = 9,
    factor: int = 3, held_out: float = 0.2, seed: int = 42, parallelism: int = 4, **params,
) -> Search:
    """Successive halving over a random grid.

    `settings` combinations of `space` are drawn. Each round trains those left on a share of the training rows and keeps the best
    1 / `factor` of them by the area on the held-out rows; the share grows by `factor` until the last round takes all rows. Both
    cuts are by the split's hash of `key`, so a smaller share is part of every larger one and reruns agree.

    `trials`: (round, setting, share, rows, area, kept), `setting` as JSON; NULL area where a round's rows hold one class only.
    """
    every = [dict(zip(space, values)) for values in product(*space.values())]
    drawn = random.Random(seed).sample(every, min(settings, len(every)))
    place = uniform(row_hash(key, seed))
    rows = materialise(labelled(df, target).select(F.col(key), target, *features, LABEL_OUT, place.alias("row__u")))
    test, training = rows.where(F.col("row__u") < held_out), rows.where(F.col("row__u") >= held_out)
    rounds = 0
    while factor ** rounds < len(drawn):
        rounds += 1

    def trial(setting: dict, part: DataFrame) -> tuple[PipelineModel | None, float | None]:
        one = {} if name == "logistic_regression" else {"seed": seed}
        try:
            fitted = pipeline(features, classifier(name, **one, **params, **setting)).fit(part)
        except Exception as failure:
            # A share with one class only cannot be learned from; anything else is an error.
            if part.select(target).distinct().count() > 1:
                raise
            logging.getLogger(__name__).info("setting %s: %s", setting, failure)
            return None, None
        return fitted, roc_auc(score(fitted, test, target))

    left, table, best = drawn, [], None
    for n in range(rounds + 1):
        share = min(1.0, factor ** float(n - rounds))
        part = training.where(F.col("row__u") < held_out + (1 - held_out) * share)
        size = part.count()
        areas: list = []
        for begin in range(0, len(left), parallelism):
            areas += run_together(df.sparkSession, *[lambda s=s: trial(s, part) for s in left[begin:begin + parallelism]])
        ranked = sorted(range(len(left)), key=lambda i: -math.inf if areas[i][1] is None else areas[i][1], reverse=True)
        kept = ranked[:1] if n == rounds else sorted(ranked[:max(1, -(-len(left) // factor))])
        table += [(n, json.dumps(left[i], sort_keys=True), share, size, areas[i][1], i in kept) for i in range(len(left))]
        best = left[kept[0]], areas[kept[0]]
        left = [left[i] for i in kept]
    trials = local_table(df.sparkSession, table, "round int, setting string, share double, rows bigint, area double, kept boolean")
    return Search(trials, best[0], best[1][1], best[1][0])


def cross_validate(
    df: DataFrame, target: str, features: Sequence[str], name: str, grid: Mapping[str, Sequence] | None = None,
    folds: int = 3, seed: int = 42, parallelism: int = 2, **params,
) -> CrossValidatorModel:
    """K-fold ROC AUC over a parameter grid; the returned model is refitted with the best parameters."""
    estimator = classifier(name, **({} if name == "logistic_regression" else {"seed": seed}), **params)
    builder = ParamGridBuilder()
    for parameter, values in (grid or {}).items():
        builder = builder.addGrid(getattr(estimator, parameter), list(values))
    validator = CrossValidator(
        estimator=pipeline(features, estimator), estimatorParamMaps=builder.build(), numFolds=folds, seed=seed,
        evaluator=BinaryClassificationEvaluator(labelCol=LABEL_OUT, rawPredictionCol="rawPrediction", numBins=0),
        parallelism=parallelism,
    )
    # Every fold reads the rows again, and every round of boosting is a job on them: they are fixed once, few columns wide, and
    # spread by their number, because their few bytes would keep them in one task.
    rows = materialise(labelled(df, target).select(*features, LABEL_OUT))
    tasks = -(-rows.count() // TASK_ROWS)
    return validator.fit(rows.repartition(max(1, min(df.sparkSession.sparkContext.defaultParallelism, tasks))))


def write_metadata(table: DataFrame, path: str) -> None:
    """A fitted or metadata table as JSON lines."""
    table.write.mode("overwrite").json(path)


def run_metadata(
    spark: SparkSession, train_df: DataFrame, test_df: DataFrame, target: str, features: Sequence[str],
    scaler: Scaler | None = None,
) -> DataFrame:
    """(section, name, value): shapes, class counts, feature names and scaling figures of a run, as a table to store."""
    listed = [("feature", f, float(i)) for i, f in enumerate(features)]
    for name, (mean, std) in (scaler.figures if scaler else {}).items():
        listed += [("scale_mean", name, mean), ("scale_std", name, std)]
    listed += [("columns", "train", float(len(train_df.columns))), ("columns", "test", float(len(test_df.columns)))]
    out = local_table(spark, listed, "section string, name string, value double")
    for part, df in (("train", train_df), ("test", test_df)):
        counts = df.groupBy(F.col(target).cast("string").alias("name")).agg(F.count(F.lit(1)).cast("double").alias("value"))
        out = out.unionByName(counts.select(F.lit(f"class_{part}").alias("section"), "name", "value"))
        out = out.unionByName(df.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
            F.lit("rows").alias("section"), F.lit(part).alias("name"), "value"
        ))
    return out
