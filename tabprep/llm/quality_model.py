"""Operator 8, quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

Tokens are runs of word characters and runs of other visible characters; features are hashed tokens and pairs of
neighbouring tokens (a token next to itself is one feature, whatever the token), counted and scaled to length one. The
model is trained on labelled rows only; scores are sparse dot products of whole texts with the weights.

Training takes at most `max_rows` labelled rows, chosen by a hash of the id; that bound makes it safe to broadcast their
ids to the scan of the texts. Rows are dealt over one task per `rows_per_task`, each runs `epochs` passes in hash order,
and the weights are averaged. The result has at most 2^bits weights, which go to all tasks. Scoring is one scan.

Defined cases: a null text counts as empty; an empty text is scored by the bias alone; without labelled rows every score
is 0.5; labelled rows with a null id or a label other than 0 and 1 are not used; a repeated labelled id counts once, with its
largest label; repeated texts get equal scores; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.llm.text import others, quoted, whole

TOKEN = re.compile(r"\w+|[^\w\s]+")


@dataclass(frozen=True)
class Settings:
    bits: int = 18
    max_rows: int = 20_000
    rows_per_task: int = 5_000
    epochs: int = 4
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1


def features(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features, ascending, and their counts scaled to length one."""
    tokens = TOKEN.findall(text)
    if not tokens:
        return np.empty(0, np.int64), np.empty(0)
    one = np.fromiter(map(crc32, map(str.encode, tokens)), np.uint32, len(tokens)).astype(np.uint64)
    left, right = one[:-1], one[1:]
    pair = (left * np.uint64(0x9E3779B97F4A7C15)) ^ (right * np.uint64(0xC2B2AE3D27D4EB4F))
    pair[left == right] = np.uint64(1)
    hashed = np.concatenate([one * np.uint64(0xD6E8FEB86659FD93), pair * np.uint64(0xFF51AFD7ED558CCD)])
    places, counts = np.unique((hashed >> np.uint64(64 - bits)).astype(np.int64), return_counts=True)
    return places, counts / np.sqrt(np.square(counts, dtype=float).sum())


def train_rows(rows: list[tuple[np.ndarray, np.ndarray, float]], s: Settings) -> np.ndarray:
    """Weights after `epochs` passes; the last weight is the bias."""
    size = 1 << s.bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(at):
        small = np.abs(z[at]) <= s.l1
        return np.where(small, 0.0, -(z[at] - np.sign(z[at]) * s.l1) / ((s.beta + np.sqrt(n[at])) / s.alpha + s.l2))

    for _ in range(s.epochs):
        for places, values, label in rows:
            at, x = np.append(places, size), np.append(values, 1.0)
            w = weights(at)
            gradient = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
            moved = (np.sqrt(n[at] + gradient**2) - np.sqrt(n[at])) / s.alpha
            z[at] += gradient - moved * w
            n[at] += gradient**2
    return weights(slice(None))


@dataclass(frozen=True)
class QualityModel:
    """Fitted weights: a dense vector of 2^bits entries and the bias."""

    weights: np.ndarray
    bias: float
    settings: Settings

    def transform(self, df: DataFrame, text_col: str = "text", score: str = "score", predicted: str = "predicted") -> DataFrame:
        """Add the score and the predicted label; the text is dropped."""
        sent = df.sparkSession.sparkContext.broadcast((self.weights, self.bias))
        bits = self.settings.bits
        given = df.select(*others(df, [score, predicted, text_col]), whole(text_col).alias("quality__text"))
        schema = T.StructType([
            *given.schema.fields[:-1], T.StructField(score, T.DoubleType()), T.StructField(predicted, T.IntegerType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights, bias = sent.value
            for batch in batches:
                sums = []
                for text in batch.column(batch.num_columns - 1).to_pylist():
                    places, values = features(text, bits)
                    sums.append(bias + weights[places] @ values)
                scores = 1 / (1 + np.exp(-np.clip(np.array(sums, float), -35, 35)))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], names=schema.names)

        return given.mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        settings: Settings = Settings()) -> QualityModel:
    """Train on the rows of `labels` (id and label) and the texts of `docs` with these ids."""
    s = settings
    usable = labels.select(quoted(id_col).alias("id"), quoted(label_col).cast("int").alias("label")).where(
        "id is not null and label in (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    draw = F.xxhash64(F.lit("quality"), "id")
    total = usable.count()
    chosen = usable.select("id", "label", draw.alias("draw"))
    if total > s.max_rows:
        # The smallest draws of all: a threshold first, so that the exact cut only sorts about max_rows rows.
        below = int(-(2**63) + 2**64 * min(1.0, 1.2 * s.max_rows / total + 1e-6)) if total else 0
        chosen = chosen.where(F.col("draw") <= F.lit(min(below, 2**63 - 1))).orderBy("draw").limit(s.max_rows)
    texts = docs.select(quoted(id_col).alias("id"), whole(text_col).alias("text"))
    # At most max_rows ids are broadcast.
    labelled = texts.join(F.broadcast(chosen), "id").select("label", "draw", "text")
    tasks = max(1, -(-min(total, s.max_rows) // s.rows_per_task))

    def train(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["draw", "text"])
        found = [(*features(t, s.bits), float(y)) for t, y in zip(rows["text"], rows["label"])]
        weights = train_rows(found, s)
        places = np.flatnonzero(weights)
        return pd.DataFrame({"place": places, "weight": weights[places]})

    dealt = labelled.withColumn("task", F.pmod("draw", F.lit(tasks)).cast("int"))
    trained = dealt.groupBy("task").applyInPandas(train, "place bigint, weight double")
    averaged = trained.groupBy("place").agg((F.sum("weight") / tasks).alias("weight"))
    weights = np.zeros((1 << s.bits) + 1)
    found = averaged.toPandas()  # at most 2^bits + 1 rows
    weights[found["place"].to_numpy(np.int64)] = found["weight"].to_numpy(float)
    return QualityModel(weights[:-1], float(weights[-1]), s)
