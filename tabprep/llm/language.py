"""Operator 9, language identification by error-correcting output codes.

Every language gets a codeword of bits: all two-way splits of the languages for up to seven, a fixed random code with a
large distance beyond. One binary classifier per bit tells the languages with a 1 from those with a 0 by the byte
two- and three-grams of the lower-cased text: a linear log-odds classifier whose sides weigh their languages equally.
Decoding adds the logistic losses of all bits against each codeword, weighted by how well the bit separates its sides;
the nearest codeword wins, and a text whose two nearest codewords are close is flagged as ambiguous.

Training counts n-grams over all rows that have a language: tasks add up their own counts, which are then summed by
language and n-gram, so a hot language shuffles no more than a rare one. The sides of every bit are summed in Spark too; the
driver gets GRAMS numbers per bit, which are the model. Prediction is one scan of whole texts.

Defined cases: a null text, or one without a letter, is `und` with score 0 and flagged; so is every text if there is
nothing to learn from; rows without a language, and languages whose texts have no letter, are not learned; repeated texts
get equal results; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.llm.text import others, quoted, whole
from tabprep.session import materialise
from tabprep.sizing import hinted, local_table, lookup_table

TWO, THREE = 13, 14
GRAMS = (1 << TWO) + (1 << THREE)
COMPARED = 2_000  # languages whose codewords are compared with each other
UNIT = 1 << 60
HELD = 32  # languages whose counts a task holds before it hands them on
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
# ASCII other than letters counts as a space.
BLANK = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def gram_places(text: str) -> np.ndarray:
    """The place of every two- and three-gram of the text's UTF-8 bytes, words delimited by spaces."""
    data = b" ".join(text.lower().encode().translate(BLANK).split())
    if not data:
        return np.empty(0, np.int64)
    b = np.frombuffer(b" " + data + b" ", np.uint8).astype(np.uint32)
    two = (b[:-1] << np.uint32(8)) | b[1:]
    three = (two[:-1] << np.uint32(8)) | b[2:]
    mix = np.uint32(0x9E3779B1)
    return np.concatenate([
        (two * mix) >> np.uint32(32 - TWO), ((three * mix) >> np.uint32(32 - THREE)) + np.uint32(1 << TWO)]).astype(np.int64)


def code_matrix(n: int) -> np.ndarray:
    """A row of +1 and -1 for each language. No bit is the same for all languages, and no two bits split them alike."""
    if n <= 7:
        sides = [s for size in range(1, n) for s in combinations(range(n), size) if 0 in s]
        return np.array([[1 if k in s else -1 for s in sides] for k in range(n)]).reshape(n, len(sides))
    bits, best, code = int(np.ceil(10 * np.log2(n))), -1, None
    # Codewords drawn for very many languages are far apart anyway, and comparing all of them would take long.
    if n > COMPARED:
        return np.random.default_rng(0).choice(np.array([-1, 1], np.int8), size=(n, bits))
    for seed in range(50):
        trial = np.random.default_rng(seed).choice([-1, 1], size=(n, bits))
        distance = ((bits - trial @ trial.T) // 2 + bits * np.eye(n, dtype=int)).min()
        if distance > best and (np.abs(trial.sum(axis=0)) < n).all():
            best, code = distance, trial
    return code


def gram_counts(df: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """(lang, place, n) summed over all rows with a language."""
    given = df.select(quoted(lang_col).cast("string").alias("lang"), whole(text_col).alias("text")).where("lang is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def hand_on():
            for lang, counts in held.items():
                places = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(places), pa.string()), pa.array(places.astype(np.int32)), pa.array(counts[places])],
                    names=["lang", "place", "n"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if lang not in held:
                    if len(held) == HELD:
                        yield from hand_on()
                    held[lang] = np.zeros(GRAMS, np.int64)
                held[lang] += np.bincount(gram_places(text), minlength=GRAMS)
        yield from hand_on()

    partial = given.mapInArrow(run, "lang string, place int, n bigint")
    return partial.groupBy("lang", "place").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class LanguageModel:
    """Languages, their codewords, the classifiers' weights (n-gram by bit) and the weight of each bit's loss."""

    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray
    bit_weights: np.ndarray
    close: float = 0.75

    def losses(self, text: str) -> np.ndarray:
        """The weighted loss of every codeword."""
        places = gram_places(text)
        if not len(places):
            return np.zeros(len(self.languages))
        margins = np.bincount(places, minlength=GRAMS) @ self.weights / np.sqrt(len(places))
        return np.logaddexp(0, -self.code * margins) @ self.bit_weights

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not self.languages or not text or not LETTER.search(text):
            return UNKNOWN, 0.0, True
        loss = self.losses(text)
        likely = np.exp(loss.min() - loss)
        best, score = int(loss.argmin()), float(1 / likely.sum())
        return self.languages[best], score, score < self.close

    def transform(self, df: DataFrame, text_col: str = "text", lang: str = "lang_pred", score: str = "score",
                  ambiguous: str = "ambiguous") -> DataFrame:
        """Add the language, its score (0 to 1) and the flag of ambiguity; the text is dropped."""
        sent = df.sparkSession.sparkContext.broadcast(self)
        out = (lang, score, ambiguous)
        given = df.select(*others(df, [*out, text_col]), quoted(text_col).cast("string").alias("language__text"))
        kinds = (T.StringType(), T.DoubleType(), T.BooleanType())
        schema = T.StructType([*given.schema.fields[:-1], *[T.StructField(n, k) for n, k in zip(out, kinds)]])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = sent.value
            for batch in batches:
                found = [model.predict(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
                columns = zip(*found) if found else ((), (), ())
                arrays = [pa.array(list(c), k) for c, k in zip(columns, (pa.string(), pa.float64(), pa.bool_()))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], names=schema.names)

        return given.mapInArrow(run, schema)


def bit_sums(counts: DataFrame, code: np.ndarray, languages: tuple[str, ...], totals: np.ndarray, smoothing: float) -> np.ndarray:
    """(side, place, bit): the sum over a bit's languages with a 1 (side 0) or a 0 (side 1) of their n-grams' shares.

    Spark adds up what was counted, in whole units of 1 / UNIT so that the order of adding changes nothing; the driver gets one row
    per place, whatever the number of languages, and adds what smoothing gives to n-grams that a language lacks.
    """
    spark, bits = counts.sparkSession, code.shape[1]
    room = totals + smoothing * GRAMS
    known = local_table(spark, [(name, float(r), "".join("1" if b > 0 else "0" for b in row)) for name, r, row in zip(languages, room, code)],
                        "name string, room double, word string")
    known, small = lookup_table(known)
    met = counts.join(hinted(known, small), F.col("lang") == F.col("name"))
    share = F.round(F.col("n") * F.lit(float(UNIT)) / F.col("room")).cast("decimal(38,0)")
    sides = [F.sum(F.when(F.substring("word", k + 1, 1) == side, F.col("share"))).alias(f"s{side}_{k}") for side in "10" for k in range(bits)]
    summed = met.select("place", "word", share.alias("share")).groupBy("place").agg(*sides).toPandas()  # GRAMS rows at most
    base = np.stack([(smoothing / room) @ (code > 0), (smoothing / room) @ (code < 0)])
    out = np.repeat(base[:, None, :], GRAMS, axis=1)
    if len(summed):
        place = summed["place"].to_numpy()
        for n, side in enumerate("10"):
            found = summed[[f"s{side}_{k}" for k in range(bits)]].astype(float).fillna(0.0).to_numpy()
            out[n][place] += found / UNIT
    return out


def fit(df: DataFrame, lang_col: str = "lang", text_col: str = "text", smoothing: float = 0.5) -> LanguageModel:
    """Learn from all rows of `df` that have a language.

    The driver gets the languages with their totals, one row each, and for each n-gram the sums of every bit, about ten times the
    binary logarithm of the number of languages; the counts themselves stay in Spark.
    """
    counts = materialise(gram_counts(df, lang_col, text_col))
    found = counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy("lang").toPandas()
    if not len(found):
        return LanguageModel((), np.empty((0, 0)), np.empty((GRAMS, 0)), np.empty(0))
    languages = tuple(sorted(found["lang"]))
    totals = found.set_index("lang").loc[list(languages), "n"].to_numpy(dtype=float)
    code = code_matrix(len(languages))
    if not code.shape[1]:
        return LanguageModel(languages, code, np.zeros((GRAMS, 0)), np.ones(0))
    sums = bit_sums(counts, code, languages, totals, smoothing)
    one, zero = sums[0] / np.maximum(1, (code > 0).sum(axis=0)), sums[1] / np.maximum(1, (code < 0).sum(axis=0))
    weights = np.log(one) - np.log(zero)
    apart = ((one - zero) * weights).sum(axis=0)  # how far apart the bit's sides are, in nats per n-gram
    bit_weights = apart / apart.mean() if apart.mean() > 0 else np.ones(code.shape[1])
    return LanguageModel(languages, code, weights, bit_weights)
