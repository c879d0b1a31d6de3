"""Mergeable summaries: quantile sketches and id sketches that are stored per cycle and merged without a rescan.

A sketch is a small binary column beside its group. Sketches of files, cycles or months are kept as a table; a question about any
union of groups reads the sketches only. Their errors are bounded and stated here, and `bracket` hands a sketch's answer to the
exact method, which then reads only what lies between two values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.functions.columns import nan_to_null

# Normalized rank error of a quantile sketch with parameter 200, single-sided, at 99 percent confidence.
QUANTILE_K = 200
RANK_ERROR = 0.0133
ID_BITS = 12  # an id sketch keeps 2**12 hashes
# Relative deviation of a count of distinct ids, one standard deviation.
ID_ERROR = 1 / 2 ** (ID_BITS / 2)


def quantile_sketches(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), k: int = QUANTILE_K) -> DataFrame:
    """A10: (by, variable, n, least, most, sketch) of every numeric column and group, all columns in one pass."""
    figures = []
    for n, c in enumerate(cols):
        value = nan_to_null(F.col(f"`{c}`").cast("double"))
        figures += [F.count(value).alias(f"n__{n}"), F.min(value).alias(f"least__{n}"), F.max(value).alias(f"most__{n}"),
                    F.kll_sketch_agg_double(value, F.lit(k)).alias(f"sketch__{n}")]
    entries = [F.struct(F.lit(c).alias("variable"), *[F.col(f"{f}__{n}").alias(f) for f in ("n", "least", "most", "sketch")])
               for n, c in enumerate(cols)]
    return df.groupBy(*by).agg(*figures).select(*by, F.inline(F.array(*entries)))


def merge_quantiles(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sketches of coarser groups; only sketches are read."""
    return sketches.groupBy(*by, "variable").agg(
        F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """Add `q`, the value at each probability (the ends are exact), NULL for a group without values."""
    def at(p: float) -> Column:
        if p <= 0:
            return F.col("least")
        return F.col("most") if p >= 1 else F.kll_sketch_get_quantile_double("sketch", F.lit(float(p)))

    return sketches.withColumn("q", F.when(F.col("n") > 0, F.array(*[at(p) for p in probabilities])))


def bracket(sketches: DataFrame, probability: float, error: float = RANK_ERROR) -> DataFrame:
    """(…, low, high): values between which the quantile lies unless the sketch is off by more than `error`."""
    both = sketch_quantiles(sketches, [max(0.0, probability - error), min(1.0, probability + error)])
    return both.select(*[c for c in sketches.columns if c != "sketch"], F.col("q")[0].alias("low"), F.col("q")[1].alias("high"))


def bracketed_quantile(df: DataFrame, sketches: DataFrame, col: str, probability: float, error: float = RANK_ERROR) -> DataFrame:
    """A10: the exact quantile (interpolated between neighbours) of a whole column, with a stored sketch as guide.

    One scan counts what lies below the bracket and ranks only what lies in it. `sketches` has one row for `col`. Where the
    bracket misses, its ends widen to the least and the greatest value: the answer is exact for any sketch.
    """
    value = nan_to_null(F.col(f"`{col}`").cast("double"))
    values = df.select(value.alias("v")).where("v IS NOT NULL")
    ends = bracket(sketches.where(F.col("variable") == col), probability, error).select("n", "least", "most", "low", "high").first()
    schema = "quantile double"
    if ends is None or not ends["n"]:
        return df.sparkSession.createDataFrame([(None,)], schema)
    rank = (ends["n"] - 1) * probability
    for low, high in ((ends["low"], ends["high"]), (ends["least"], ends["most"])):
        # Equal values are counted, so what is ranked is the distinct values of the bracket.
        below = values.agg(F.count_if(F.col("v") < low)).first()[0]
        inside = values.where(F.col("v").between(low, high)).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        upto = inside.select("v", "n", F.sum("n").over(_ordered()).alias("upto")).withColumn("first", F.lit(below) + F.col("upto") - F.col("n"))
        lower, upper = int(rank), min(int(rank) + 1, ends["n"] - 1)
        holds = lambda r: (F.col("first") <= r) & (F.lit(below) + F.col("upto") > r)
        found = upto.agg(F.max(F.when(holds(lower), F.col("v"))).alias("a"), F.max(F.when(holds(upper), F.col("v"))).alias("b")).first()
        if found["a"] is not None and found["b"] is not None:
            quantile = found["a"] + (found["b"] - found["a"]) * (rank - lower)
            return df.sparkSession.createDataFrame([(float(quantile),)], schema)
    raise ValueError("the sketch does not belong to this column")


def _ordered():
    from pyspark.sql import Window

    return Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)


def id_sketches(df: DataFrame, id_col: str, by: Sequence[str], bits: int = ID_BITS) -> DataFrame:
    """(by, ids, sketch): a sketch of the distinct ids of every group, and how many it stands for."""
    sketch = F.theta_sketch_agg(F.col(id_col), F.lit(bits))
    return df.where(F.col(id_col).isNotNull()).groupBy(*by).agg(sketch.alias("sketch")).select(
        *by, F.theta_sketch_estimate("sketch").alias("ids"), "sketch")


def merge_ids(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sketches of unions of groups."""
    merged = sketches.groupBy(*by).agg(F.theta_union_agg("sketch", F.lit(ID_BITS)).alias("sketch"))
    return merged.select(*by, F.theta_sketch_estimate("sketch").alias("ids"), "sketch")


def overlaps(sketches: DataFrame, within: Sequence[str], member: str) -> DataFrame:
    """(within, left, right, both, either): how many ids two members share, for every pair of members of a group.

    The pairs are pairs of sketches, as few as there are modules in a cycle. `both` is off by about ID_ERROR times `either`.
    """
    left = sketches.select(*within, F.col(member).alias("left"), F.col("sketch").alias("a"))
    right = sketches.select(*[F.col(c).alias(f"r__{c}") for c in within], F.col(member).alias("right"), F.col("sketch").alias("b"))
    same = F.lit(True)
    for c in within:
        same = same & F.col(c).eqNullSafe(F.col(f"r__{c}"))
    met = left.join(right, same & (F.col("left") < F.col("right"))) if within else left.join(right, F.col("left") < F.col("right"))
    return met.select(
        *within, "left", "right", F.theta_sketch_estimate(F.theta_intersection("a", "b")).alias("both"),
        F.theta_sketch_estimate(F.theta_union("a", "b")).alias("either"))
