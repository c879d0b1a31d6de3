"""Exact interpolated quantiles that do not need one task to hold all distinct values.

Small inputs use the built-in `percentile`. Larger ones take three column-pruned scans:

1. a sketch brackets every wanted rank,
2. the values below each bracket are counted,
3. the few values inside each bracket are counted exactly and ranked.

Only the values inside a bracket (a fixed small share of the rows) ever meet in one window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabprep.functions.summaries import as_double, summarise, wide_to_rows
from tabprep.session import materialise
from tabprep.sizing import ONE_TASK_BYTES, fits_one_task, hinted, lookup_table

SKETCH_ACCURACY = 100_000
# Up to this many values of a column and group may meet in one task.
ONE_TASK_ROWS = 2_000_000
# Bracket half-width in units of the sketch's guaranteed rank error.
BRACKET_MARGIN = 3


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    one_task_bytes: int = ONE_TASK_BYTES,
    one_task_rows: int = ONE_TASK_ROWS,
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """One row per group and column: `variable`, `q` = array of quantiles (NULL when the column has no value).

    The planned size decides first; when it is large (it multiplies over joins) the counts of the sketch decide.
    """
    cols, by, probs = list(cols), list(by), [float(p) for p in probabilities]
    slim = df.select(*by, *[as_double(c).alias(c) for c in cols])
    if fits_one_task(slim, one_task_bytes):
        return _direct(slim, cols, probs, by)
    return _bracketed(slim, cols, probs, by, one_task_rows, accuracy)


def _direct(slim: DataFrame, cols: list[str], probs: list[float], by: list[str]) -> DataFrame:
    points = F.array(*[F.lit(p) for p in probs])
    wide = slim.groupBy(*by).agg(*[F.percentile(F.col(c), points).alias(f"q__{i}") for i, c in enumerate(cols)])
    return wide_to_rows(wide, by, cols, ["q"])


def _bracketed(
    slim: DataFrame, cols: list[str], probs: list[float], by: list[str], one_task_rows: int, accuracy: int, widening: int = 1
) -> DataFrame:
    margin = BRACKET_MARGIN * widening / accuracy
    edges = [x for p in probs for x in (max(0.0, p - margin), min(1.0, p + margin))]
    sketch = slim.groupBy(*by).agg(
        *[F.percentile_approx(F.col(c), edges, accuracy).alias(f"e__{i}") for i, c in enumerate(cols)],
        *[F.count(F.col(c)).alias(f"n__{i}") for i, c in enumerate(cols)],
        *[F.min(F.col(c)).alias(f"lo__{i}") for i, c in enumerate(cols)],
        *[F.max(F.col(c)).alias(f"hi__{i}") for i, c in enumerate(cols)],
    )

    def edge(i: int, j: int, upper: bool):
        # The outermost brackets reach the true extremes, and so do those of a group so small that the margin
        # would be less than a few rows.
        extreme = F.col(f"hi__{i}" if upper else f"lo__{i}")
        share = edges[2 * j + 1] if upper else edges[2 * j]
        if share in (0.0, 1.0):
            return extreme
        at = F.col(f"e__{i}")[2 * j + (1 if upper else 0)]
        return F.when(F.col(f"n__{i}") <= accuracy, extreme).otherwise(at)

    slots = [(i, j) for i in range(len(cols)) for j in range(len(probs))]
    brackets = sketch.select(
        *by,
        *[F.col(f"n__{i}") for i in range(len(cols))],
        *[edge(i, j, False).alias(f"a__{i}_{j}") for i, j in slots],
        *[edge(i, j, True).alias(f"b__{i}_{j}") for i, j in slots],
    )

    # One row per group: fixed now, so the sketch is not computed again and the join below can go without a shuffle.
    brackets, small = lookup_table(brackets)
    largest = brackets.agg(F.max(F.greatest(*[F.col(f"n__{i}") for i in range(len(cols))], F.lit(0)))).first()[0]
    if small and (largest or 0) <= one_task_rows:
        return _direct(slim, cols, probs, by)
    if by:
        keyed = hinted(brackets.withColumnsRenamed({k: f"of__{k}" for k in by}), small)
        marked = slim.join(keyed, [F.col(k).eqNullSafe(F.col(f"of__{k}")) for k in by]).drop(*[f"of__{k}" for k in by])
    else:
        row = brackets.select(F.struct("*").alias("s")).scalar()
        marked = slim.withColumn("s", row).select(*cols, "s.*")

    below = materialise(marked.groupBy(*by).agg(
        *[F.count_if(F.col(cols[i]) < F.col(f"a__{i}_{j}")).alias(f"below__{i}_{j}") for i, j in slots],
        *[F.count_if(F.col(cols[i]) <= F.col(f"b__{i}_{j}")).alias(f"upto__{i}_{j}") for i, j in slots],
        *[F.max(F.col(f"n__{i}")).alias(f"n__{i}") for i in range(len(cols))],
    ))
    # A sketch may be off by more than it promises; then wider brackets are tried, which end at the whole range.
    missed = F.lit(False)
    for i, j in slots:
        at = F.lit(probs[j]) * (F.col(f"n__{i}") - 1)
        missed = missed | ((F.col(f"n__{i}") > 0) & (
            (F.floor(at) < F.col(f"below__{i}_{j}")) | (F.ceil(at) >= F.col(f"upto__{i}_{j}"))))
    if not below.where(missed).isEmpty():
        return _bracketed(slim, cols, probs, by, one_task_rows, accuracy, widening * 16)
    inside = [
        F.when(
            F.col(cols[i]).between(F.col(f"a__{i}_{j}"), F.col(f"b__{i}_{j}")),
            F.struct(F.lit(i).alias("ci"), F.lit(j).alias("pj"), F.col(cols[i]).alias("v")),
        )
        for i, j in slots
    ]
    counted = (
        marked.select(*by, F.explode(F.filter(F.array(*inside), lambda s: s.isNotNull())).alias("h"))
        .groupBy(*by, F.col("h.ci").alias("ci"), F.col("h.pj").alias("pj"), F.col("h.v").alias("v"))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    ranked = counted.withColumn(
        "upto", F.sum("cnt").over(Window.partitionBy(*by, "ci", "pj").orderBy("v"))
    )

    targets = brackets.select(
        *by,
        F.inline(F.array(*[
            F.struct(F.lit(i).alias("ci"), F.lit(j).alias("pj"),
                     (F.lit(probs[j]) * (F.col(f"n__{i}") - 1)).alias("pos"), F.col(f"n__{i}").alias("n"))
            for i, j in slots
        ])),
    )
    offsets = below.select(
        *by,
        F.inline(F.array(*[
            F.struct(F.lit(i).alias("ci"), F.lit(j).alias("pj"), F.col(f"below__{i}_{j}").alias("below"))
            for i, j in slots
        ])),
    )
    keys = [*by, "ci", "pj"]

    def matched(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        right = right.select(*[F.col(k).alias(f"r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
        on = [F.col(k).eqNullSafe(F.col(f"r_{k}")) for k in keys]
        return left.join(right, on, how).drop(*[f"r_{k}" for k in keys])

    wanted = matched(targets, offsets, "left")
    # 0-based ranks inside the bracket of the two neighbours of the wanted position.
    wanted = wanted.withColumns({
        "r1": F.floor("pos") - F.col("below"), "r2": F.ceil("pos") - F.col("below"), "frac": F.col("pos") - F.floor("pos")
    })
    hit = matched(ranked, wanted, "inner")
    first = F.col("upto") - F.col("cnt")
    picked = hit.groupBy(*keys).agg(
        F.max(F.when((first <= F.col("r1")) & (F.col("r1") < F.col("upto")), F.col("v"))).alias("v1"),
        F.max(F.when((first <= F.col("r2")) & (F.col("r2") < F.col("upto")), F.col("v"))).alias("v2"),
        F.max("frac").alias("frac"),
    )
    value = F.col("v1") * (1 - F.col("frac")) + F.col("v2") * F.col("frac")
    values = matched(targets, picked.select(*keys, value.cast("double").alias("value")), "left")
    names = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("ci") + 1)
    return (
        values.groupBy(*by, "ci")
        .agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("pj", "value"))).alias("qs"))
        .select(*by, names.alias("variable"),
                F.when(F.col("n") > 0, F.transform("qs", lambda s: s["value"])).alias("q"))
    )


def approximate_quantiles(
    df: DataFrame, cols: Sequence[str], probabilities: Sequence[float], by: Sequence[str] = (), accuracy: int = 10_000
) -> DataFrame:
    """The same report from one scan: values whose rank is off by at most 1 / accuracy of the rows. Opt-in."""
    points = [float(p) for p in probabilities]
    return summarise(df, cols, {"q": lambda c: F.percentile_approx(as_double(c), points, accuracy)}, by)


def median_of(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), **options) -> DataFrame:
    """(by..., variable, median)."""
    return exact_quantiles(df, cols, [0.5], by, **options).select(*by, "variable", F.col("q")[0].alias("median"))
