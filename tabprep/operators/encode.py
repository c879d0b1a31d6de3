"""Category encoders. A fitted encoder is a level table; applying it never needs a second look at the fit data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.functions.columns import present
from tabprep.functions.summaries import as_double, long_values, plain, value_field, value_frequencies
from tabprep.operators.joins import lookup
from tabprep.operators.ordering import with_row_index
from tabprep.operators.split import row_hash
from tabprep.session import materialise
from tabprep.sizing import SMALL_ROWS, collect_bounded, hinted, lookup_table

# A one-hot table gets one column per level up to this many levels, and one map column beyond.
WIDE_LEVELS = 1_000
# Ordered levels up to this many travel inside the expression; beyond it as a table.
INLINE_LEVELS = 1_000


def level_text(value, float_text: bool = False) -> str:
    """Text of a level in a column name; a whole number prints without a fraction unless `float_text`."""
    if isinstance(value, float) and value.is_integer() and not float_text:
        return str(int(value))
    return str(value)


def _distinct_levels(df: DataFrame, cols: Sequence[str], limit: int, with_nulls: bool = False) -> dict[str, list] | None:
    """Sorted levels per column, NULL last when asked for; None when some column has more than `limit`."""
    found = value_frequencies(df, cols, with_nulls).select("variable", "value")
    rows = collect_bounded(found, (limit + 1) * len(cols))
    out: dict[str, list] = {c: [] for c in cols}
    for r in rows or []:
        out[r["variable"]].append(plain(r["value"]))
    if rows is None or any(len(v) > limit for v in out.values()):
        return None
    return {c: sorted(v, key=lambda x: (x is None, 0 if x is None else x)) for c, v in out.items()}


@dataclass(frozen=True)
class OneHot:
    """One double column per level, the first level dropped by default, originals removed.

    A column with more than WIDE_LEVELS levels becomes one column `<name>_onehot` instead, a map from the place of the
    row's level among the kept ones to 1.0; it is empty for the dropped level. Levels are in the same order, NULL last.
    """

    levels: dict[str, list]
    drop_first: bool = True
    unseen: str = "error"
    float_text: bool = False
    tables: dict[str, tuple[DataFrame, bool]] = field(default_factory=dict)
    null_places: dict[str, int | None] = field(default_factory=dict)

    def column_names(self) -> list[str]:
        return [f"{c}_{level_text(v, self.float_text)}" for c, v in self._kept()]

    def _kept(self) -> list[tuple[str, object]]:
        return [(c, v) for c, vs in self.levels.items() for v in (vs[1:] if self.drop_first else vs)]

    def _checked(self, name: str) -> Column:
        col = F.col(name)
        if self.unseen != "error":
            return col
        known = [v for v in self.levels[name] if v is not None]
        ok = col.isin(known) if known else F.lit(False)
        if None in self.levels[name]:
            ok = col.isNull() | F.coalesce(ok, F.lit(False))
        return F.when(F.coalesce(ok, F.lit(False)), col).otherwise(
            F.raise_error(F.concat(F.lit(f"unseen level in {name}: "), F.coalesce(col.cast("string"), F.lit("NULL"))))
        )

    def transform(self, df: DataFrame) -> DataFrame:
        names = present(df, self.levels)
        made = [
            F.when(self._checked(c).eqNullSafe(F.lit(v)), F.lit(1.0)).otherwise(F.lit(0.0))
            .alias(f"{c}_{level_text(v, self.float_text)}")
            for c, v in self._kept() if c in names
        ]
        df = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in names], *made)
        for c in present(df, self.tables):
            df = self._mapped(df, c)
        return df

    def _mapped(self, df: DataFrame, name: str) -> DataFrame:
        table, small = self.tables[name]
        met = lookup(df, table, name, "idx", "onehot__place", None, small)
        place = F.when(F.col(name).isNull(), F.lit(self.null_places[name]).cast("bigint")).otherwise(F.col("onehot__place"))
        if self.unseen == "error":
            unseen = F.raise_error(F.concat(F.lit(f"unseen level in {name}: "), F.coalesce(F.col(name).cast("string"), F.lit("NULL"))))
            place = F.coalesce(place, unseen.cast("bigint"))
        kept = place - 1 if self.drop_first else place
        empty = F.create_map().cast("map<bigint,double>")
        cell = F.when(kept >= 0, F.create_map(kept, F.lit(1.0))).otherwise(empty)
        return met.select(*[F.col(f"`{c}`") for c in df.columns if c != name], cell.alias(f"{name}_onehot"))


def fit_one_hot(
    df: DataFrame, cols: Sequence[str], drop_first: bool = True, unseen: str = "error", float_text: bool = False
) -> OneHot:
    """Sorted levels per column; NULL is a level of its own, after the others."""
    cols = present(df, cols)
    if not cols:
        return OneHot({}, drop_first, unseen, float_text)
    levels = _distinct_levels(df, cols, WIDE_LEVELS, with_nulls=True)
    if levels is not None:
        return OneHot(levels, drop_first, unseen, float_text)
    levels, tables, nulls = {}, {}, {}
    for c in cols:
        few = _distinct_levels(df, [c], WIDE_LEVELS, with_nulls=True)
        if few is not None:
            levels |= few
            continue
        found = materialise(df.select(F.col(c).alias("level")).distinct())
        indexed = with_row_index(found.where(F.col("level").isNotNull()), ["level"], "idx")
        tables[c] = lookup_table(indexed)
        nulls[c] = None if found.where(F.col("level").isNull()).isEmpty() else indexed.count()
    return OneHot(levels, drop_first, unseen, float_text, tables, nulls)


def fit_one_hot_sparse(df: DataFrame, cols: Sequence[str], drop_first: bool = True) -> PipelineModel:
    """E1 for many levels: one sparse vector column `<col>_vec` per column.

    Levels are indexed in descending order, so the library's 'drop the last' drops the first level.
    """
    indexer = StringIndexer(
        inputCols=list(cols), outputCols=[f"{c}_idx" for c in cols], stringOrderType="alphabetDesc", handleInvalid="error"
    )
    encoder = OneHotEncoder(
        inputCols=[f"{c}_idx" for c in cols], outputCols=[f"{c}_vec" for c in cols], dropLast=drop_first
    )
    return Pipeline(stages=[indexer, encoder]).fit(df)


@dataclass(frozen=True)
class Ordinal:
    """Position of the level as a double, -1 for unknown or missing."""

    inline: dict[str, list]
    tables: dict[str, tuple[DataFrame, bool]] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        made = {}
        for c in present(df, self.inline):
            kind = df.schema[c].dataType
            if not self.inline[c]:
                made[c] = F.lit(-1.0)
                continue
            levels = F.array(*[F.lit(v).cast(kind) for v in self.inline[c]])
            made[c] = F.coalesce((F.array_position(levels, F.col(c)) - 1).cast("double"), F.lit(-1.0))
        df = df.withColumns(made)
        for c in present(df, self.tables):
            table, small = self.tables[c]
            df = lookup(df, table, c, "idx", c, -1.0, small)
        return df


def fit_ordinal(
    df: DataFrame, cols: Sequence[str], order: Mapping[str, Sequence] | None = None, inline_levels: int = INLINE_LEVELS
) -> Ordinal:
    """The given order per column, else the sorted levels. Many levels are numbered as a table, in slices."""
    order = order or {}
    cols = present(df, cols)
    inline = {c: list(order[c]) for c in cols if c in order}
    tables = {}
    for c in [c for c in cols if c not in order]:
        found = _distinct_levels(df, [c], inline_levels)
        if found is not None:
            inline[c] = found[c]
            continue
        levels = df.select(F.col(c).alias("level")).where(F.col("level").isNotNull()).distinct()
        indexed = with_row_index(levels, ["level"], "idx").withColumn("idx", F.col("idx").cast("double"))
        tables[c] = lookup_table(indexed)
    return Ordinal(inline, tables)


@dataclass(frozen=True)
class TargetMean:
    """Smoothed mean of the target per level; unknown or missing levels get the overall mean."""

    overall: float | None
    tables: dict[str, tuple[DataFrame, bool]]

    def transform(self, df: DataFrame) -> DataFrame:
        for c in present(df, self.tables):
            table, small = self.tables[c]
            df = lookup(df, table, c, "encoded", c, F.lit(self.overall).cast("double"), small)
        return df


def group_means(df: DataFrame, col: str, target: str) -> DataFrame:
    """Mean and count of the known targets per known level."""
    t = as_double(target)
    return (
        df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("level"))
        .agg(F.avg(t).alias("mean"), F.count(t).alias("n"))
    )


def smoothed(mean: Column, n: Column, overall: Column, smoothing: float) -> Column:
    weight = F.lit(float(smoothing))
    return F.try_divide(n * mean + weight * overall, n + weight)


def fit_target(
    df: DataFrame, cols: Sequence[str], target: str, smoothing: float = 10.0, table_rows: int = SMALL_ROWS
) -> TargetMean:
    """Level tables of `(n * mean + m * overall) / (n + m)`. A missing target column leaves the data unchanged."""
    if target not in df.columns:
        return TargetMean(None, {})
    cols = present(df, cols)
    if not cols:
        return TargetMean(None, {})
    # One scan and one shuffle for all columns. The missing level is counted too, so that the levels of any one column
    # add up to the overall mean.
    long = long_values(df, cols, as_double(target).alias("t"))
    sums = materialise(
        long.groupBy("variable", "value").agg(F.sum("t").alias("total"), F.count("t").alias("n")).where("n > 0"))
    overall = sums.where(F.col("variable") == cols[0]).agg(F.try_divide(F.sum("total"), F.sum("n"))).first()[0]
    mean = F.try_divide(F.col("total"), F.col("n"))
    encoded = smoothed(mean, F.col("n"), F.lit(overall).cast("double"), smoothing).alias("encoded")
    tables = {}
    for c in cols:
        kind = df.schema[c].dataType
        level = F.col("value")[value_field(kind)].cast(kind)
        levels = sums.where((F.col("variable") == c) & level.isNotNull()).select(level.alias("level"), encoded)
        tables[c] = lookup_table(levels, table_rows)
    return TargetMean(overall, tables)


def fold_of(key: str, folds: int) -> Column:
    """Fold number from the portable row hash."""
    return (F.conv(F.substring(row_hash(key, 0), 1, 8), 16, 10).cast("bigint") % F.lit(folds)).cast("int")


def target_out_of_fold(
    df: DataFrame, col: str, target: str, key: str, folds: int = 5, smoothing: float = 10.0, out: str | None = None,
    table_rows: int = SMALL_ROWS,
) -> DataFrame:
    """E3 without leakage: each row is encoded from the rows of the other folds only.

    A level's sums per fold come from one partially aggregated exchange; the other folds are its totals minus its own.
    """
    t = as_double(target)
    marked = df.withColumn("oof__fold", fold_of(key, folds))
    rows = marked.groupBy("oof__fold").agg(F.sum(t).alias("s"), F.count(t).alias("n")).collect()  # one row per fold
    total_s, total_n = sum(r["s"] or 0.0 for r in rows), sum(r["n"] for r in rows)
    base = F.lit(None).cast("double")
    for r in rows:
        if total_n > r["n"]:
            mean = (total_s - (r["s"] or 0.0)) / (total_n - r["n"])
            base = F.when(F.col("oof__fold") == r["oof__fold"], F.lit(mean)).otherwise(base)
    parts = range(folds)
    in_fold = [F.when(F.col("oof__fold") == f, t) for f in parts]
    level_sums = marked.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("oof__level")).agg(
        *[F.coalesce(F.sum(in_fold[f]), F.lit(0.0)).alias(f"s__{f}") for f in parts],
        *[F.count(in_fold[f]).alias(f"n__{f}") for f in parts],
    )
    level_sums, small = lookup_table(level_sums, table_rows)
    joined = marked.join(hinted(level_sums, small), F.col(col) == F.col("oof__level"), "left")

    def others(name: str) -> Column:
        own = F.array(*[F.col(f"{name}__{f}") for f in parts])[F.col("oof__fold")]
        return sum((F.col(f"{name}__{f}") for f in parts), F.lit(0)) - own

    value = F.try_divide(others("s") + smoothing * base, others("n") + F.lit(float(smoothing)))
    out = out or col
    encoded = F.coalesce(value, base)
    names = [encoded.alias(out) if c == out else F.col(f"`{c}`") for c in df.columns]
    return joined.select(*names, *([] if out in df.columns else [encoded.alias(out)]))


@dataclass(frozen=True)
class EncodingPlan:
    """Which columns get which encoding; one-hot first, then ordinal, then target."""

    one_hot: tuple[str, ...] = ()
    ordinal: tuple[str, ...] = ()
    ordinal_order: Mapping[str, Sequence] = field(default_factory=dict)
    target_columns: tuple[str, ...] = ()
    target: str | None = None
    smoothing: float = 10.0

    @classmethod
    def from_config(cls, config: Mapping | None) -> EncodingPlan:
        """From a mapping with the keys `onehot_cols`, `ordinal_cols` and `target_cols`."""
        config = config or {}
        target = config.get("target_cols") or {}
        both = "columns" in target and "target" in target
        return cls(
            one_hot=tuple(config.get("onehot_cols") or ()),
            ordinal=tuple(config.get("ordinal_cols") or ()),
            target_columns=tuple(target["columns"]) if both else (),
            target=target["target"] if both else None,
            smoothing=target.get("smoothing", 10.0),
        )

    def columns(self) -> list[str]:
        return [*self.one_hot, *self.ordinal, *self.target_columns, *([self.target] if self.target else [])]

    def fit(self, df: DataFrame) -> EncodingModel:
        """Encoders are fitted on the incoming values; no column may be encoded twice."""
        used = [*self.one_hot, *self.ordinal, *self.target_columns]
        if len(set(used)) < len(used):
            raise ValueError("a column is listed for two encodings")
        steps: dict[str, OneHot | Ordinal | TargetMean] = {}
        if self.one_hot:
            steps["onehot"] = fit_one_hot(df, self.one_hot)
        if self.ordinal:
            steps["ordinal"] = fit_ordinal(df, self.ordinal, self.ordinal_order)
        if self.target_columns and self.target:
            steps["target"] = fit_target(df, self.target_columns, self.target, self.smoothing)
        return EncodingModel(steps)


@dataclass(frozen=True)
class EncodingModel:
    steps: dict[str, OneHot | Ordinal | TargetMean]

    def transform(self, df: DataFrame) -> DataFrame:
        for step in self.steps.values():
            df = step.transform(df)
        return df


def boolean_to_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """text form of columns that must be treated as categories."""
    return df.withColumns({
        c: F.col(c).cast("string") for c in present(df, cols) if not isinstance(df.schema[c].dataType, T.StringType)
    })
