"""k-nearest-neighbour imputation on the coordinates two rows share."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.functions.columns import any_of, nan_to_null, present
from tabprep.operators.gap_neighbours import nearest_for_gaps
from tabprep.operators.neighbours import BOX_DONORS, CHUNK_QUERIES
from tabprep.session import materialise


def key_column(keys: Sequence[str]) -> Column:
    """One sortable key: the column itself, or the parts as text."""
    if len(keys) == 1:
        return F.col(keys[0])
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])


@dataclass(frozen=True)
class KnnModel:
    """I1. Donors are the fit rows; means back up rows that share no coordinate with any donor."""

    cols: list[str]
    k: int
    donors: DataFrame | None
    rows: int = 0
    means: dict[str, float | None] = field(default_factory=dict)
    box_donors: int = BOX_DONORS
    chunk_queries: int = CHUNK_QUERIES

    def transform(self, df: DataFrame) -> DataFrame:
        if not self.cols:
            return df
        kinds = {c: nan_to_null(F.col(c).cast("double")) for c in self.cols}
        df = df.withColumns(kinds)
        # Rows that know some of the columns, but not all, look for neighbours. Rows that know none get the means.
        gaps = any_of([F.col(c).isNull() for c in self.cols]) & any_of([F.col(c).isNotNull() for c in self.cols])
        with_means = {c: F.coalesce(F.col(c), F.lit(self.means[c]).cast("double")) for c in self.cols}
        found = self._imputed(df.where(gaps))
        # All other rows pass by without a shuffle; only rows with a gap meet their results.
        names = {f"id__{j}": c for j, c in enumerate(self.cols)}
        on = [F.col(i).eqNullSafe(F.col(c)) for i, c in names.items()]
        joined = df.where(gaps).join(found, on, "left")
        values = {
            c: F.coalesce(F.col(c), F.col(f"imp__{j}"), F.lit(self.means[c]).cast("double"))
            for j, c in enumerate(self.cols)
        }
        filled = joined.select(*[values[c].alias(c) if c in values else F.col(f"`{c}`") for c in df.columns])
        return df.where(~gaps).withColumns(with_means).unionByName(filled)

    def _imputed(self, rows: DataFrame) -> DataFrame:
        """(id__j..., imp__j...): one row per distinct row with gaps. Rows that are equal are searched once."""
        bits = range(len(self.cols))
        ids, values = [f"id__{j}" for j in bits], [f"v__{j}" for j in bits]
        distinct_rows = rows.select(*[F.col(c).alias(f"id__{j}") for j, c in enumerate(self.cols)]).distinct()
        # Writing the table fixes the numbers.
        queries = materialise(distinct_rows.withColumn("query", F.monotonically_increasing_id()))
        donors = self.donors.where(any_of([F.col(v).isNotNull() for v in values]))
        donors = distinct_donors(donors.withColumn("space", F.lit(0)), values, self.k).drop("space")
        asked = queries.withColumnsRenamed(dict(zip(ids, values)))
        found = nearest_for_gaps(donors, asked, values, "key", "query", self.rows, queries.count(), self.k,
                                 self.box_donors, self.chunk_queries)
        d, v = F.col("distance"), F.col("value")
        weight = F.try_divide(F.lit(1.0), d)
        weighted = F.try_divide(F.sum(v * weight), F.sum(weight))
        exact = F.avg(F.when(d == 0, v))
        per_cell = found.groupBy("query", "cell").agg(F.when(F.min(d) == 0, exact).otherwise(weighted).alias("imputed"))
        wide = per_cell.groupBy(F.col("query").alias("found__query")).agg(
            *[F.max(F.when(F.col("cell") == j, F.col("imputed"))).alias(f"imp__{j}") for j in bits])
        return queries.join(wide, F.col("query") == F.col("found__query")).select(*ids, *[f"imp__{j}" for j in bits])


def distinct_donors(donors: DataFrame, axes: Sequence[str | Column], k: int) -> DataFrame:
    """Of donors at the same point only the k with the smallest keys can ever be chosen.

    The window limit is applied before the shuffle too, so a point shared by a third of the rows stays small.
    """
    same_point = Window.partitionBy("space", *axes).orderBy("key")
    return donors.withColumn("rank", F.row_number().over(same_point)).where(F.col("rank") <= k).drop("rank")


def fit_knn(
    df: DataFrame,
    cols: Sequence[str],
    keys: Sequence[str],
    k: int = 5,
    box_donors: int = BOX_DONORS,
    chunk_queries: int = CHUNK_QUERIES,
) -> KnnModel:
    """One report query: rows and means. `keys` identify rows and break distance ties."""
    cols = present(df, cols)
    if not cols:
        return KnnModel([], k, None)
    values = [nan_to_null(F.col(c).cast("double")).alias(f"v__{j}") for j, c in enumerate(cols)]
    donors = df.select(key_column(keys).alias("key"), *values)
    names = [f"v__{j}" for j in range(len(cols))]
    figures = donors.agg(F.count(F.lit(1)).alias("rows"), *[F.avg(v).alias(v) for v in names]).first()
    means = {c: figures[v] for c, v in zip(cols, names)}
    return KnnModel(cols, k, donors, figures["rows"], means, box_donors, chunk_queries)
