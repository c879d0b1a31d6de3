"""Minority oversampling by interpolation between neighbours (SMOTE, Chawla et al., JAIR 2002)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.functions.columns import any_of, nan_to_null
from tabprep.operators.knn import distinct_donors
from tabprep.operators.neighbours import BOX_DONORS, CHUNK_QUERIES, nearest
from tabprep.operators.split import hash_cuts, row_hash, uniform
from tabprep.session import materialise
from tabprep.sizing import lookup_table


def neighbour_lists(
    rows: DataFrame, features: Sequence[str], key: str, count: int, k: int,
    box_donors: int = BOX_DONORS, chunk_queries: int = CHUNK_QUERIES,
) -> DataFrame:
    """(key, features..., neighbours): the k nearest other rows of each row, nearest first, ties by key.

    Rows at the same point share one search; k + 1 neighbours are found so that a row can leave itself out.
    """
    bits = range(len(features))
    values, ids = [f"v__{j}" for j in bits], [f"id__{j}" for j in bits]

    def placed(names: list[str]) -> DataFrame:
        points = [F.col(c).cast("double").alias(n) for c, n in zip(features, names)]
        return rows.select(F.lit("all").alias("space"), *points, F.col(key).alias("key"))

    donors = distinct_donors(placed(values), values, k + 1)
    queries = placed(ids).drop("key").distinct()
    found = nearest(donors, queries, values, ids, {"all": list(bits)}, {"all": count}, {"all": count}, k + 1, "key",
                    box_donors, chunk_queries)
    lists = found.groupBy(*ids).agg(
        F.sort_array(F.collect_list(F.struct("square", "key", F.array(*values).alias("at")))).alias("near")
    )
    on = [F.col(c).cast("double") == F.col(i) for c, i in zip(features, ids)]
    joined = rows.select(F.col(key), *features).join(lists, on)
    others = F.filter("near", lambda n: n["key"] != F.col(key))
    return joined.select(key, *features, F.slice(others, 1, k).alias("neighbours"))


def oversample_minority(
    df: DataFrame,
    target: str,
    features: Sequence[str],
    key: str,
    ratio: float = 1.0,
    k: int = 5,
    seed: int = 42,
    box_donors: int = BOX_DONORS,
    chunk_queries: int = CHUNK_QUERIES,
) -> DataFrame:
    """All rows plus synthetic minority rows until minority = `ratio` * majority.

    Every complete minority row gets the same number of draws, give or take one. Draw r of a row picks a neighbour and
    a position on the way to it from md5(seed:key:r), so results do not depend on partitioning. Minority rows with a
    missing feature count towards the class but are neither seeds nor neighbours; fewer than two complete ones are an
    error, as nothing can be made from them. Adds `synthetic` and `draw`; other columns of a synthetic row are NULL, its
    key is its seed row's.
    """
    numbers = [nan_to_null(F.col(c).cast("double")) for c in features]
    complete = ~any_of([v.isNull() for v in numbers])
    sizes = df.where(F.col(target).isNotNull()).groupBy(target).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(complete).alias("complete")).orderBy("n", target)
    rows = sizes.limit(3).collect()
    if len(rows) != 2:
        raise ValueError("two classes are needed")
    minority, count = rows[0][target], rows[0]["complete"]
    missing = max(0, int(round(rows[1]["n"] * ratio)) - rows[0]["n"])
    original = df.withColumns({"synthetic": F.lit(False), "draw": F.lit(None).cast("bigint")})
    if not missing:
        return original
    if count < 2:
        raise ValueError(f"{missing} rows are asked for, but only {count} minority rows have all features")
    # Read once: the cut, the donors, the searches and the draws all start from these rows.
    minority_rows = materialise(
        df.where((F.col(target) == F.lit(minority)) & complete).select(key, target, *features))
    each, extra = divmod(missing, count)
    if extra:
        cuts, _ = lookup_table(hash_cuts(minority_rows, target, key, F.lit(extra), seed))  # one row
        first = F.when(F.struct(row_hash(key, seed).alias("h"), F.col(key).alias("key")) <= F.col("cut"), F.lit(1))
        draws = F.lit(each) + F.coalesce(first, F.lit(0))
        drawn = minority_rows.withColumn("cut", cuts.select("cut").scalar()).withColumn("draws", draws)
    else:
        drawn = minority_rows.withColumn("draws", F.lit(each))
    near = neighbour_lists(minority_rows, features, key, count, k, box_donors, chunk_queries)
    near = near.select(F.col(key).alias("n__key"), "neighbours").where(F.size("neighbours") > 0)
    drawn = drawn.where("draws > 0").select(
        key, target, *features, F.explode(F.sequence(F.lit(1), F.col("draws"))).alias("draw")
    )
    joined = drawn.join(near, F.col(key) == F.col("n__key"))
    dice = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"), F.col("draw").cast("string")))
    joined = joined.withColumn("dice", dice)
    chosen = F.element_at(
        "neighbours", (F.floor(uniform(F.col("dice"), 0) * F.size("neighbours")) + 1).cast("int")
    )["at"]
    gap = uniform(F.col("dice"), 1)
    made = [
        (F.col(c).cast("double") + gap * (chosen[j] - F.col(c).cast("double"))).alias(c) for j, c in enumerate(features)
    ]
    synthetic = joined.select(key, target, *made, F.lit(True).alias("synthetic"), F.col("draw").cast("bigint").alias("draw"))
    return original.unionByName(synthetic, allowMissingColumns=True)
