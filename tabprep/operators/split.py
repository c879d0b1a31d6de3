"""Exact stratified split by a portable hash of the row key."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.sizing import hinted, lookup_table

BUCKET_DIGITS = 5  # hex digits: about a million buckets per class


def row_hash(key: str, seed: int) -> Column:
    """Hex text that orders rows at random but reproducibly, on any engine with md5."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))


def uniform(text: Column, part: int = 0) -> Column:
    """A number in [0, 1) from eight hex digits of a hash."""
    return F.conv(F.substring(text, 1 + 8 * part, 8), 16, 10).cast("double") / F.lit(float(2 ** 32))


def hash_cuts(df: DataFrame, strata: str, key: str, wanted: Column, seed: int) -> DataFrame:
    """(stratum, cut): the hash and key of the last row to take per stratum, `wanted` computed from the count `n`.

    Rows are counted per stratum and hash bucket first; only the one bucket that holds the cut is ranked row by row.
    """
    hashed = df.select(F.col(strata).alias("stratum"), row_hash(key, seed).alias("h"), F.col(key).alias("key"))
    bucket = F.substring("h", 1, BUCKET_DIGITS)
    counts = hashed.groupBy("stratum", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))
    per_stratum = Window.partitionBy("stratum")
    placed = counts.withColumns({
        "n": F.sum("rows").over(per_stratum), "upto": F.sum("rows").over(per_stratum.orderBy("bucket")),
    }).withColumn("take", wanted.cast("bigint"))
    edge = placed.where((F.col("upto") >= F.col("take")) & (F.col("upto") - F.col("rows") < F.col("take"))).select(
        F.col("stratum").alias("e__stratum"), F.col("bucket").alias("e__bucket"),
        (F.col("take") - F.col("upto") + F.col("rows")).alias("nth"),
    )
    edge, small = lookup_table(edge)  # one row per stratum
    inside = hashed.join(
        hinted(edge, small), F.col("stratum").eqNullSafe(F.col("e__stratum")) & (bucket == F.col("e__bucket"))
    )
    ranked = inside.withColumn("rank", F.row_number().over(Window.partitionBy("stratum").orderBy("h", "key")))
    return ranked.where(F.col("rank") == F.col("nth")).select(
        F.col("stratum").alias("e__stratum"), F.struct("h", "key").alias("cut")
    )


@dataclass(frozen=True)
class StratifiedSplit:
    """D10. Applying it is row-local, so any later batch with the same keys splits the same way."""

    strata: str
    key: str
    seed: int
    cuts: DataFrame
    small: bool

    def transform(self, df: DataFrame, out: str = "split") -> DataFrame:
        joined = df.join(hinted(self.cuts, self.small), F.col(self.strata).eqNullSafe(F.col("e__stratum")), "left")
        position = F.struct(row_hash(self.key, self.seed).alias("h"), F.col(self.key).alias("key"))
        return joined.withColumn(out, F.when(position <= F.col("cut"), "train").otherwise("test")).drop(
            "e__stratum", "cut"
        )


def fit_split(df: DataFrame, strata: str, key: str, train_share: float = 0.8, seed: int = 42) -> StratifiedSplit:
    """Per class, the nearest whole number of `train_share` of its rows goes to training. Keys must be unique."""
    cuts, small = lookup_table(hash_cuts(df, strata, key, F.round(F.col("n") * F.lit(train_share)), seed))
    return StratifiedSplit(strata, key, seed, cuts, small)
