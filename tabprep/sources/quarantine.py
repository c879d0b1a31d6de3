"""Which files of a tree can be read to their last row, found while they are read.

A footer promises a number of rows; reading every column of every row shows how many are there. Both counts are Spark jobs over
all files, with damaged files skipped instead of failing the job, so a file that breaks in the middle is told from a good one
without being opened on the driver. Page checksums are verified, so damage that still decodes is found as well.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.functions.columns import file_stem, parent_name, table_path
from tabprep.session import materialise, run_together
from tabprep.sizing import local_table
from tabprep.sources.modules import TOGETHER

OUTCOME = "file string, cycle string, module string, status string, rows bigint, rows_read bigint, error string"


def _skipping(spark: SparkSession):
    return spark.read.option("ignoreCorruptFiles", "true").option("parquet.page.verify-checksum.enabled", "true")


def _content(df: DataFrame) -> Column:
    """A digest that needs every value of a row."""
    cols = [F.map_entries(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`") for f in df.schema.fields]
    return F.bit_xor(F.xxhash64(*cols)) if cols else F.lit(0).cast("bigint")


def opened_tables(spark: SparkSession, paths: list[str], corrupt: bool = True) -> dict[str, DataFrame | Exception]:
    """Every table's DataFrame, or why there is none; each footer is read once, several tables at a time."""
    def opened(path: str):
        try:
            return (_skipping(spark) if corrupt else spark.read).parquet(path)
        except Exception as failure:
            return failure

    out: dict[str, DataFrame | Exception] = {}
    for begin in range(0, len(paths), TOGETHER):
        part = paths[begin:begin + TOGETHER]
        out |= dict(zip(part, run_together(spark, *[lambda p=p: opened(p) for p in part])))
    return out


def quarantine(spark: SparkSession, root: str, glob: str = "*.parquet") -> tuple[dict[tuple[str, str], DataFrame], DataFrame]:
    """({(cycle, module): table of its good files}, one row per file: OUTCOME).

    Status is `processed`, `empty` (no rows), `damaged` (fewer rows than the footer says, or content that fails its checksum) or
    `failed` (no readable footer). Only good files are read later, so a total is never quietly short: what is missing is listed.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    place = table_path(F.col("file"))
    paths = listed.select(F.col("path").alias("file"))
    # A file without bytes gives no row, only a name.
    names = local_table(spark, [(re.sub("^file:/+", "file:/", unquote(p)),) for p in listed.inputFiles()], "name string")
    named = F.regexp_replace("file", "^file:/+", "file:/") == F.col("name")
    blank = names.join(paths, named, "left_anti").select(F.col("name").alias("file"))
    files = materialise(paths.unionByName(blank).select(
        "file", place.alias("table"), parent_name(place).alias("cycle"), file_stem(place).alias("module")))
    tables = [r["table"] for r in files.select("table").distinct().orderBy("table").collect()]  # one row per module table
    opened = opened_tables(spark, tables)
    promised = read = None
    for df in opened.values():
        if isinstance(df, Exception):
            continue
        named = df.withColumn("file__", F.col("_metadata.file_path"))
        # Counting without columns only asks the footers.
        footer = named.groupBy(F.col("file__").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
        whole = named.groupBy(F.col("file__").alias("file")).agg(F.count(F.lit(1)).alias("rows_read"), _content(df).alias("content"))
        promised = footer if promised is None else promised.unionByName(footer)
        read = whole if read is None else read.unionByName(whole)
    if promised is None:
        promised = local_table(spark, [], "file string, rows bigint")
        read = local_table(spark, [], "file string, rows_read bigint, content bigint")
    counted = materialise(files.join(promised, "file", "left").join(read, "file", "left"))
    # Files without a row in either count are few: the bad ones and the empty ones. They are asked one by one.
    silent = [r["file"] for r in counted.where("rows IS NULL").orderBy("file").collect()]
    why = [(p, "empty", None) if not isinstance(d, Exception) else (p, "failed", str(d).split("\n")[0][:300]) for p, d in
           opened_tables(spark, silent, corrupt=False).items()]
    asked = local_table(spark, why, "file string, found string, error string")
    short = F.coalesce(F.col("rows_read"), F.lit(0)) < F.col("rows")
    outcomes = materialise(counted.join(F.broadcast(asked), "file", "left").select(
        "file", "cycle", "module",
        F.coalesce("found", F.when(short, "damaged").otherwise("processed")).alias("status"),
        F.coalesce("rows", F.when(F.col("found") == "empty", F.lit(0))).alias("rows"), F.coalesce("rows_read", F.lit(0)).alias("rows_read"),
        F.coalesce("error", F.when(short, F.concat(
            F.lit("read "), F.coalesce("rows_read", F.lit(0)), F.lit(" of "), F.col("rows"), F.lit(" rows")))).alias("error")))
    good = outcomes.where("status IN ('processed', 'empty')").groupBy("cycle", "module").agg(F.sort_array(F.collect_list("file")).alias("files"))
    return {(r["cycle"], r["module"]): spark.read.parquet(*r["files"]) for r in good.orderBy("cycle", "module").collect()}, outcomes
