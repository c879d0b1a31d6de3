"""Module tables laid out by their join key, so that joining them again moves no row.

Every module is written once as a bucketed, sorted table, one file per bucket, beside a *spine* of all keys. A full outer join of
the modules is then the spine with every module joined from the left: all sides are already cut by the key, so the plan has no
exchange, however often it runs, and sorts what is sorted. Repeated keys multiply, as in a full outer join; rows with a NULL in
the key match nothing and are appended. Choose no fewer buckets than the shuffle partitions of the sessions that join, or Spark
prefers an exchange to fewer tasks.

The layout is a small table beside the data; another session opens it and registers the tables again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.functions.columns import any_of
from tabprep.operators.joins import rename_overlap
from tabprep.sizing import local_table

SPINE = "_spine"


@dataclass(frozen=True)
class Layout:
    """Where the tables are and by what they are cut."""

    root: str
    keys: tuple[str, ...]
    buckets: int
    tables: dict[str, str]  # module (or SPINE) to registered name
    schemas: dict[str, str]

    def table(self, spark: SparkSession, module: str) -> DataFrame:
        return spark.table(self.tables[module])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def write_buckets(modules: Mapping[str, DataFrame], keys: Sequence[str], root: str, buckets: int) -> Layout:
    """Write all modules and the spine below `root`; one exchange per module, the last that its joins need."""
    keys = list(keys)
    tables = rename_overlap(dict(modules), keys)
    spark = next(iter(tables.values())).sparkSession
    names, schemas = {}, {}

    def write(name: str, df: DataFrame) -> DataFrame:
        registered = f"m_{uuid.uuid4().hex}"
        # Cut as the buckets are, so that a bucket is one file and its order can be used.
        cut = df.repartition(buckets, *[F.col(_quoted(k)) for k in keys])
        cut.write.mode("overwrite").option("path", f"{root}/{name}").bucketBy(buckets, keys[0], *keys[1:]).sortBy(
            keys[0], *keys[1:]).saveAsTable(registered)
        names[name], schemas[name] = registered, spark.table(registered).schema.json()
        return spark.table(registered)

    spine = None
    for name, df in tables.items():
        found = write(name, df).select(*keys)
        spine = found if spine is None else spine.unionByName(found)
    known = spine.where(~any_of([F.col(_quoted(k)).isNull() for k in keys])).distinct()
    write(SPINE, known)
    layout = Layout(root, tuple(keys), buckets, names, schemas)
    text = json.dumps({"keys": keys, "buckets": buckets, "schemas": schemas})
    local_table(spark, [(text,)], "layout string").write.mode("overwrite").parquet(f"{root}/_layout")
    return layout


def open_buckets(spark: SparkSession, root: str) -> Layout:
    """Register the tables of a layout that another session has written."""
    from pyspark.sql.types import StructType

    held = json.loads(spark.read.parquet(f"{root}/_layout").first()["layout"])
    names = {}
    keys = ", ".join(_quoted(k) for k in held["keys"])
    for name, schema in held["schemas"].items():
        names[name] = f"m_{uuid.uuid4().hex}"
        columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in StructType.fromJson(json.loads(schema)).fields)
        place = f"{root}/{name}".replace("'", "\\'")
        spark.sql(f"CREATE TABLE {names[name]} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                  f"INTO {int(held['buckets'])} BUCKETS LOCATION '{place}'")
    return Layout(root, tuple(held["keys"]), held["buckets"], names, held["schemas"])


def join_buckets(spark: SparkSession, layout: Layout, modules: Sequence[str] | None = None) -> DataFrame:
    """The full outer join of the modules (all by default) on the layout's keys, without an exchange on them.

    With a choice of modules, keys that none of them has keep a row of NULLs, as the spine knows all keys.
    """
    chosen = [m for m in layout.tables if m != SPINE] if modules is None else list(modules)
    keys = list(layout.keys)
    wide, loose = layout.table(spark, SPINE), None
    for m in chosen:
        table = layout.table(spark, m)
        wide = wide.join(table, keys, "left")
        apart = table.where(any_of([F.col(_quoted(k)).isNull() for k in keys]))
        loose = apart if loose is None else loose.unionByName(apart, allowMissingColumns=True)
    return wide.unionByName(loose, allowMissingColumns=True) if loose is not None else wide
