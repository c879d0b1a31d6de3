"""Fitted models on streams. Newly arriving module files are the stream; the checkpoint remembers files already read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tabprep.functions.columns import file_stem, parent_name, table_path
from tabprep.plans.prepare import PreparedModel


def module_stream(spark: SparkSession, root: str, schema: StructType | str, max_files: int | None = None) -> DataFrame:
    """S6 as a stream: each Parquet file below `root` is read once, tagged with its `cycle` and `module`."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    path = table_path(F.col("_metadata.file_path"))
    return reader.parquet(root).select("*", parent_name(path).alias("cycle"), file_stem(path).alias("module"))


def _applied(model, df: DataFrame) -> DataFrame:
    return model.transform(df, keep_keys=True) if isinstance(model, PreparedModel) else model.transform(df)


def write_prepared(model, stream: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Apply a row-local fitted model to a stream and append the result as Parquet, exactly once per input file.

    The cycle stays with the module name, as both tell which file a row came from.
    """
    writer = _applied(model, stream).writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def write_prepared_batches(model, stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """The same for a model that joins (nearest neighbours): each micro-batch is prepared as a batch.

    Each batch has its own folder, so a batch that is run again after a failure replaces its rows.
    """
    def put(batch: DataFrame, number: int) -> None:
        _applied(model, batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
