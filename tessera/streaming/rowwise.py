"""Per-row operators on Structured Streaming sources.

The reference has no streaming code.  What carries over are the per-row
operators (tokenize, prompts, sequence encoding up to padding, answer
extraction): they need no shuffle, window or state, so the same column
expressions run on a streaming DataFrame.  ``run_available`` processes
everything currently in a file source and stops (``availableNow``); its
checkpoint goes to the session's shared checkpoint folder, so a restarted
job resumes where it stopped instead of reprocessing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tessera.session import ensure_checkpoint_dir
from tessera.sources.tables import read_table, table_path


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, file_glob: str | None = None) -> DataFrame:
    """A file-source stream over the folder ``path`` (optionally only the
    file names matching ``file_glob``)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def read_table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The whole table as a file stream: all part files of a folder, or the
    single file (picked by name, since a stream reads folders only)."""
    table = read_table(spark, sf_dir, name)
    if [f.rpartition("/")[2] for f in table.inputFiles()] == [f"{name}.parquet"]:
        return read_stream(spark, sf_dir, table.schema, file_glob=f"{name}.parquet")
    return read_stream(spark, table_path(sf_dir, name), table.schema)


def run_available(spark: SparkSession, stream: DataFrame, transform: Callable[[DataFrame], DataFrame],
                  sink_path: str | None = None, name: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Apply ``transform`` to all available input, write it, return the result.

    The output is appended as files to ``sink_path``, by default a new
    folder beside the stream's checkpoint in the shared folder.
    """
    name = name or f"stream_{uuid.uuid4().hex[:12]}"
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    sink_path = sink_path or f"{base}/sink"
    out = transform(stream)
    q = (out.writeStream.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True)
         .format(fmt).outputMode("append").start(sink_path))
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return spark.read.schema(out.schema).format(fmt).load(sink_path)


def run_batches(spark: SparkSession, stream: DataFrame, transform: Callable[[DataFrame], DataFrame],
                name: str | None = None) -> DataFrame:
    """``run_available`` for transforms that need more than a row: each
    micro-batch is an ordinary DataFrame for ``transform`` (joins and
    regroupings included).  A batch writes its own folder and replaces it
    when it runs again, so a restart neither loses nor repeats rows."""
    name = name or f"stream_{uuid.uuid4().hex[:12]}"
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    schema = transform(spark.createDataFrame([], stream.schema)).schema

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{base}/sink/batch={number}")

    q = (stream.writeStream.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True)
         .foreachBatch(write).start())
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{base}/sink")
