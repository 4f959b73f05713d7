"""Load each landed file once, with Structured Streaming's file source and checkpoint.

A run takes what has landed since the last one and stops. The checkpoint lies in the target folder,
so that rows and the record of what was read are kept, moved and deleted together.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators.conform import conform
from tripmart.operators.sinks import write_partitions
from tripmart.sources.readers import read_objects, read_zone

FILES_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def stream_uniform(
    spark: SparkSession, landing: str, target: str, schema: T.StructType, run_date: date | None = None, files_per_batch: int = 10_000
) -> None:
    """For files of one schema: file source to parquet sink, exactly once.

    The sink's log decides which files count, so the target belongs to this stream alone.
    """
    raw = (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(landing)
    )
    rows = conform(raw.withColumn("data_source", F.col("_metadata.file_path")), run_date)
    query = (
        rows.writeStream.format("parquet")
        .partitionBy("source_date")
        .option("checkpointLocation", f"{target}/_checkpoint")
        .trigger(availableNow=True)
        .start(f"{target}/rows")
    )
    query.awaitTermination()


def stream_drifting(
    spark: SparkSession,
    landing: str,
    target: str,
    targets: dict[str, str] | None = None,
    run_date: date | None = None,
    files_per_batch: int = 10_000,
) -> None:
    """For files whose schemas differ: the stream carries paths, and each batch is one drift-safe read.

    A batch writes partitions of its own number. If it is repeated after a failure, it has the same
    files and replaces what it wrote; a later batch for the same month adds to the month. Columns
    whose type drifts belong in ``targets``, so that all batches write one type. At most
    ``files_per_batch`` paths reach the driver at a time.
    """

    def load(batch: DataFrame, number: int) -> None:
        paths = sorted(row.path for row in batch.toLocalIterator())
        if not paths:
            return
        rows = conform(read_objects(batch.sparkSession, paths, targets), run_date)
        write_partitions(rows.withColumn("load_batch", F.lit(number)), f"{target}/rows", ["source_date", "load_batch"])

    files = (
        spark.readStream.format("binaryFile")
        .schema(FILES_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(landing)
        .select("path")
    )
    query = (
        files.writeStream.foreachBatch(load)
        .option("checkpointLocation", f"{target}/_checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_loaded(spark: SparkSession, target: str) -> DataFrame:
    """Rows loaded so far by either stream, with ``source_date`` as text.

    Batches whose schemas differ are read by groups: a column that only some have is NULL in the
    others, and numbers are widened.
    """
    rows = read_zone(spark, f"{target}/rows", ("source_date", "load_batch"))
    return rows.drop("load_batch")
