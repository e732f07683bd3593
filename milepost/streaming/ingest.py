"""Incremental bronze to silver with Structured Streaming.

The checkpoint of the query remembers which files were read. Micro-batches run the
same cleaning functions as the batch jobs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from milepost.sources.bronze import with_source_file
from milepost.sources.silver import BATCH, append_unseen, streamed_path


def stream_bronze(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of newly arrived CSV rows below ``path`` with their source file."""
    reader = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("recursiveFileLookup", True)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return with_source_file(reader.csv(path))


def ingest(
    source: DataFrame,
    clean: Callable[[DataFrame], DataFrame],
    cleaned_path: str,
    checkpoint: str,
) -> StreamingQuery:
    """Clean every file that arrived since the last run into ``cleaned_path`` and stop.

    A batch owns one partition and replaces it when it is replayed, so a lost driver or
    executor never leaves rows twice. ``latest_per_key`` over the cleaned rows gives
    the same silver table as one batch run over all files.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        write_batch(clean(batch), batch_id, cleaned_path)

    return run_batches(source, store, checkpoint)


def ingest_unseen(
    source: DataFrame,
    clean: Callable[[DataFrame], DataFrame],
    silver_path: str,
    key: str,
    checkpoint: str,
) -> StreamingQuery:
    """Append rows with unseen keys of every newly arrived file, first come first kept.

    ``clean`` has to leave one row per key. A replayed batch finds its keys stored. Rows
    without a key are all kept, in a partition that their batch owns and replaces when it is
    replayed; ``read_keyed`` reads both. A table belongs to one checkpoint.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        rows = clean(batch)
        append_unseen(batch.sparkSession, rows, silver_path, key)
        write_batch(rows.filter(F.col(key).isNull()), batch_id, streamed_path(silver_path))

    return run_batches(source, store, checkpoint)


def write_batch(rows: DataFrame, batch_id: int, path: str) -> None:
    """Write the rows of a batch, replacing those of an earlier try."""
    (
        rows.withColumn(BATCH, F.lit(batch_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BATCH)
        .parquet(path)
    )


def run_batches(
    source: DataFrame, store: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    """Hand every batch that is due to ``store`` and stop."""
    query = (
        source.writeStream.foreachBatch(store)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
