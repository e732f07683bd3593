"""Newest row per key of a stream, kept in the state store.

The state holds one row per key: the newest so far. A batch compares its own newest rows with it
and emits the keys that changed, so nothing that was stored before is read again. Late rows are
judged by their own date: an older row never replaces a newer one and no row is dropped, however
late it comes. State therefore grows with the keys and not with the rows; it lies in RocksDB on
the executors and is saved with the checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from milepost.operators.dedup import latest_per_key
from milepost.sources.silver import BATCH, read_table
from milepost.streaming.ingest import run_batches, write_batch

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def newest_in_state(rows: DataFrame, keys: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """Newest row per key in the order of ``latest_per_key``; rows with a NULL key are one group.

    Tasks combine their rows per key before the shuffle, so a key holding most rows sends one
    row per task.
    """
    rest = [c for c in rows.columns if c not in keys and c not in newest_by]
    # structs compare field by field with NULL as the least value
    newest = F.max(F.struct(*newest_by, *rest)).alias("_row")
    fields = [F.col("_row")[c].alias(c) for c in (*newest_by, *rest)]
    return rows.groupBy(*keys).agg(newest).select(*keys, *fields).select(*rows.columns)


def ingest_newest(
    source: DataFrame,
    clean: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    newest_by: Sequence[str],
    path: str,
    checkpoint: str,
) -> StreamingQuery:
    """Store the changed newest rows of every file that arrived since the last run, and stop.

    Each batch owns a partition and replaces it when it is replayed. ``read_newest`` gives the
    newest row per key. A table belongs to one checkpoint; the number of state partitions is that
    of ``spark.sql.shuffle.partitions`` at its first run.
    """
    spark = source.sparkSession
    before = {name: spark.conf.get(name, None) for name in STATE_STORE}
    for name, value in STATE_STORE.items():
        spark.conf.set(name, value)
    try:
        return run_batches(
            newest_in_state(clean(source), keys, newest_by),
            lambda changed, batch_id: write_batch(changed, batch_id, path),
            checkpoint,
            "update",
        )
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def read_newest(
    spark: SparkSession, path: str, keys: Sequence[str], newest_by: Sequence[str]
) -> DataFrame | None:
    """One row per key of what ``ingest_newest`` stored; None before its first run.

    A key has a row for each batch that changed it, of which the newest is the state's.
    """
    stored = read_table(spark, path)
    return None if stored is None else latest_per_key(stored.drop(BATCH), keys, newest_by)
