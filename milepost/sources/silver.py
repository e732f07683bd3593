"""Date-partitioned Parquet tables: writing, reading back, appending, registering."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.session import write_once
from milepost.sources.versions import DATA, NULL_DATE, current, read_version

PARTITION = "p_source_date"
BATCH = "_batch"


def write_partitions(
    df: DataFrame, path: str, partition: str = PARTITION, mode: str = "overwrite"
) -> None:
    """Write by date; ``overwrite`` replaces only the dates present in ``df``.

    The rebalance hint gathers each date into few files and lets the adaptive planner
    split a date that holds far more rows than the others.
    """
    (
        df.hint("rebalance", F.col(partition))
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def write_snapshot(df: DataFrame, path: str, partition: str | None = PARTITION) -> None:
    """Replace the whole table, dropping dates that are not in ``df``."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition:
        writer = (
            df.hint("rebalance", F.col(partition))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy(partition)
        )
    writer.parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """Table at ``path``, or None when nothing was written there yet.

    Only a missing path counts as "nothing"; any other failure is raised.
    """
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def existing_keys(spark: SparkSession, path: str, key: str) -> DataFrame | None:
    """Stored keys of a table. Duplicates do no harm to the anti join they feed."""
    stored = read_table(spark, path)
    return None if stored is None else stored.select(key).filter(F.col(key).isNotNull())


def keyless_path(path: str) -> str:
    """Where the rows without a key of an appended table are kept, beside those with one."""
    return f"{path.rstrip('/')}_keyless"


def streamed_path(path: str) -> str:
    """Where a stream keeps the rows without a key, by the batch that brought them."""
    return f"{path.rstrip('/')}_keyless_batches"


def unseen_rows(df: DataFrame, stored_keys: DataFrame | None, key: str) -> DataFrame:
    """Rows of ``df`` with a key that is not stored; rows without a key cannot be told apart."""
    keyed = df.filter(F.col(key).isNotNull())
    return keyed if stored_keys is None else keyed.join(stored_keys, key, "left_anti")


def append_unseen(
    spark: SparkSession, df: DataFrame, path: str, key: str, partition: str = PARTITION
) -> None:
    """Append rows with new keys. Stored rows stay, and a repeated run adds nothing."""
    write_partitions(
        unseen_rows(df, existing_keys(spark, path, key), key), path, partition, mode="append"
    )


def load_keyed(
    spark: SparkSession, df: DataFrame, path: str, key: str, partition: str = PARTITION
) -> None:
    """Load all rows of a feed: new keys are appended, rows without a key replaced by date.

    No key tells whether such a row is stored already, so those of the dates that the feed
    brings are written anew, as a table of their own. Other dates stay. ``read_keyed`` reads both.
    """
    append_unseen(spark, df, path, key, partition)
    keyless = df.filter(F.col(key).isNull())
    stored = read_table(spark, keyless_path(path))
    if stored is not None:
        # a date whose rows all have keys by now leaves nothing that would replace it
        brought, left = (d.select(F.col(partition).alias("_date")).distinct() for d in (df, keyless))
        same = F.col(partition).eqNullSafe(F.col("_date"))
        emptied = stored.join(brought, same, "left_semi").join(left, same, "left_anti")
        if not emptied.isEmpty():
            rest = write_once(stored.join(brought, same, "left_anti"), "keyless")
            return write_snapshot(rest.unionByName(keyless), keyless_path(path), partition)
    write_partitions(keyless, keyless_path(path), partition)


def read_keyed(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows with and without key of a table written by ``load_keyed`` or ``ingest_unseen``."""
    parts = [read_table(spark, p) for p in (path, keyless_path(path), streamed_path(path))]
    stored = [t.drop(BATCH) for t in parts if t is not None]
    return reduce(DataFrame.unionByName, stored) if stored else None


def register_table(spark: SparkSession, name: str, path: str) -> None:
    """Catalog table over the Parquet at ``path``, with all its partitions discovered.

    The table is external: registering anew follows a changed schema and drops no file.
    """
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    stored = spark.read.parquet(path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored.schema)
    dated = PARTITION in stored.columns and any(f"/{PARTITION}=" in f for f in stored.inputFiles()[:1])
    by = f"PARTITIONED BY (`{PARTITION}`)" if dated else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {by} LOCATION '{path}'")
    if dated:
        spark.catalog.recoverPartitions(name)


def register_version(
    spark: SparkSession, name: str, path: str, section: str = DATA, partition: str = PARTITION
) -> None:
    """Catalog table over a dated section of the current version of a table.

    Each folder becomes a partition by ``version`` and date, so that a query prunes dates. The
    table keeps showing this version until it is registered anew.
    """
    version = current(spark, path)
    stored = read_version(spark, path, section, version, layout=partition)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored.schema)
    spark.sql(
        f"CREATE TABLE {name} ({columns}, version STRING) USING parquet "
        f"PARTITIONED BY (version, `{partition}`) LOCATION '{path}/{section}'"
    )
    parts = []
    for folder in version.folders[section]:
        load, date = (p.split("=", 1)[1] for p in folder.split("/"))
        value = "NULL" if date == NULL_DATE else f"DATE'{date}'"
        parts.append(f"PARTITION (version='{load}', `{partition}`={value}) LOCATION '{path}/{section}/{folder}'")
    for start in range(0, len(parts), 500):
        spark.sql(f"ALTER TABLE {name} ADD {' '.join(parts[start : start + 500])}")
