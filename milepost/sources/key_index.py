"""Keyed append that reads only the dates which may hold an arriving key.

Beside the rows of a table its ``keys`` section summarises the stored keys of each date:
blocks of about ``KEYS_PER_BLOCK`` keys with their least and greatest one and a Bloom filter of
32,768 bits. Arriving keys are tested against the blocks, and the anti join then reads the key
column of those dates only. A date hit by mistake costs a read, never a row. Rows, keys and
rows without a key are committed as one version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.session import partitions_of_rows, write_once
from milepost.sources.silver import PARTITION
from milepost.sources.versions import DATA, Load, Version, current, read_version

KEYS, KEYLESS = "keys", "keyless"
KEYS_PER_BLOCK = 2_048
# keys that a task sorts by block, each as often as it has probes
KEYS_PER_TASK = 500_000
BITS = 32_768
PROBES = 4
# up to this many arriving keys are tested one by one; more of them only by least and greatest
TESTED_KEYS = 10_000


def _spot(key: Column, probe: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(probe)), F.lit(BITS))


def with_parts(rows: DataFrame, date: str, rows_per_part: int, parts: str) -> DataFrame:
    """Rows with the number of parts that their date is worth, for parts of about so many rows.

    ``rows`` are stored ones, as they are read twice. The sizes have a row per date, so they are
    sent to the rows and not the other way round.
    """
    number = F.ceil(F.count(F.lit(1)) / rows_per_part).cast("int").alias(parts)
    sizes = rows.groupBy(F.col(date).alias("_of")).agg(number)
    return rows.join(F.broadcast(sizes), F.col(date).eqNullSafe(F.col("_of"))).drop("_of")


def summarise_keys(rows: DataFrame, key: str, partition: str = PARTITION) -> DataFrame:
    """Blocks of the keys of each date: ``partition, block, blocks, low, high, bits``.

    A date with very many keys has as many blocks, so that no row grows and no group is hot.
    """
    keys = rows.where(F.col(key).isNotNull()).select(F.col(partition).alias("_date"), F.col(key).alias("_key"))
    sized = with_parts(keys, "_date", KEYS_PER_BLOCK, "blocks")
    placed = sized.withColumn("block", F.pmod(F.xxhash64("_key"), F.col("blocks").cast("long")).cast("int"))
    # keys are shuffled and not the bits: before that, each task has a few keys of every block
    tasks = partitions_of_rows(rows.sparkSession, keys.count(), KEYS_PER_TASK)
    of_block = placed.repartition(tasks, "_date", "block")
    spots = F.explode(F.array(*[_spot(F.col("_key"), i) for i in range(PROBES)]))
    return (
        of_block.select("_date", "block", "blocks", "_key", spots.alias("_spot"))
        .groupBy("_date", "block", "blocks")
        .agg(F.min("_key").alias("low"), F.max("_key").alias("high"), F.bitmap_construct_agg("_spot").alias("bits"))
        .withColumnRenamed("_date", partition)
    )


def _has_bit(bits: Column, spot: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (spot / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    return F.getbit(byte, (spot % 8).cast("int")) == 1


def _may_hold(key: Column) -> Column:
    """Whether the block of the current row may hold a key."""
    found = key.between(F.col("low"), F.col("high"))
    found = found & (F.pmod(F.xxhash64(key), F.col("blocks").cast("long")) == F.col("block"))
    for probe in range(PROBES):
        found = found & _has_bit(F.col("bits"), _spot(key, probe))
    return found


def dates_that_may_hold(index: DataFrame, arriving: DataFrame, key: str, partition: str = PARTITION) -> list:
    """Dates of the index with a block that may hold one of the arriving keys.

    The dates come to the driver, which has to list their folders anyway.
    """
    keys = arriving.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"))
    facts = keys.agg(F.approx_count_distinct("_key").alias("n"), F.min("_key").alias("least"), F.max("_key").alias("most")).first()
    if facts.least is None:
        return []
    overlapping = index.where((F.col("low") <= F.lit(facts.most)) & (F.col("high") >= F.lit(facts.least)))
    # only keys that are few are told apart, for which they have to be shuffled
    if facts.n <= 2 * TESTED_KEYS and (few := keys.distinct()).limit(TESTED_KEYS + 1).count() <= TESTED_KEYS:
        listed = few.agg(F.collect_list("_key")).scalar()
        overlapping = overlapping.withColumn("_keys", listed).where(F.exists("_keys", _may_hold))
    return [r[0] for r in overlapping.select(partition).distinct().collect()]


def unseen_keys(
    spark: SparkSession, arrived: DataFrame, path: str, key: str, version: Version, partition: str = PARTITION
) -> DataFrame:
    """Arrived rows with a key that no date of the stored version holds."""
    keyed = arrived.where(F.col(key).isNotNull())
    dates = dates_that_may_hold(read_version(spark, path, KEYS, version), keyed, key, partition)
    stored = read_version(spark, path, DATA, version, dates).select(key)
    return keyed.join(stored, key, "left_anti")


def append_indexed(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    key: str,
    partition: str = PARTITION,
    origin: str | None = None,
    fingerprint: str = "",
) -> int:
    """Append the rows of a feed whose key is not stored, as one new version; its number is returned.

    ``df`` is computed once and has one row per key. Rows without a key cannot be told apart: those
    of the files in column ``origin`` replace what the same files brought before, rows of other
    files stay. Without ``origin`` they replace those of the same dates.
    """
    arrived = write_once(df, "arrived")
    load = Load(spark, path)
    keyless = arrived.where(F.col(key).isNull())
    if DATA not in load.schemas:
        new = arrived.where(F.col(key).isNotNull())
    else:
        new = write_once(unseen_keys(spark, arrived, path, key, load.base, partition), "unseen")
    dates = [r[0] for r in arrived.select(partition).distinct().collect()]
    if origin and KEYLESS in load.schemas:
        before = read_version(spark, path, KEYLESS, load.base, dates)
        keyless = before.join(arrived.select(origin).distinct(), origin, "left_anti").unionByName(keyless)
    load.write(new, DATA, partition, "none")
    load.write(summarise_keys(new, key, partition), KEYS, None, "none")
    load.write(keyless.select(*arrived.columns), KEYLESS, partition, "dates", dates)
    load.fingerprint = fingerprint
    return load.commit()


def replace_indexed(
    spark: SparkSession, df: DataFrame, path: str, key: str, partition: str = PARTITION, fingerprint: str = ""
) -> int:
    """Replace the whole table by the rows of a feed."""
    arrived = write_once(df, "arrived")
    load = Load(spark, path)
    keyed = arrived.where(F.col(key).isNotNull())
    load.write(keyed, DATA, partition)
    load.write(summarise_keys(keyed, key, partition), KEYS)
    load.write(arrived.where(F.col(key).isNull()), KEYLESS, partition)
    load.fingerprint = fingerprint
    return load.commit()


def read_indexed(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows with and without a key of the current version."""
    version = current(spark, path)
    if version is None:
        return None
    return read_version(spark, path, DATA, version).unionByName(read_version(spark, path, KEYLESS, version))
