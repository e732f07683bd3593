"""Reading the supplied tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.operators.windows import write_once
from milepost.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_ROWS = 2_000


def small_batches(spark: SparkSession) -> None:
    """Hand whole texts to Python in batches of at most ``BATCH_ROWS`` rows from now on.

    Spark's default of 10,000 rows suits narrow rows; with texts of several kilobytes such a
    batch holds tens of megabytes on both sides. A smaller setting stays as it is.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def store_texts(df: DataFrame, purpose: str) -> DataFrame:
    """Like ``write_once``, compressed harder: for tables that hold whole texts."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BITS = 23


def bit_places(hashes: np.ndarray) -> np.ndarray:
    """Places of 64-bit hashes in a table of ``2**BITS`` bits."""
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def bit_table(places: DataFrame) -> np.ndarray:
    """The table with the bits at ``places(place)`` set, as bytes.

    It has one mebibyte however many places there are, so it can be shipped with tasks. Who
    tests it with ``has_bits`` must tolerate a few hits too many.
    """
    shifted = F.col("place") + 1
    buckets = places.groupBy(F.bitmap_bucket_number(shifted).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(shifted)).alias("bits")
    )
    table = np.zeros((2**BITS // 32_768, 4_096), np.uint8)
    for row in buckets.collect():
        table[row.bucket - 1] = np.frombuffer(row.bits, np.uint8)
    return table.reshape(-1)


def has_bits(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (table[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)


def later_copies(docs: DataFrame) -> DataFrame:
    """``doc_id`` of the documents whose whole text a smaller doc_id has too.

    Only digests are shuffled; the least doc_id of each is found map-side first, so that a
    text which many documents share is no hot key.
    """
    digests = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", F.unhex(F.md5("text")).alias("digest"))
    digests = write_once(digests, "text-digests")
    firsts = digests.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return digests.join(firsts, "digest").where(F.col("doc_id") > F.col("first")).select("doc_id").distinct()


def with_clear_names(docs: DataFrame, taken: Iterable[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work(docs)`` with columns of ``docs`` that bear one of the names ``taken`` set aside.

    They get other names before and their own afterwards, so that ``work`` can use its names.
    """
    own = {c.lower() for c in docs.columns}
    aside = {}
    for c in docs.columns:
        if c.lower() in {t.lower() for t in taken}:
            new = f"_aside_{c}"
            while new.lower() in own:
                new += "_"
            aside[c] = new
            own.add(new.lower())
    done = work(docs.withColumnsRenamed(aside))
    back = {v: k for k, v in aside.items()}
    return done.select(*[F.col(f"`{c}`").alias(back.get(c, c)) for c in done.columns])
