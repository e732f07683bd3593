"""Periods, top-k and exact row numbers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from milepost.session import write_once


def with_previous(
    df: DataFrame, value: str, output: str, keys: Sequence[str], period: Sequence[str]
) -> DataFrame:
    """Value of the previous existing row of each key, in ascending ``period`` order."""
    window = W.partitionBy(*keys).orderBy(*period)
    return df.withColumn(output, F.lag(value).over(window))


def newest_row(df: DataFrame, keys: Sequence[str], period: Sequence[Column]) -> DataFrame:
    """First row of each key in the given order."""
    return top_rows(df, keys, period, 1).drop("_rank")


def top_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "_rank"
) -> DataFrame:
    """First ``k`` rows of each key with their rank.

    Spark cuts each task's rows to ``k`` per key before the shuffle, so a key holding
    most rows is ranked by all tasks together. ``order`` has to end in a unique column.
    """
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def with_row_number(
    df: DataFrame,
    order: Sequence[Column],
    output: str,
    keys: Sequence[str] = (),
    total: str | None = None,
) -> DataFrame:
    """Row number of every row within its key, or over the whole frame without keys.

    A plain window would pull each key into one task. Here the rows are range
    partitioned by (keys, order) and stored once with their slice number; slices are
    numbered on their own and shifted by the row counts of the slices before. No task
    holds more than a slice, whatever one key's share of the rows is. ``order`` has to
    end in a unique column. ``total`` names an extra column for the rows of the key.
    """
    sliced = write_once(
        df.repartitionByRange(*keys, *order).withColumn("_slice", F.spark_partition_id()),
        "row-number",
    )
    counts = sliced.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_rows"))
    # one row per key and slice: at most (keys + slices) rows
    by_key = W.partitionBy(*keys)
    before = by_key.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    shifts = counts.select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        F.col("_slice").alias("_shift_slice"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(by_key).alias("_total"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    local = W.partitionBy("_slice", *keys).orderBy(*order)
    numbered = sliced.withColumn("_local", F.row_number().over(local)).join(
        shifts, reduce(Column.__and__, same, F.col("_slice") == F.col("_shift_slice"))
    )
    extra = [F.col("_total").alias(total)] if total else []
    return numbered.select(
        *df.columns, (F.col("_local") + F.col("_before")).cast("bigint").alias(output), *extra
    )
