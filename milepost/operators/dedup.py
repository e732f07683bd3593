"""Latest row per key, snapshots and official dates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    newest_by: Sequence[str],
    null_keys: str = "collapse",
) -> DataFrame:
    """Keep the newest row of each key.

    ``newest_by`` columns are compared newest first and then all other columns, so
    the winner never depends on how the rows were spread. Rows with a NULL key
    ``collapse`` to one row, are all kept (``keep``) or dropped (``drop``).

    The rank filter is pushed below the shuffle as a group limit: a task sends at
    most one row per key, even for a key that holds most of the table.
    """
    if null_keys not in ("collapse", "keep", "drop"):
        raise ValueError(f"unknown null_keys: {null_keys}")
    has_key = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    if null_keys == "drop":
        df = df.filter(has_key)
    rest = [c for c in df.columns if c not in keys and c not in newest_by]
    order = [F.col(c).desc_nulls_last() for c in (*newest_by, *rest)]
    partition = list(keys)
    ranked = df
    if null_keys == "keep":
        # each keyless row is a group of its own, so keyless rows never share a task
        ranked = ranked.withColumn(
            "_keyless", F.when(~has_key, F.monotonically_increasing_id())
        )
        partition.append("_keyless")
    window = W.partitionBy(*partition).orderBy(*order)
    ranked = ranked.withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") == 1).select(*df.columns)


def at_latest(df: DataFrame, column: str) -> DataFrame:
    """Rows at the greatest value of ``column``, found by a scalar subquery."""
    return df.filter(F.col(column) == df.agg(F.max(column)).scalar())


def at_date(df: DataFrame, column: str, dates: DataFrame, date_column: str) -> DataFrame:
    """Rows of ``df`` dated like the newest date of another table."""
    return df.filter(F.col(column) == dates.agg(F.max(date_column)).scalar())


def date_inventory(df: DataFrame, column: str) -> DataFrame:
    """Distinct dates in ascending order."""
    return df.select(column).distinct().orderBy(column)
