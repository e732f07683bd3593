"""Gates and key checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.constants import REQUIRED_SILVER


class QualityError(RuntimeError):
    """A gate did not pass."""


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def checkpoint_report(
    spark: SparkSession,
    tables: dict[str, DataFrame | None],
    required: tuple[str, ...] = REQUIRED_SILVER,
) -> DataFrame:
    """One row per required table: does it exist, how many rows, passed or not."""
    reports = []
    for name in required:
        df = tables.get(name)
        if df is None:
            report = spark.range(1).select(
                F.lit(name).alias("table_name"),
                F.lit(False).alias("exists"),
                F.lit(0).cast("bigint").alias("rows"),
            )
        else:
            report = df.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("table_name"), F.lit(True).alias("exists"), "rows"
            )
        reports.append(report)
    return _stack(reports).withColumn(
        "status",
        F.when(~F.col("exists"), "missing").when(F.col("rows") == 0, "empty").otherwise("ok"),
    )


def require_checkpoint(
    spark: SparkSession,
    tables: dict[str, DataFrame | None],
    required: tuple[str, ...] = REQUIRED_SILVER,
) -> None:
    """Raise with the full list of missing and empty tables.

    Asks each table for one row only, which stops the scan at the first one found.
    """
    faults = []
    for name in required:
        df = tables.get(name)
        if df is None:
            faults.append(f"table {name} is missing")
        elif df.isEmpty():
            faults.append(f"table {name} is empty")
    if faults:
        raise QualityError("checkpoint failed:\n" + "\n".join(faults))


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Pass ``df`` on, or raise when it has no row."""
    if df.isEmpty():
        raise QualityError(message)
    return df


def check_primary_key(df: DataFrame, table: str, key: str) -> DataFrame:
    """Rows, NULL keys and repeated keys of a declared primary key, as one row.

    Counts per key are combined on the map side, so a much repeated key costs nothing.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    known = F.col(key).isNotNull()
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("null_keys"),
        F.count_if(known & (F.col("n") > 1)).alias("duplicated_keys"),
        F.coalesce(F.sum(F.when(known, F.col("n") - 1)), F.lit(0)).alias("surplus_rows"),
    ).select(
        F.lit(table).alias("table_name"),
        F.lit(key).alias("key_column"),
        "rows", "null_keys", "duplicated_keys", "surplus_rows",
        ((F.col("null_keys") == 0) & (F.col("duplicated_keys") == 0)).alias("valid"),
    )


def check_foreign_key(
    df: DataFrame, table: str, key: str, ref: DataFrame, ref_table: str, ref_key: str
) -> DataFrame:
    """Orphans of a declared foreign key, as one row; NULL keys are no orphans."""
    per_key = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("n"))
    known = ref.select(F.col(ref_key).alias("_key")).distinct().withColumn("_known", F.lit(True))
    orphan = F.col("_key").isNotNull() & F.col("_known").isNull()
    return (
        per_key.join(known, "_key", "left")
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(F.col("_key").isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
            F.count_if(orphan).alias("orphan_keys"),
            F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0)).alias("orphan_rows"),
        )
        .select(
            F.lit(table).alias("table_name"),
            F.lit(key).alias("key_column"),
            F.lit(ref_table).alias("ref_table"),
            F.lit(ref_key).alias("ref_column"),
            "rows", "null_keys", "orphan_keys", "orphan_rows",
            (F.col("orphan_keys") == 0).alias("valid"),
        )
    )


def check_primary_keys(tables: dict[str, DataFrame], keys: dict[str, str]) -> DataFrame:
    return _stack([check_primary_key(tables[t], t, k) for t, k in keys.items()])


def check_foreign_keys(tables: dict[str, DataFrame], keys: dict) -> DataFrame:
    return _stack(
        [
            check_foreign_key(tables[t], t, c, tables[rt], rt, rc)
            for (t, c), (rt, rc) in keys.items()
        ]
    )


def null_partition_report(df: DataFrame, table: str, partition: str = "p_source_date") -> DataFrame:
    """Rows that would land in the default partition because their date is NULL."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(partition).isNull()).alias("undated_rows"),
    ).select(
        F.lit(table).alias("table_name"), "rows", "undated_rows",
        (F.col("undated_rows") == 0).alias("valid"),
    )
