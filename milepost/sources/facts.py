"""Facts in folders by month, so that a look back over some months reads no others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.sources.versions import publish, read_version

MONTH = "p_month"
# the time that places a row of each fact table
MONTHS = {"t_trips": "end_drive", "t_events": "start_time"}
MONTHS_PER_FOLDER = 4


def with_month(df: DataFrame, time: str) -> DataFrame:
    """The month of each row's time, last of all columns; NULL without a time."""
    return df.withColumn(MONTH, F.trunc(F.col(time), "month"))


def lies_by_month(df: DataFrame, folder: str) -> bool:
    """Whether rows stored by ``folder`` lie near enough by month to be written where they are read.

    A task writes a file for each month that its folders hold. Weighed by their rows, folders with
    up to ``MONTHS_PER_FOLDER`` months leave few files; others have to be shuffled by month.
    """
    cells = df.groupBy(folder, MONTH).agg(F.count(F.lit(1)).alias("n"))
    folders = cells.groupBy(folder).agg(F.count(F.lit(1)).alias("months"), F.sum("n").alias("n"))
    found = folders.agg(F.sum(F.col("months") * F.col("n")) / F.sum("n")).first()[0]
    return found is None or found <= MONTHS_PER_FOLDER


def store_by_month(df: DataFrame, path: str, time: str) -> int:
    """Publish a fact table laid out by month; the month is no column of the table itself."""
    return publish(with_month(df, time), path, MONTH, hidden=True)


def read_by_month(spark: SparkSession, path: str) -> DataFrame | None:
    """The current version with its month, by which filters choose folders."""
    return read_version(spark, path, layout=MONTH)


def since(df: DataFrame, time: str, bound: Column) -> DataFrame:
    """Rows from ``bound`` on; of facts that carry their month, earlier months are not read."""
    recent = df.filter(F.col(time) >= bound.cast("timestamp_ntz"))
    if MONTH not in df.columns:
        return recent
    return recent.filter(F.col(MONTH) >= F.trunc(bound, "month"))
