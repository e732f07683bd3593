"""Hand-kept reference tables: event dictionary and parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from milepost.schemas import WAREHOUSE


def _load(spark: SparkSession, path: str, table: str) -> DataFrame:
    schema = WAREHOUSE[table]
    if path.rstrip("/").endswith(".csv"):
        return spark.read.schema(schema).option("header", True).csv(path)
    return spark.read.schema(schema).parquet(path)


def load_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Event dictionary from CSV or Parquet."""
    return _load(spark, path, "d_event_dictionary")


def load_parameters(spark: SparkSession, path: str) -> DataFrame:
    """Parameter base from CSV or Parquet."""
    return _load(spark, path, "parametro_base")
