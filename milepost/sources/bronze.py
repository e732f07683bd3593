"""Reading raw CSV extracts and routing landed files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from milepost.constants import BRONZE_PREFIX, LANDING_FOLDERS
from milepost.functions.text import first_label
from milepost.session import write_once

SOURCE_FILE = "_source_file"
CORRUPT, REASON = "_corrupt_line", "_reason"
TOO_FEW, TOO_MANY, BROKEN_QUOTES = "too few fields", "too many fields", "broken quotes"


def with_source_file(df: DataFrame) -> DataFrame:
    """Add the full path of the file each row came from."""
    return df.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))


def source_files(spark: SparkSession, path: str) -> DataFrame:
    """The files below a folder, named as ``with_source_file`` names them; none is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("_metadata.file_path").alias(SOURCE_FILE)).distinct()


def read_bronze(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    recursive: bool = True,
    name_glob: str | None = None,
) -> DataFrame:
    """Headered CSV files below ``path`` as text columns plus their source file.

    The schema is given, so the files are read once; columns are matched to the
    header by name when its order differs.
    """
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("recursiveFileLookup", recursive)
    )
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return with_source_file(reader.csv(path))


def _reason(schema: T.StructType) -> Column:
    """Why a line is malformed, or NULL. A value that keeps its quote was not closed where it ends."""
    bare = F.regexp_replace(CORRUPT, r'"([^"]|"")*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    open_quote = (F.length(CORRUPT) - F.length(F.replace(F.col(CORRUPT), F.lit('"'), F.lit("")))) % 2 == 1
    kept_quote = reduce(Column.__or__, [F.coalesce(F.startswith(F.col(f"`{n}`"), F.lit('"')), F.lit(False)) for n in schema.names])
    return (
        F.when(F.col(CORRUPT).isNull(), F.when(kept_quote, BROKEN_QUOTES))
        .when(open_quote, BROKEN_QUOTES)
        .when(fields < len(schema), TOO_FEW)
        .when(fields > len(schema), TOO_MANY)
        .otherwise(BROKEN_QUOTES)
    )


def read_checked(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """Well-formed rows like those of ``read_bronze``, and ``line, reason, file`` of all other lines.

    The files are read once: every line is parsed and stored with what is wrong with it, and both
    results read that. Each line is in one of them. A line of separators only is a row of NULLs;
    lines without any character are no lines. All columns of ``schema`` are text.
    """
    reader = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]))
        .option("header", header)
        .option("enforceSchema", False)
        .option("recursiveFileLookup", True)
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    parsed = with_source_file(reader.csv(path)).withColumn(REASON, _reason(schema))
    stored = write_once(parsed, "bronze-checked")
    line = F.coalesce(CORRUPT, F.concat_ws(",", *[F.coalesce(F.col(f"`{n}`"), F.lit("")) for n in schema.names]))
    good = stored.filter(F.col(REASON).isNull()).select(*[f"`{n}`" for n in schema.names], SOURCE_FILE)
    bad = stored.filter(F.col(REASON).isNotNull())
    return good, bad.select(line.alias("line"), F.col(REASON).alias("reason"), F.col(SOURCE_FILE).alias("file"))


def file_name(path: Column) -> Column:
    """Last part of a path."""
    return F.substring_index(F.rtrim(path, F.lit("/")), "/", -1)


def route_landing(files: DataFrame, export_prefix: str, path: str = "path") -> DataFrame:
    """Decide for each landed file key whether and where it enters bronze.

    ``export_prefix`` is the part of the landing folder names before the table.
    Keys already in bronze and keys outside the six known folders are refused.
    """
    key = F.col(path)
    table = first_label(
        [
            (key.startswith(f"{export_prefix}{folder}/"), table)
            for table, folder in LANDING_FOLDERS.items()
        ]
    )
    in_bronze = key.startswith(BRONZE_PREFIX)
    routed = files.select("*", F.when(~in_bronze, table).alias("table"))
    accepted = F.col("table").isNotNull()
    return routed.select(
        "*",
        accepted.alias("accepted"),
        F.when(in_bronze, "already in bronze")
        .when(accepted, "accepted")
        .otherwise("out of scope")
        .alias("reason"),
        F.when(accepted, F.concat(F.lit(BRONZE_PREFIX), key)).alias("bronze_path"),
    )
