"""Fingerprints of a stage's inputs, by which a repeated run knows what is finished.

A stage is one published table. Its manifest holds the fingerprint of everything it was computed
from: files by their listing, tables by the folders of their version, small frames by their
rows, settings by their text. A stage is finished when its current version carries the
fingerprint that its inputs have now, so that a changed input redoes its stage and, through the
new version, whatever is built on it.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.sources.versions import current

# to be raised with every change of a rule that alters results, so that finished stages are redone
RULES = 1


def fingerprint(*parts: object) -> str:
    """One fingerprint of several, and of settings given as plain values."""
    return hashlib.sha256(json.dumps([RULES, *parts], default=str).encode()).hexdigest()


def of_rows(df: DataFrame) -> str:
    """Fingerprint of a frame's rows in any order, from one aggregate."""
    digest = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    facts = df.agg(F.count(F.lit(1)), F.sum(digest.cast("decimal(20,0)")), F.bit_xor(digest)).first()
    return fingerprint(df.columns, *facts)


def of_files(spark: SparkSession, path: str) -> str:
    """Fingerprint of the files below a folder: paths, sizes and times; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return of_rows(files.select("path", "length", "modificationTime"))


def of_version(spark: SparkSession, path: str) -> str:
    """Fingerprint of the current version of a table; its folders have names that never recur."""
    version = current(spark, path)
    return fingerprint(version and version.folders)


def is_finished(spark: SparkSession, path: str, wanted: str) -> bool:
    """Whether the current version of a table was built from inputs with this fingerprint."""
    version = current(spark, path)
    return bool(wanted and version and version.fingerprint == wanted)
