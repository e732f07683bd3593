"""Versioned Parquet tables: all changes of a load become visible by one rename.

A table is a folder. Its sections (``data`` and side tables) hold the files below
``<section>/version=<number>-<token>/``; ``manifests/<number>.json`` lists the folders and the
schema of every section in that version. A load writes folders that no manifest names yet,
and ``commit`` moves its manifest into place. Before that moment readers see the version
before, whole; a load that dies leaves files which nobody reads and ``expire`` removes. Folders
of dates that a load does not touch are named again, not copied. The rename fails if another
load took the number, so of two concurrent loads one has to be repeated.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from milepost.session import compiled_methods, files_at_once

DATA, MANIFESTS = "data", "manifests"
FILES_AT_ONCE = 16
NULL_DATE = "__HIVE_DEFAULT_PARTITION__"


class ConcurrentLoad(Exception):
    """Another load committed the version this one was to become."""


@dataclass(frozen=True)
class Version:
    """A committed state: folders and schema (as JSON) per section.

    ``built_from`` names versions of other tables that this one was computed from and
    ``fingerprint`` stands for all inputs of a stage (see ``fingerprints``). Being part of the
    manifest, it can never tell of a load that was not committed.
    """

    number: int
    folders: dict[str, list[str]] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)
    built_from: dict[str, int] = field(default_factory=dict)
    fingerprint: str = ""


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder, hidden things left out."""
    folder, store = _path(spark, path)
    if not store.exists(folder):
        return []
    names = [status.getPath().getName() for status in store.listStatus(folder)]
    return sorted(n for n in names if not n.startswith((".", "_")))


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that can be read, in ascending order."""
    names = _names(spark, f"{path}/{MANIFESTS}")
    return [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]


def current(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The newest version, or a given one that was not removed yet."""
    known = versions(spark, path)
    if number is None and not known:
        return None
    if number is not None and number not in known:
        raise ValueError(f"no version {number} at {path}")
    manifest, store = _path(spark, f"{path}/{MANIFESTS}/{_number(number or known[-1])}.json")
    stream = store.open(manifest)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Version(**json.loads(text))


def _number(number: int) -> str:
    return f"{number:012d}"


def read_version(
    spark: SparkSession,
    path: str,
    section: str = DATA,
    version: Version | None = None,
    dates: Iterable | None = None,
    layout: str | None = None,
) -> DataFrame | None:
    """A section of the current (or given) version, or None when it does not exist.

    ``dates`` keeps the folders of these dates only; others are not even listed. ``layout`` names
    the column that a hidden layout partitions by; it is read as a date, last of all columns.
    """
    version = version or current(spark, path)
    if version is None or section not in version.schemas:
        return None
    schema = T.StructType.fromJson(json.loads(version.schemas[section]))
    folders = version.folders[section]
    if layout and layout not in schema.names:
        schema = schema.add(layout, T.DateType())
    if dates is not None:
        wanted = {_date_name(d) for d in dates}
        folders = [f for f in folders if f.rsplit("=", 1)[-1] in wanted]
    if not folders:
        return spark.createDataFrame([], schema)
    root = f"{path}/{section}"
    rows = spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/{f}" for f in folders])
    return rows.select(*[F.col(f"`{name}`") for name in schema.names])


def version_folders(spark: SparkSession, path: str, section: str = DATA) -> list[str]:
    """Full paths of the folders of a section in the current version."""
    version = current(spark, path)
    return [f"{path}/{section}/{f}" for f in version.folders[section]] if version else []


def changed_dates(old: Version | None, new: Version, section: str = DATA) -> list[dt.date | None]:
    """Dates whose folders differ between two versions; all dates without an old one."""
    before, after = (set(v.folders.get(section, [])) if v else set() for v in (old, new))
    names = {f.rsplit("=", 1)[-1] for f in before ^ after}
    return [None if n == NULL_DATE else dt.date.fromisoformat(n) for n in sorted(names)]


def _date_name(date: object) -> str:
    return NULL_DATE if date is None else str(date)


class Load:
    """Writes to one or more sections of a table, committed together."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.base = current(spark, self.path) or Version(0)
        self.folder = f"version={_number(self.base.number + 1)}-{uuid.uuid4().hex[:12]}"
        self.folders = dict(self.base.folders)
        self.schemas = dict(self.base.schemas)
        self.built_from = dict(self.base.built_from)
        self.fingerprint = ""

    def write(
        self,
        df: DataFrame,
        section: str = DATA,
        partition: str | None = None,
        replace: str = "all",
        dates: Iterable = (),
        hidden: bool = False,
        gather: bool = True,
    ) -> None:
        """Write ``df``; of what is stored, ``replace`` (all, dates, none) goes.

        With ``dates`` the dates that ``df`` brings are replaced and those listed, which
        may be empty in ``df``. A ``hidden`` partition column lays out the folders only and is
        no column of the table. Rows that lie by partition already need not be gathered
        (``gather``), which shuffles them.
        """
        if replace not in ("all", "dates", "none"):
            raise ValueError(f"unknown replace: {replace}")
        target = f"{self.path}/{section}/{self.folder}"
        if partition:
            gathered = df.hint("rebalance", F.col(partition)) if gather else df
            writer = gathered.write.option("compression", "zstd").partitionBy(partition)
            with files_at_once(self.spark, 0 if gather else FILES_AT_ONCE), compiled_methods(self.spark):
                writer.parquet(target)
            new = [f"{self.folder}/{n}" for n in _names(self.spark, target) if "=" in n]
        else:
            with compiled_methods(self.spark):
                df.write.option("compression", "zstd").parquet(target)
            new = [self.folder]
        stored = self.folders.get(section, []) if replace != "all" else []
        if replace == "dates":
            gone = {f.rsplit("=", 1)[-1] for f in new} | {_date_name(d) for d in dates}
            stored = [f for f in stored if f.rsplit("=", 1)[-1] not in gone]
        self.folders[section] = stored + new
        self.schemas[section] = (df.drop(partition) if hidden and partition else df).schema.json()

    def written(self, section: str = DATA) -> DataFrame:
        """What this load wrote to a section, of which readers know nothing yet."""
        mine = [f for f in self.folders[section] if f.split("/")[0] == self.folder]
        return read_version(self.spark, self.path, section, Version(0, {section: mine}, self.schemas))

    def commit(self) -> int:
        """Make all that was written the current version; its number is returned."""
        number = self.base.number + 1
        version = Version(number, self.folders, self.schemas, self.built_from, self.fingerprint)
        text = json.dumps(dataclasses.asdict(version))
        written, store = _path(self.spark, f"{self.path}/{MANIFESTS}/.{self.folder}")
        stream = store.create(written, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        target, _ = _path(self.spark, f"{self.path}/{MANIFESTS}/{_number(number)}.json")
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        context = hadoop.FileContext.getFileContext(target.toUri(), self.spark._jsc.hadoopConfiguration())
        no_options = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        try:
            context.rename(context.makeQualified(written), context.makeQualified(target), no_options)
        except Py4JJavaError as error:
            store.delete(written, False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                raise ConcurrentLoad(f"version {number} of {self.path} exists") from error
            raise
        return number


def publish(
    df: DataFrame,
    path: str,
    partition: str | None = None,
    replace: str = "all",
    fingerprint: str = "",
    hidden: bool = False,
    gather: bool = True,
) -> int:
    """Write ``df`` as the next version of a table and make it current."""
    load = Load(df.sparkSession, path)
    load.write(df, partition=partition, replace=replace, hidden=hidden, gather=gather)
    load.fingerprint = fingerprint
    return load.commit()


def expire(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Remove all versions but the newest ``keep`` and the files that no version names.

    Manifests go first: what they named is then unread, and removed now or, after a failure,
    next time. Files of a load under way have a greater number than the current version.
    """
    if keep < 1:
        raise ValueError("one version has to stay")
    known = versions(spark, path)
    if not known:
        return
    for number in known[:-keep]:
        manifest, store = _path(spark, f"{path}/{MANIFESTS}/{_number(number)}.json")
        store.delete(manifest, False)
    kept = [current(spark, path, n) for n in known[-keep:]]
    sections = {s for v in kept for s in v.folders}
    for section in sections:
        named = {f for v in kept for f in v.folders.get(section, [])}
        for folder in _names(spark, f"{path}/{section}"):
            if int(folder.split("=")[1].split("-")[0]) > known[-1]:
                continue
            inner = [f"{folder}/{n}" for n in _names(spark, f"{path}/{section}/{folder}") if "=" in n]
            if folder in named:
                unread = []
            elif any(f in named for f in inner):
                unread = [f for f in inner if f not in named]
            else:
                unread = [folder]
            for place in unread:
                target, store = _path(spark, f"{path}/{section}/{place}")
                store.delete(target, True)
