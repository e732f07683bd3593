"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"

DEFAULTS = {
    # Wall-clock timestamps and a fixed zone: results do not depend on the host.
    "spark.sql.session.timeZone": "UTC",
    # Size-based runtime planning: small dimensions are broadcast once their real
    # size is known, hot join keys are split, tiny partitions are merged.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # HotSpot does not compile methods beyond 8000 bytes. Cleaning a feed of forty
    # columns exceeds that as one fused method, so such stages run operator by operator.
    METHOD_LIMIT: "8000",
}


SHUFFLE_BYTES_PER_TASK = 128 * 1024 * 1024


def shuffle_partitions(bytes_shuffled: int, at_least: int = 200) -> int:
    """Initial shuffle partitions that keep a task near 128 MiB.

    Adaptive execution merges partitions that turn out small but never splits an even
    one, so the initial number has to fit the largest shuffle.
    """
    return max(at_least, -(-bytes_shuffled // SHUFFLE_BYTES_PER_TASK))


def partitions_of_rows(spark: SparkSession, rows: int, rows_per_task: int = 1_000_000) -> int:
    """Shuffle partitions, the session's at least, that keep a task near so many rows."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_task))


def build_session(app_name: str = "milepost", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the package defaults; keyword options use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    options = {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh place below ``spark.checkpoint.dir``, which every executor can reach.

    It is deleted when the driver ends: results that are computed later may read it until
    then. A machine-local folder is used only by a local session that names none.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="milepost-")
        spark.conf.set(CHECKPOINT_DIR, root)
    parent = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(parent)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(folder)
    store.deleteOnExit(folder)
    return f"{parent}/data"


@contextmanager
def _setting(spark: SparkSession, key: str, value: object) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def files_at_once(spark: SparkSession, number: int) -> AbstractContextManager[None]:
    """Let a task write up to so many files side by side; beyond them it sorts its rows by file."""
    return _setting(spark, WRITERS, number)


def compiled_methods(spark: SparkSession) -> AbstractContextManager[None]:
    """Fuse no operators into methods that HotSpot leaves uncompiled, also in sessions without the defaults."""
    most = min(int(spark.conf.get(METHOD_LIMIT)), int(DEFAULTS[METHOD_LIMIT]))
    return _setting(spark, METHOD_LIMIT, most)


def write_once(df: DataFrame, purpose: str) -> DataFrame:
    """Store ``df`` as Parquet, packed hard, in the shared folder and read it back.

    Cuts the lineage with files that outlive executors, so that every later
    branch sees the very same rows and the facts are not read again.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    with compiled_methods(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
