"""Atomic versions, retention and the keyed append over a key index."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from milepost.sources import key_index as K
from milepost.sources import versions as V
from milepost.sources.silver import PARTITION
from tests.conftest import rows
from tests.test_plans import plan


def dated(spark, data, columns="drive_id long, v string"):
    df = spark.createDataFrame(data, f"{columns}, {PARTITION} string")
    return df.withColumn(PARTITION, F.col(PARTITION).cast("date"))


def found(spark, path, section=V.DATA):
    return sorted((r.drive_id, r.v) for r in V.read_version(spark, path, section).collect())


def test_a_failed_load_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    assert V.read_version(spark, path) is None and V.versions(spark, path) == []
    first = dated(spark, [(1, "a", "2026-01-01"), (2, "a", None)])
    assert V.publish(first, path, PARTITION) == 1
    load = V.Load(spark, path)
    load.write(dated(spark, [(9, "x", "2026-01-01")]), partition=PARTITION)
    del load  # dies between write and commit
    assert found(spark, path) == [(1, "a"), (2, "a")]
    assert V.read_version(spark, path).schema == first.schema
    assert V.publish(dated(spark, [(3, "b", "2026-01-01")]), path, PARTITION, "dates") == 2
    assert found(spark, path) == [(2, "a"), (3, "b")]
    old = V.read_version(spark, path, version=V.current(spark, path, 1))
    assert sorted(r.drive_id for r in old.collect()) == [1, 2]


def test_one_of_two_concurrent_loads_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    one, two = V.Load(spark, path), V.Load(spark, path)
    one.write(dated(spark, [(1, "a", "2026-01-01")]), partition=PARTITION)
    two.write(dated(spark, [(2, "b", "2026-01-01")]), partition=PARTITION)
    assert one.commit() == 1
    with pytest.raises(V.ConcurrentLoad):
        two.commit()
    assert found(spark, path) == [(1, "a")]


def test_retention_removes_what_no_version_names(spark, tmp_path):
    path = str(tmp_path / "t")
    V.publish(dated(spark, [(1, "a", "2026-01-01"), (2, "a", "2026-01-02")]), path, PARTITION)
    V.publish(dated(spark, [(3, "b", "2026-01-02")]), path, PARTITION, "dates")
    dead = V.Load(spark, path)
    dead.write(dated(spark, [(7, "x", "2026-01-05")]), partition=PARTITION)
    V.publish(dated(spark, [(4, "c", "2026-01-03")]), path, PARTITION, "none")
    under_way = V.Load(spark, path)
    under_way.write(dated(spark, [(5, "d", "2026-01-04")]), partition=PARTITION, replace="none")
    V.expire(spark, path)
    assert V.versions(spark, path) == [3]
    assert found(spark, path) == [(1, "a"), (3, "b"), (4, "c")]
    left = sorted(str(p.relative_to(tmp_path / "t" / "data")).split("/")[-1] for p in (tmp_path / "t" / "data").glob("*/*=*"))
    assert left == [f"{PARTITION}=2026-01-0{d}" for d in (1, 2, 3, 4)]
    assert under_way.commit() == 4
    assert (5, "d") in found(spark, path)
    with pytest.raises(ValueError):
        V.current(spark, path, 1)
    with pytest.raises(ValueError):
        V.expire(spark, path, 0)


def test_empty_and_unpartitioned_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    empty = spark.range(0)
    V.publish(empty, path)
    assert V.read_version(spark, path).count() == 0
    V.publish(spark.range(5), path)
    assert V.read_version(spark, path).count() == 5
    V.expire(spark, path)
    assert V.read_version(spark, path).count() == 5
    V.publish(dated(spark, []), path + "2", PARTITION)
    assert V.read_version(spark, path + "2").columns == ["drive_id", "v", PARTITION]


def keys_by_day(spark, days=20, per_day=3000):
    return spark.range(days * per_day).select(
        F.col("id").alias("drive_id"), F.lit("a").alias("v"),
        F.date_add(F.lit(dt.date(2026, 1, 1)), (F.col("id") / per_day).cast("int")).alias(PARTITION),
    )


def test_index_finds_every_stored_key(spark):
    stored = keys_by_day(spark, 4)
    index = K.summarise_keys(stored, "drive_id").cache()
    assert index.count() > 4  # dates beyond one block have several
    for key in (0, 2999, 3000, 7777, 11999):
        day = dt.date(2026, 1, 1) + dt.timedelta(key // 3000)
        assert K.dates_that_may_hold(index, spark.range(key, key + 1).toDF("drive_id"), "drive_id") == [day]
    every = K.dates_that_may_hold(index, stored.sample(0.05, 1), "drive_id")
    assert len(every) == 4


def test_keys_are_shuffled_and_not_the_bits_of_their_blocks(spark):
    """A task holds a few keys of every block: its bits would be as many times the index."""
    text = plan(K.summarise_keys(keys_by_day(spark, 4), "drive_id"), "formatted")
    shuffled = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]\nArguments: hashpartitioning\(_date\S+, block", text)
    assert shuffled and not any("buf" in columns for columns in shuffled)


def test_filter_tells_absent_keys_inside_the_bounds(spark):
    even = keys_by_day(spark, 3).withColumn("drive_id", F.col("drive_id") * 2)
    index = K.summarise_keys(even, "drive_id")
    odd = [2 * i + 1 for i in range(0, 9000, 45)]
    tested = spark.createDataFrame([(k,) for k in odd], "drive_id long")
    blocks = index.crossJoin(F.broadcast(tested.toDF("_key"))).where(K._may_hold(F.col("_key"))).count()
    assert blocks < 10  # of 200 absent keys


def test_append_reads_only_dates_that_may_hold_a_key(spark, tmp_path):
    path = str(tmp_path / "t")
    K.append_indexed(spark, keys_by_day(spark), path, "drive_id")
    version = V.current(spark, path)
    again = keys_by_day(spark).where(F.col("drive_id").isin(4, 30_001) | (F.col("drive_id") < 0)).unionByName(
        dated(spark, [(10**9, "new", "2026-01-02")]))
    left = K.unseen_keys(spark, again, path, "drive_id", version)
    assert [r.drive_id for r in left.collect()] == [10**9]
    days = {f.split(f"{PARTITION}=")[1][:10] for f in left.inputFiles() if path in f}
    assert days == {"2026-01-01", "2026-01-11"}
    K.append_indexed(spark, again, path, "drive_id")
    assert K.read_indexed(spark, path).count() == 60_001
    K.append_indexed(spark, again, path, "drive_id")
    assert K.read_indexed(spark, path).count() == 60_001


def test_many_keys_go_by_bounds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(K, "TESTED_KEYS", 10)
    path = str(tmp_path / "t")
    K.append_indexed(spark, keys_by_day(spark, 5), path, "drive_id")
    K.append_indexed(spark, keys_by_day(spark, 7).where("drive_id > 11000"), path, "drive_id")
    assert rows(K.read_indexed(spark, path)) == rows(keys_by_day(spark, 7))


def test_rows_without_key_go_by_their_file(spark, tmp_path):
    path = str(tmp_path / "t")

    def load(*data):
        K.append_indexed(spark, dated(spark, list(data), "drive_id long, v string, file string"), path, "drive_id", origin="file")
        return sorted((r.drive_id or 0, r.v) for r in K.read_indexed(spark, path).collect())

    day, other = "2026-01-01", "2026-01-02"
    assert load((1, "k", "f1", day), (None, "a", "f1", day), (None, "b", "f2", other)) == [(0, "a"), (0, "b"), (1, "k")]
    # a second file of a date, when the first has left the bronze folder
    assert load((None, "c", "f3", day), (1, "again", "f3", day)) == [(0, "a"), (0, "b"), (0, "c"), (1, "k")]
    # the first file once more, changed
    assert load((None, "d", "f1", day), (2, "k", "f1", day)) == [(0, "b"), (0, "c"), (0, "d"), (1, "k"), (2, "k")]
    # a file whose rows all have keys by now, and one without date
    assert load((3, "k", "f3", day), (None, "n", "f4", None)) == [(0, "b"), (0, "d"), (0, "n"), (1, "k"), (2, "k"), (3, "k")]
    K.replace_indexed(spark, dated(spark, [(5, "r", "f", day), (None, "s", "f", day)], "drive_id long, v string, file string"), path, "drive_id")
    assert sorted(r.v for r in K.read_indexed(spark, path).collect()) == ["r", "s"]
    assert K.read_indexed(spark, str(tmp_path / "none")) is None
