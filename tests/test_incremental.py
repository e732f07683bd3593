"""Incremental refresh of rollups and marts against a full one."""

import dataclasses
import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from milepost.plans import incremental as I
from milepost.plans.marts import MARTS, MATERIALIZED
from milepost.session import write_once
from milepost.sources import versions as V
from milepost.sources.projection import AS_OF
from milepost.sources.silver import PARTITION
from tests.conftest import rows


TRIP_NUMBERS = (
    "mileage", "energy_used", "turn1", "turn2", "turn3", "break1", "break2", "break3", "acceleration1", "acceleration2",
    "acceleration3", "speed_road1", "speed_road2", "speed_road3", "engine", "gearbox", "idle_duration",
)


def shared(spark):
    return [p.name for p in Path(spark.conf.get("spark.checkpoint.dir")).iterdir()]


def by_quarter(df, column):
    return df.withColumn(PARTITION, F.trunc(F.col(column), "quarter"))


@pytest.fixture(scope="module")
def refreshed(spark, fleet, tmp_path_factory):
    """Facts with a first load, then three changed dates, and what the refresh read."""
    root = str(tmp_path_factory.mktemp("incremental"))
    # an event follows its trip within 100 days, as it does in a fleet
    starts = fleet.trips.select("drive_id", F.col("start_drive").alias("_start")).filter("_start IS NOT NULL")
    later = F.date_add("_start", (F.col("event_id") % 100).cast("int")).cast("timestamp")
    near = fleet.events.join(starts, "drive_id").withColumn("start_time", later).select(*fleet.events.columns)
    fleet = dataclasses.replace(fleet, events=write_once(near, "near-events"))
    trips, events = by_quarter(fleet.trips, "start_drive"), by_quarter(fleet.events, "start_time")
    late, gone, changed = dt.date(1995, 4, 1), dt.date(1996, 1, 1), dt.date(1997, 1, 1)
    first_trips = trips.filter(~F.col(PARTITION).eqNullSafe(F.lit(late))).withColumn(
        "driver_id", F.when(F.col(PARTITION) == F.lit(changed), F.lit(1)).otherwise(F.col("driver_id")))
    first_events = events.filter(F.col(PARTITION) != F.lit(late))
    I.load_fact(first_trips, f"{root}/trips")
    I.load_fact(first_events, f"{root}/events")
    I.refresh_rollups(spark, f"{root}/trips", f"{root}/events", f"{root}/marts/rollups")
    # trips that come after their events, a quarter with other drivers, a quarter without rows
    I.load_fact(trips.filter(F.col(PARTITION).isin(late, changed)), f"{root}/trips", [gone])
    I.load_fact(events.filter(F.col(PARTITION) == F.lit(late)), f"{root}/events")
    read = I.refresh_rollups(spark, f"{root}/trips", f"{root}/events", f"{root}/marts/rollups")
    kept = trips.filter(~F.col(PARTITION).eqNullSafe(F.lit(gone))).drop(PARTITION)
    return root, dataclasses.replace(fleet, trips=kept), read


def comparable(df):
    return rows(df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]))


@pytest.mark.parametrize("name", MATERIALIZED)
def test_mart_equals_a_full_refresh(refreshed, name):
    root, full, _ = refreshed
    shared = I.with_rollups(full, f"{root}/marts/rollups")
    assert comparable(MARTS[name](shared, AS_OF)) == comparable(MARTS[name](full, AS_OF))


def test_facts_of_other_dates_are_not_read(spark, refreshed):
    root, _, read = refreshed
    stored = {name: V.changed_dates(None, V.current(spark, f"{root}/{name}")) for name in ("trips", "events")}
    assert {dt.date(1995, 4, 1), dt.date(1997, 1, 1)} <= set(read["trips"])
    for name in ("trips", "events"):
        assert len(read[name]) < len(stored[name]) / 2
    # changed trips are of three quarters, so their events are of these and of the next two
    assert all(d is not None and d.year in (1995, 1996, 1997) for d in read["events"])
    again = I.refresh_rollups(spark, f"{root}/trips", f"{root}/events", f"{root}/marts/rollups")
    assert again == {"trips": [], "events": []}


def test_refresh_publishes_marts(spark, refreshed):
    root, full, _ = refreshed
    names = ["mv_vehicle_health", "mv_fleet_safety_monthly"]
    paths = I.refresh_changed(full, f"{root}/trips", f"{root}/events", f"{root}/marts", names, AS_OF)
    for name in names:
        assert comparable(spark.read.parquet(paths[name])) == comparable(MARTS[name](full, AS_OF))


def test_all_dates_are_read_when_the_version_before_is_gone(spark, refreshed):
    root, full, _ = refreshed
    I.load_fact(by_quarter(full.trips, "start_drive").filter(F.col(PARTITION) == F.lit(dt.date(1994, 1, 1))), f"{root}/trips")
    V.expire(spark, f"{root}/trips")
    read = I.refresh_rollups(spark, f"{root}/trips", f"{root}/events", f"{root}/marts/rollups")
    assert read["trips"] == sorted(V.changed_dates(None, V.current(spark, f"{root}/trips")), key=str)
    shared = I.with_rollups(full, f"{root}/marts/rollups")
    assert comparable(MARTS["mv_fleet_safety_monthly"](shared, AS_OF)) == comparable(MARTS["mv_fleet_safety_monthly"](full, AS_OF))


def test_facts_are_stored_once_and_rollups_lie_by_date(spark, tmp_path, monkeypatch):
    """Loads keep no copy beside the table; a date of a rollup has no more files than its rows are worth."""
    monkeypatch.setattr(I, "ROWS_PER_PART", 100)
    day = F.date_add(F.lit(dt.date(2026, 1, 1)), (F.col("id") % 3).cast("int"))
    stamp = day.cast("timestamp_ntz")
    base = spark.range(1500)
    trips = base.select(
        F.col("id").alias("drive_id"), (F.col("id") % 7).alias("vehicle_id"), (F.col("id") % 50).alias("driver_id"),
        stamp.alias("start_drive"), stamp.alias("end_drive"),
        *[F.lit(1).alias(c) for c in TRIP_NUMBERS], F.when(F.col("id") % 100 != 5, day).alias(PARTITION))
    events = base.select(
        (F.col("id") % 400).alias("drive_id"), (F.col("id") % 7).alias("vehicle_id"), F.lit(3).alias("scheme_id"),
        stamp.alias("start_time"), day.alias(PARTITION))
    before = set(shared(spark))
    I.load_fact(trips, f"{tmp_path}/trips")
    I.load_fact(events, f"{tmp_path}/events")
    assert set(shared(spark)) == before
    I.refresh_rollups(spark, f"{tmp_path}/trips", f"{tmp_path}/events", f"{tmp_path}/rollups")
    stored = {s: V.read_version(spark, f"{tmp_path}/rollups", s) for s in (I.TRIPS, I.EVENTS, I.SIGHTINGS)}
    assert stored[I.TRIPS].agg(F.sum("points")).first()[0] is not None
    assert stored[I.EVENTS].agg(F.sum("n")).first()[0] == 1500
    assert rows(stored[I.SIGHTINGS]) == rows(I.sightings(events, PARTITION).select(*stored[I.SIGHTINGS].columns))
    assert all(len(df.inputFiles()) <= 4 * 5 for df in stored.values())
