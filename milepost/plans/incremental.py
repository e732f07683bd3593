"""Incremental refresh: marts after a load, reading the facts of changed dates only.

Facts are versioned tables by source date with an index of their drive ids. Three rollups are
kept per source date, as partial sums, counts and maxima: a changed date replaces its partial
rows, so its old share goes out and its new one comes in. What changed is read off the
folders that differ between two versions. An event takes its driver from its trip, which
may be of another date, hence two lookups in the indexes:

* events of unchanged dates are counted again if their trip may be among the changed ones;
* trips are read for the dates only that may hold a trip of the events counted.

Marts add the partial rows up. They are computed from rollups and dimensions, whose size does not
follow the number of facts, and published as versions.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.operators.rollups import EVENT_KEYS, TRIP_KEYS, TRIP_MEASURES, add_up, event_trip_rows, sightings, trip_rows
from milepost.plans.marts import MARTS, MATERIALIZED
from milepost.schemas import Fleet
from milepost.session import partitions_of_rows
from milepost.sources.key_index import KEYS, dates_that_may_hold, summarise_keys, with_parts
from milepost.sources.silver import PARTITION
from milepost.sources.versions import DATA, Load, changed_dates, current, publish, read_version, version_folders, versions

TRIPS, EVENTS, SIGHTINGS = "trips", "events", "sightings"
SEEN_KEYS = ("vehicle_id", "scheme_id")
PART, PARTS, ROWS_PER_PART = "_part", "_parts", 500_000


def load_fact(rows: DataFrame, path: str, dates: Iterable[dt.date | None] = ()) -> int:
    """Replace the dates that ``rows`` bring, and the listed ones, with their drive index."""
    load = Load(rows.sparkSession, path)
    load.write(rows, DATA, PARTITION, "dates", dates)
    load.write(summarise_keys(load.written(DATA), "drive_id"), KEYS, PARTITION, "dates", dates)
    return load.commit()


def _changes(spark: SparkSession, path: str, since: int | None) -> list[dt.date | None]:
    """Changed dates of a fact table; all of them if the version before is gone or there is none."""
    known = since is not None and since in versions(spark, path)
    return changed_dates(current(spark, path, since) if known else None, current(spark, path))


def _placed(rows: DataFrame, keys: Sequence[str], partitions: int) -> DataFrame:
    """Rows shuffled once by date and part, as their sums are both formed and written."""
    part = F.pmod(F.xxhash64(*keys), F.col(PARTS).cast("long")).cast("int")
    return rows.withColumn(PART, part).drop(PARTS).repartition(partitions, PARTITION, PART)


def refresh_rollups(spark: SparkSession, trips: str, events: str, out: str) -> dict[str, list[dt.date | None]]:
    """Bring the rollups at ``out`` up to the current facts at ``trips`` and ``events``.

    Returns the dates of either fact whose rows were read. The version of a fact that the last
    refresh used has to be kept until then; otherwise all dates are read.
    """
    load = Load(spark, out)
    since = load.base.built_from
    trip_dates, event_dates = _changes(spark, trips, since.get(TRIPS)), _changes(spark, events, since.get(EVENTS))
    changed_trips = read_version(spark, trips, dates=trip_dates)
    if since and since.get(TRIPS) in versions(spark, trips):
        before = read_version(spark, trips, version=current(spark, trips, since[TRIPS]), dates=trip_dates)
        moved = changed_trips.select("drive_id").unionByName(before.select("drive_id"))
        touched = dates_that_may_hold(read_version(spark, events, KEYS), moved, "drive_id")
        event_dates = sorted({*event_dates, *touched}, key=str)
    counted = read_version(spark, events, dates=event_dates)
    # the first refresh counts all events, for which it reads all trips
    needed = dates_that_may_hold(read_version(spark, trips, KEYS), counted, "drive_id") if since else trip_dates
    sized = with_parts(counted, PARTITION, ROWS_PER_PART, PARTS)
    joined = event_trip_rows(sized, read_version(spark, trips, dates=needed), extra=[PARTITION, PARTS])
    n_trips, n_events = (partitions_of_rows(spark, rows.count(), ROWS_PER_PART) for rows in (changed_trips, counted))
    of_events = _placed(joined, EVENT_KEYS, n_events)
    of_trips = _placed(trip_rows(with_parts(changed_trips, PARTITION, ROWS_PER_PART, PARTS), PARTITION, PARTS), TRIP_KEYS, n_trips)
    seen = _placed(sized.select(PARTITION, PARTS, *SEEN_KEYS, "start_time"), SEEN_KEYS, n_events)
    parts = {
        TRIPS: (add_up(of_trips, (PARTITION, PART, *TRIP_KEYS), TRIP_MEASURES), trip_dates),
        EVENTS: (of_events.groupBy(PARTITION, PART, *EVENT_KEYS).agg(F.count(F.lit(1)).alias("n")), event_dates),
        SIGHTINGS: (sightings(seen, PARTITION, PART), event_dates),
    }
    for section, (rows, dates) in parts.items():
        load.write(rows.drop(PART), section, PARTITION, "dates" if since else "all", dates, gather=False)
    load.built_from = {TRIPS: current(spark, trips).number, EVENTS: current(spark, events).number}
    load.commit()
    return {TRIPS: sorted({*trip_dates, *needed}, key=str), EVENTS: event_dates}


def with_rollups(fleet: Fleet, rollups: str) -> Fleet:
    """A fleet whose marts read the stored rollups."""
    spark = fleet.drivers.sparkSession
    version = current(spark, rollups)
    trips, events, seen = (read_version(spark, rollups, s, version).drop(PARTITION) for s in (TRIPS, EVENTS, SIGHTINGS))
    return dataclasses.replace(fleet, trip_rollup=trips, event_rollup=events, sightings=seen)


def refresh_changed(
    fleet: Fleet,
    trips: str,
    events: str,
    out: str,
    names: Iterable[str] = tuple(MATERIALIZED),
    as_of: dt.date | None = None,
) -> dict[str, str]:
    """Refresh rollups and marts below ``out`` and return the folders of the marts."""
    spark = fleet.drivers.sparkSession
    refresh_rollups(spark, trips, events, f"{out}/rollups")
    shared, paths = with_rollups(fleet, f"{out}/rollups"), {}
    for name in names:
        publish(MARTS[name](shared, as_of), f"{out}/{name}")
        (paths[name],) = version_folders(spark, f"{out}/{name}")
    return paths
