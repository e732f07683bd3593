"""All marts by name, and storing the refreshed ones."""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Iterable

from pyspark.sql import SparkSession

from milepost.operators.rollups import event_rollup, sightings, trip_rollup
from milepost.plans import behaviour, economy, parameters, safety
from milepost.schemas import Fleet
from milepost.sources.fingerprints import is_finished
from milepost.sources.versions import Load, expire, publish, read_version, version_folders

# stored on every refresh
MATERIALIZED = {
    "mv_driver_errors": behaviour.mv_driver_errors,
    "mv_driver_top_offenders": behaviour.mv_driver_top_offenders,
    "mv_pedal_events": behaviour.mv_pedal_events,
    "mv_fleet_economy_comparison": economy.mv_fleet_economy_comparison,
    "mv_driver_contribution": economy.mv_driver_contribution,
    "mv_economy_offenders": economy.mv_economy_offenders,
    "mv_fleet_safety_monthly": safety.mv_fleet_safety_monthly,
    "mv_safety_offenders": behaviour.mv_safety_offenders,
    "mv_group_main_driver": safety.mv_group_main_driver,
    "mv_group_safety_base": safety.mv_group_safety_base,
    "mv_driver_ranking": behaviour.mv_driver_ranking,
    "mv_vehicle_health": behaviour.mv_vehicle_health,
}

# computed when asked for
VIEWS = {
    "v_driver_keymap": economy.v_driver_keymap,
    "v_parameter_dictionary": parameters.v_parameter_dictionary,
    "v_event_parameters": parameters.v_event_parameters,
    "v_driver_event_parameters": behaviour.v_driver_event_parameters,
    "v_driver_economy_monthly": economy.v_driver_economy_monthly,
    "v_driver_safety_score_monthly": safety.v_driver_safety_score_monthly,
    "v_fleet_economy_monthly": economy.v_fleet_economy_monthly,
    "v_group_economy_summary": economy.v_group_economy_summary,
    "v_group_safety_summary": safety.v_group_safety_summary,
}

MARTS = {**MATERIALIZED, **VIEWS}


def store_rollups(
    spark: SparkSession, fleet: Fleet, out: str, fingerprint: str = "", resume: bool = False
) -> Fleet:
    """Store the rollups of the facts as one version and return a fleet that uses them.

    One scan of the trips, one of the events and one join of both then serve all marts. With
    ``resume`` stored rollups with this fingerprint are used as they are.
    """
    if not (resume and is_finished(spark, f"{out}/rollups", fingerprint)):
        load = Load(spark, f"{out}/rollups")
        load.write(trip_rollup(fleet), "trips")
        load.write(event_rollup(fleet), "events")
        load.write(sightings(fleet.events), "sightings")
        load.fingerprint = fingerprint
        load.commit()
        expire(spark, f"{out}/rollups", keep=2)
    trips, events, seen = (read_version(spark, f"{out}/rollups", s) for s in ("trips", "events", "sightings"))
    return dataclasses.replace(fleet, trip_rollup=trips, event_rollup=events, sightings=seen)


def refresh_marts(
    spark: SparkSession,
    fleet: Fleet,
    out: str,
    names: Iterable[str] = tuple(MATERIALIZED),
    as_of: dt.date | None = None,
    fingerprint: str = "",
    resume: bool = False,
) -> dict[str, str]:
    """Publish the named marts below ``out`` and return the folders of their current versions.

    With ``resume`` marts that carry this fingerprint already are left as they are.
    """
    names = tuple(names)
    left = [n for n in names if not (resume and is_finished(spark, f"{out}/{n}", fingerprint))]
    if left:
        shared = store_rollups(spark, fleet, out, fingerprint, resume)
    for name in left:
        publish(MARTS[name](shared, as_of), f"{out}/{name}", fingerprint=fingerprint)
    return {name: version_folders(spark, f"{out}/{name}")[0] for name in names}


def create_views(fleet: Fleet, names: Iterable[str] = tuple(VIEWS), as_of: dt.date | None = None) -> None:
    """Register views under their names for use in SQL."""
    for name in names:
        MARTS[name](fleet, as_of).createOrReplaceTempView(name)
