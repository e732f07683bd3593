"""Column names of the raw feeds and typed schemas of the warehouse tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from milepost.constants import SAFETY_COUNTERS


def _text_feed(columns: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns.split()])


# Raw CSV columns: always read as text, so that cleaning never depends on the data.
BRONZE = {
    "drivers": _text_feed("driver_id driver_name group_id driver_code worker_id"),
    "groups": _text_feed(
        "group_id group_name parent_group_id parent_group_name client_id external_id"
    ),
    "schemes": _text_feed("scheme_id scheme_description description parent_scheme scheme_type"),
    "vehicles": _text_feed(
        "vehicle_id license_number group_id manufacturer model unit_serial_number vin "
        "vehicle_engine_type body_configuration"
    ),
    "events": _text_feed(
        "event_id vehicle_id scheme_id drive_id start_time start_location start_latitude "
        "start_longitude direction start_mileage end_time end_location end_latitude "
        "end_longitude end_mileage speed max_speed"
    ),
    "trips": _text_feed(
        "drive_id vehicle_id driver_id start_drive start_location start_latitude "
        "start_longitude end_drive end_location end_latitude end_longitude drive_duration "
        "idle_duration mileage avg_speed " + " ".join(SAFETY_COUNTERS) + " "
        "energy_consumption breaking_system gearbox engine clutch_system "
        "start_energy_level end_energy_level energy_used start_soc end_soc"
    ),
}

_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "ts": T.TimestampNTZType(),
    "date": T.DateType(),
}


def _typed(**groups: str) -> dict[str, T.DataType]:
    return {name: _TYPES[kind] for kind, names in groups.items() for name in names.split()}


def _table(order: str, **groups: str) -> T.StructType:
    types = _typed(**groups)
    return T.StructType([T.StructField(name, types[name]) for name in order.split()])


WAREHOUSE = {
    "d_drivers": _table(
        "driver_id driver_name group_id driver_code worker_id p_source_date",
        long="driver_id group_id worker_id",
        string="driver_name driver_code",
        date="p_source_date",
    ),
    "d_groups": _table(
        "group_id group_name parent_group_id parent_group_name client_id p_source_date external_id",
        long="group_id parent_group_id client_id",
        string="group_name parent_group_name external_id",
        date="p_source_date",
    ),
    "d_schemes": _table(
        "scheme_id scheme_description description parent_scheme scheme_type p_load_date "
        "p_source_date",
        long="scheme_id",
        string="scheme_description description parent_scheme scheme_type",
        date="p_load_date p_source_date",
    ),
    "d_vehicles": _table(
        " ".join(BRONZE["vehicles"].names)
        + " p_source_date",
        long="vehicle_id group_id unit_serial_number",
        string="license_number manufacturer model vin vehicle_engine_type body_configuration",
        date="p_source_date",
    ),
    "t_events": _table(
        "sk_event " + " ".join(BRONZE["events"].names) + " p_source_date p_load_date",
        long="sk_event event_id vehicle_id scheme_id drive_id",
        ts="start_time end_time",
        string="start_location end_location",
        double="start_latitude start_longitude direction start_mileage end_latitude "
        "end_longitude end_mileage speed max_speed",
        date="p_source_date p_load_date",
    ),
    "t_trips": _table(
        " ".join(BRONZE["trips"].names) + " p_source_date",
        long="drive_id vehicle_id driver_id",
        ts="start_drive end_drive",
        string="start_location end_location",
        double="start_latitude start_longitude end_latitude end_longitude drive_duration "
        "idle_duration mileage avg_speed start_energy_level end_energy_level energy_used "
        "start_soc end_soc",
        int=" ".join(SAFETY_COUNTERS)
        + " energy_consumption breaking_system gearbox engine clutch_system",
        date="p_source_date",
    ),
    "d_event_dictionary": _table(
        "parametro categoria impacto_resumido acao_recomendada_final peso_impacto",
        string="parametro categoria impacto_resumido acao_recomendada_final",
        double="peso_impacto",
    ),
    "parametro_base": _table(
        "parametro categoria peso_impacto acao_recomendada_final",
        string="parametro categoria acao_recomendada_final",
        int="peso_impacto",
    ),
}

# Declared keys: table -> key column, and (table, column) -> (referenced table, column).
PRIMARY_KEYS = {
    "d_drivers": "driver_id",
    "d_groups": "group_id",
    "d_schemes": "scheme_id",
}
FOREIGN_KEYS = {("t_events", "scheme_id"): ("d_schemes", "scheme_id")}


@dataclass(frozen=True)
class Fleet:
    """The star schema every mart is built from.

    ``trip_rollup``, ``event_rollup`` and ``sightings`` are optional stored aggregates of the
    facts (see ``operators.rollups``), which may hold a key in several partial rows; with them
    a mart never touches the raw facts.
    """

    trips: DataFrame
    events: DataFrame
    drivers: DataFrame
    groups: DataFrame
    vehicles: DataFrame
    schemes: DataFrame
    event_dictionary: DataFrame
    parameters: DataFrame
    trip_rollup: DataFrame | None = None
    event_rollup: DataFrame | None = None
    sightings: DataFrame | None = None
