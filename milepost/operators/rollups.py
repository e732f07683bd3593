"""Facts rolled up before any dimension is joined.

Trips and events carry few distinct (vehicle, driver, scheme, month) combinations
compared with their rows. Counting and adding up per combination first has three
effects: the map side already combines rows, a vehicle or driver holding a large
share of the facts shrinks to its combinations, and every later join handles the
rollup instead of the facts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from milepost.functions.metrics import safety_points
from milepost.functions.parsing import month_start
from milepost.schemas import Fleet

TRIP_KEYS = ("vehicle_id", "driver_id", "start_month", "end_month")
TRIP_MEASURES = (
    "points", "mileage", "energy_used",
    "engine", "speed_road3", "acceleration3", "idle_duration", "gearbox",
)
EXACT_PLACES = 6
EVENT_KEYS = ("driver_id", "scheme_id", "vehicle_id", "trip_month", "event_month")


# month -> the timestamp it comes from, whose null test can reach the scan
MONTH_OF = {
    "start_month": "start_drive", "end_month": "end_drive",
    "trip_month": "start_drive", "event_month": "start_time",
}
OF_TRIP = ("driver_id", "trip_month")  # rollup columns of an event that its trip provides


def known_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    for column in columns:
        df = df.filter(F.col(column).isNotNull())
    return df


def _known_raw(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Raw facts with all of the rollup columns set."""
    return known_rows(df, [MONTH_OF.get(c, c) for c in columns])


def trip_rows(trips: DataFrame, *extra: str) -> DataFrame:
    """Trips as rollup rows: keys, months and measures, and ``extra`` columns."""
    return trips.select(
        *extra,
        "vehicle_id",
        "driver_id",
        month_start(F.col("start_drive")).alias("start_month"),
        month_start(F.col("end_drive")).alias("end_month"),
        safety_points().alias("points"),
        *[_exact(trips, m) for m in TRIP_MEASURES[1:]],
    )


def _exact(df: DataFrame, measure: str) -> Column:
    """Doubles as decimals: their sums do not depend on the order of the rows.

    What no decimal can hold, NaN among it, is unknown.
    """
    if isinstance(df.schema[measure].dataType, T.DoubleType | T.FloatType):
        return F.col(measure).try_cast(f"decimal(24,{EXACT_PLACES})").alias(measure)
    return F.col(measure)


def add_up(rows: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sum of each measure per key; a measure unknown throughout stays NULL."""
    return rows.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def trip_totals(
    fleet: Fleet,
    keys: Sequence[str],
    measures: Sequence[str],
    known: Sequence[str] = (),
) -> DataFrame:
    """Trip measures per ``keys`` over the rows where all ``known`` columns are set."""
    if fleet.trip_rollup is not None:
        rows = known_rows(fleet.trip_rollup, known)
    else:
        rows = trip_rows(_known_raw(fleet.trips, known))
    return add_up(rows, keys, measures)


def trip_rollup(fleet: Fleet) -> DataFrame:
    """The rollup all trip marts can share."""
    return add_up(trip_rows(fleet.trips), TRIP_KEYS, TRIP_MEASURES)


def event_trip_rows(
    events: DataFrame, trips: DataFrame, labels: DataFrame | None = None, extra: Sequence[str] = ()
) -> DataFrame:
    """Events with the driver of their trip, both sides narrowed before the shuffle.

    This is the only join of two facts. It is left to sort-merge: an event-heavy
    ``drive_id`` is split at run time by the adaptive skew join, and events of schemes
    without a label leave before it.
    """
    ev = events.select(
        *extra, "drive_id", "vehicle_id", "scheme_id",
        month_start(F.col("start_time")).alias("event_month"),
    )
    if labels is not None:
        ev = ev.join(labels.select("scheme_id"), "scheme_id", "left_semi")
    tr = trips.select(
        "drive_id", "driver_id", month_start(F.col("start_drive")).alias("trip_month")
    )
    return ev.join(tr, "drive_id")


def event_counts(
    fleet: Fleet,
    keys: Sequence[str],
    labels: DataFrame | None = None,
    known: Sequence[str] = (),
) -> DataFrame:
    """Events of trips counted per ``keys`` as ``n``.

    ``labels`` maps ``scheme_id`` to columns that may be used as keys; events of
    schemes it does not list are left out.
    """
    if fleet.event_rollup is not None:
        rows, count = known_rows(fleet.event_rollup, known), F.sum("n")
    else:
        rows = event_trip_rows(
            _known_raw(fleet.events, [c for c in known if c not in OF_TRIP]),
            _known_raw(fleet.trips, [c for c in known if c in OF_TRIP]),
            labels,
        )
        count = F.count(F.lit(1))
    if labels is None:
        return rows.groupBy(*keys).agg(count.alias("n"))
    # labels meet counts: no text travels with the facts, however many labels a scheme has
    own = [k for k in keys if k == "scheme_id" or k not in labels.columns]
    counts = rows.groupBy(*dict.fromkeys([*own, "scheme_id"])).agg(count.alias("n"))
    return counts.join(labels, "scheme_id").groupBy(*keys).agg(F.sum("n").alias("n"))


def sightings(events: DataFrame, *extra: str) -> DataFrame:
    """Events of each vehicle and scheme counted, with the time of the last one."""
    return events.groupBy(*extra, "vehicle_id", "scheme_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("start_time").alias("last_time")
    )


def event_rollup(fleet: Fleet) -> DataFrame:
    """The rollup all event marts can share."""
    return event_trip_rows(fleet.events, fleet.trips).groupBy(*EVENT_KEYS).agg(
        F.count(F.lit(1)).alias("n")
    )
