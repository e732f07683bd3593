"""Bronze text to silver tables, one function per feed, all lazy.

The same functions serve the batch run and each micro-batch of the stream.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.constants import SAFETY_COUNTERS, TRIP_TIME_FORMATS
from milepost.functions.cleaning import (
    fill_missing_text,
    known_as_written,
    null_missing_text,
    squeeze,
    trim_strings,
)
from milepost.functions.parsing import (
    as_date,
    file_date,
    parse_time,
    plain_double,
    to_double,
    to_long,
    to_truncated_long,
)
from milepost.operators.dedup import at_date, latest_per_key
from milepost.operators.quality import QualityError
from milepost.sources.bronze import SOURCE_FILE, file_name, source_files
from milepost.sources.silver import PARTITION

EVENT_DOUBLES = (
    "start_latitude", "start_longitude", "end_latitude", "end_longitude",
    "direction", "speed", "max_speed",
)
TRIP_DOUBLES = (
    "start_latitude", "start_longitude", "end_latitude", "end_longitude",
    "drive_duration", "idle_duration", "mileage", "avg_speed",
    "energy_consumption", "energy_used", "start_energy_level", "end_energy_level",
    "start_soc", "end_soc", "breaking_system",
)


# how each feed writes the date in its file names
DATE_STYLES = dict.fromkeys(("groups", "schemes", "vehicles", "events", "trips"), "loose") | {"drivers": "any_sep"}
FILE_DATE = "_file_date"


def with_file_dates(bronze: DataFrame, path: str, feed: str) -> DataFrame:
    """Rows of the files below ``path`` with the date of their file, as a struct.

    A date is read once for each file of the listing and sent to the rows; otherwise each row works
    it out from its path, which costs more than all its numbers. The cleaning functions use the
    struct and take it away.
    """
    date = F.struct(source_date(DATE_STYLES[feed]).alias("date"))
    files = source_files(bronze.sparkSession, path).select(SOURCE_FILE, date.alias(FILE_DATE))
    return bronze.join(F.broadcast(files), SOURCE_FILE, "left").select(*bronze.columns, FILE_DATE)


def _date_of_row(bronze: DataFrame, feed: str, fallback: Column | None = None) -> Column:
    """``source_date`` by way of the date that a row may carry already."""
    style = DATE_STYLES[feed]
    if FILE_DATE not in bronze.columns:
        return source_date(style, fallback)
    # a file that the listing lacks is read by its path
    date = F.when(F.col(FILE_DATE).isNotNull(), F.col(FILE_DATE)["date"]).otherwise(source_date(style))
    return date if fallback is None else F.coalesce(date, fallback)


def source_date(style: str, fallback: Column | None = None) -> Column:
    """Date of the file a row came from.

    A Spark-written extract is a folder of part files, so a part file without a date
    of its own takes the date of its path.
    """
    path = F.col(SOURCE_FILE)
    own = file_date(file_name(path), style)
    return F.coalesce(own, file_date(path, style), *([fallback] if fallback is not None else []))


def _project(df: DataFrame, normalise, parse: dict, date: Column) -> DataFrame:
    """Normalise the text columns, parse those with a parser, add the source date.

    A parser reads the raw text: it tests the shape of the whole text anyway, and with the
    text rules in front of every number the code of a wide feed outgrows what compiles.
    """
    names = [c for c in df.columns if c not in (SOURCE_FILE, FILE_DATE)]
    columns = [(parse[c](F.col(c)) if c in parse else F.col(c)).alias(c) for c in names]
    plain = [c for c in names if c not in parse]
    return normalise(df, plain).select(*columns, SOURCE_FILE, date.alias(PARTITION))


def _parsers(parser, *names: str) -> dict:
    return dict.fromkeys(names, parser)


def _trimmed(text: Column) -> Column:
    return known_as_written(F.trim(text))


def _a_number(text: Column) -> Column:
    """``nan`` is one of the words for a missing value."""
    return F.when(~text.rlike(r"^\s*(?i:nan)\s*$"), text)


def clean_groups(bronze: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    return _project(
        bronze, fill_missing_text, _parsers(to_long, "group_id", "parent_group_id", "client_id"),
        _date_of_row(bronze, "groups", as_date(as_of)),
    )


def clean_schemes(bronze: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    return _project(
        bronze, fill_missing_text, _parsers(to_long, "scheme_id"), _date_of_row(bronze, "schemes", as_date(as_of))
    )


def clean_vehicles(bronze: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    return _project(
        bronze, null_missing_text,
        _parsers(to_long, "vehicle_id", "group_id", "unit_serial_number"),
        _date_of_row(bronze, "vehicles", as_date(as_of)),
    )


def clean_drivers(bronze: DataFrame) -> DataFrame:
    return _project(
        bronze, fill_missing_text, _parsers(to_long, "driver_id", "group_id", "worker_id"),
        _date_of_row(bronze, "drivers"),
    )


def clean_events(bronze: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    parse = {
        **_parsers(to_long, "event_id", "vehicle_id", "scheme_id", "drive_id"),
        **_parsers(lambda c: plain_double(c, _trimmed), *EVENT_DOUBLES),
        **_parsers(lambda c: to_double(c, _trimmed), "start_mileage", "end_mileage"),
        **_parsers(lambda c: parse_time(c, rule=F.trim), "start_time", "end_time"),
    }
    return _project(bronze, trim_strings, parse, _date_of_row(bronze, "events", as_date(as_of)))


def clean_trips(bronze: DataFrame) -> DataFrame:
    parse = {
        **_parsers(to_long, "drive_id", "vehicle_id", "driver_id"),
        **_parsers(lambda c: parse_time(c, TRIP_TIME_FORMATS, squeeze), "start_drive", "end_drive"),
        **_parsers(lambda c: to_double(c, _a_number), *TRIP_DOUBLES),
        **_parsers(to_truncated_long, *SAFETY_COUNTERS),
    }
    return _project(bronze, null_missing_text, parse, _date_of_row(bronze, "trips"))


NEWEST = (PARTITION, SOURCE_FILE)


def silver_groups(bronze: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Newest row per group."""
    return latest_per_key(clean_groups(bronze, as_of), ["group_id"], NEWEST)


def silver_schemes(bronze: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Newest row per scheme; rows without an id are dropped."""
    return latest_per_key(clean_schemes(bronze, as_of), ["scheme_id"], NEWEST, "drop")


def silver_vehicles(bronze: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Newest row per vehicle."""
    return latest_per_key(clean_vehicles(bronze, as_of), ["vehicle_id"], NEWEST)


def silver_events(bronze: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Newest row per event, by date and then by file."""
    return latest_per_key(clean_events(bronze, as_of), ["event_id"], NEWEST)


def silver_trips(bronze: DataFrame) -> DataFrame:
    """Newest row per drive; rows without a drive id are all kept."""
    return latest_per_key(clean_trips(bronze), ["drive_id"], NEWEST, "keep")


def official_drivers(drivers: DataFrame, trips: DataFrame) -> DataFrame:
    """Drivers of the newest date trips have, one row each, stamped with that date."""
    dated = at_date(drivers, PARTITION, trips, PARTITION)
    newest = latest_per_key(dated, ["driver_id"], [SOURCE_FILE])
    return newest.drop(SOURCE_FILE)


def silver_drivers(bronze: DataFrame, trips: DataFrame) -> DataFrame:
    """Official drivers, or an error when no date or no driver of that date exists."""
    if trips.filter(F.col(PARTITION).isNotNull()).isEmpty():
        raise QualityError("no official date: trips carry no source date")
    drivers = official_drivers(clean_drivers(bronze), trips)
    if drivers.isEmpty():
        raise QualityError("no driver row carries the official date of trips")
    return drivers
