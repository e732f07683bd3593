"""Silver tables to warehouse tables: fixed columns, fixed types, keyed rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from milepost.functions.parsing import as_date, plain_double, to_long
from milepost.schemas import WAREHOUSE


def _convert(source: T.DataType, column: Column, target: T.DataType) -> Column:
    """Lossy values become NULL; a double bound for a whole-number column is rounded."""
    if isinstance(target, T.IntegerType | T.LongType):
        if isinstance(source, T.StringType):
            if isinstance(target, T.LongType):
                return to_long(column)
            return F.round(plain_double(column)).try_cast(target)
        if isinstance(source, T.DoubleType | T.FloatType):
            return F.round(column).try_cast(target)
    return column.try_cast(target)


def conform(
    df: DataFrame,
    table: str,
    key: str | None = None,
    computed: dict[str, Column] | None = None,
    lengths: dict[str, int] | None = None,
) -> DataFrame:
    """Project ``df`` onto a warehouse table, leaving out rows without ``key``."""
    computed, lengths = computed or {}, lengths or {}
    columns = []
    for field in WAREHOUSE[table]:
        if field.name in computed:
            value = computed[field.name]
        else:
            value = _convert(df.schema[field.name].dataType, F.col(field.name), field.dataType)
        if field.name in lengths:
            value = F.substring(value, 1, lengths[field.name])
        columns.append(value.alias(field.name))
    if key:
        df = df.filter(F.col(key).isNotNull())
    return df.select(*columns)


def conform_drivers(df: DataFrame) -> DataFrame:
    return conform(df, "d_drivers", "driver_id")


def conform_groups(df: DataFrame) -> DataFrame:
    return conform(df, "d_groups", "group_id")


def conform_schemes(
    df: DataFrame, as_of: dt.date | None = None, lengths: dict[str, int] | None = None
) -> DataFrame:
    """Schemes with their whole texts; ``lengths`` cuts some, as for a column of fixed width."""
    return conform(
        df, "d_schemes", "scheme_id", computed={"p_load_date": as_date(as_of)}, lengths=lengths
    )


def conform_vehicles(df: DataFrame) -> DataFrame:
    return conform(df, "d_vehicles", "vehicle_id")


def conform_events(df: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Events with a surrogate key derived from the event id, so reloads keep it.

    The 64-bit hash of one bigint is a bijection: distinct ids get distinct keys.
    """
    return conform(
        df, "t_events", "event_id",
        computed={"sk_event": F.xxhash64("event_id"), "p_load_date": as_date(as_of)},
    )


def conform_trips(df: DataFrame) -> DataFrame:
    """All trips, those without a drive id included."""
    return conform(df, "t_trips")


CONFORM = {
    "d_drivers": ("drivers", conform_drivers),
    "d_groups": ("groups", conform_groups),
    "d_schemes": ("schemes", conform_schemes),
    "d_vehicles": ("vehicles", conform_vehicles),
    "t_events": ("events", conform_events),
    "t_trips": ("trips", conform_trips),
}
