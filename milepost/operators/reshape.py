"""Wide measures to labelled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.constants import ECONOMY_OFFENDERS


def unpivot_offenders(df: DataFrame, *keys: str) -> DataFrame:
    """One row per key and economy offender with events, in a single pass."""
    counters = [column for column, _, _ in ECONOMY_OFFENDERS]
    long = df.select(*keys, *[F.col(c).cast("double") for c in counters]).unpivot(
        list(keys), counters, "_counter", "total_events"
    ).filter(F.col("total_events") > 0)

    def text(position):
        chosen = None
        for entry in ECONOMY_OFFENDERS:
            test = F.col("_counter") == entry[0]
            chosen = (F if chosen is None else chosen).when(test, F.lit(entry[position]))
        return chosen

    return long.select(
        *keys, text(1).alias("ofensor"), "total_events", text(2).alias("action_recommended")
    )
